"""Chatbot transcripts: message rows, question and answer pairs, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A pair longer than this on either side is left out of question collections.
LONGEST_SIDE = 1000
#: Positions of a transcript that are looked at together.
STRETCH = 1000
#: Pairs of one batch.
BATCH = 100


def messages(pairs: DataFrame) -> DataFrame:
    """``transcript_id, seq, role, content``: two rows a stored pair, HUMAN before BOT; NULL texts are no message."""
    both = F.array(
        F.struct((F.col("pair_seq") * 2).alias("seq"), F.lit("HUMAN").alias("role"), F.col("question").alias("content")),
        F.struct((F.col("pair_seq") * 2 + 1).alias("seq"), F.lit("BOT").alias("role"), F.col("answer").alias("content")),
    )
    rows = pairs.where("transcript_id IS NOT NULL").select("project", "transcript_id", "pair_id", F.inline(both))
    return rows.where("content IS NOT NULL")


def paired(rows: DataFrame) -> DataFrame:
    """``transcript_id, question_seq, answer_seq, question, answer``: each answer with the last question before it.

    A question that another one follows before any answer is dropped, an answer without an open question
    too. Messages are looked at in stretches of ``STRETCH`` positions with the last message before each, so a
    transcript that holds a third of all messages is many tasks' work.
    """
    stretch = F.floor(F.col("seq") / STRETCH)
    message = F.struct("role", "content", "seq")
    t = rows.withColumn("stretch", stretch)
    lasts = t.groupBy("transcript_id", "stretch").agg(F.max_by(message, F.struct("seq", "pair_id")).alias("last"))
    earlier = F.lag("last").over(Window.partitionBy("transcript_id").orderBy("stretch"))
    carried = lasts.select("transcript_id", "stretch", earlier.alias("carried")).where("carried IS NOT NULL")
    w = Window.partitionBy("transcript_id", "stretch").orderBy("seq", "pair_id")
    marked = t.withColumn("before", F.lag(message).over(w)).join(carried, ["transcript_id", "stretch"], "left")
    hit = marked.withColumn("before", F.coalesce("before", "carried")).where((F.col("role") == "BOT") & (F.col("before.role") == "HUMAN"))
    return hit.select("project", "transcript_id", F.col("before.seq").alias("question_seq"), F.col("seq").alias("answer_seq"), F.col("before.content").alias("question"), F.col("content").alias("answer"))


def usable(question: Column, answer: Column) -> Column:
    """Both sides say something and neither is longer than the collection takes."""
    short = lambda c: (F.length(F.trim(c)) > 0) & (F.length(c) < LONGEST_SIDE)
    return F.coalesce(short(question) & short(answer), F.lit(False))


def keep_last(pairs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key in ``order``, folded in each task before the shuffle."""
    row = F.struct(*[F.col(c) for c in pairs.columns])
    return pairs.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max_by(row, F.col(order)).alias("r")).select("r.*")


def category_report(pairs: DataFrame, categories: DataFrame, total_of: str = "n") -> DataFrame:
    """``category, n, share``: every category of the list, those without pairs as zeros."""
    counts = pairs.where("category IS NOT NULL").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    all_rows = categories.join(counts, "category", "left").na.fill(0, ["n"])
    total = all_rows.agg(F.sum(total_of).alias("total"))
    return all_rows.join(F.broadcast(total), how="cross").select("category", "n", F.when(F.col("total") > 0, F.round(F.col("n") / F.col("total"), 6)).otherwise(0.0).alias("share"))


def batches(rows: DataFrame, key: str, order: str, size: int = BATCH, width: int = 10_000) -> DataFrame:
    """``rows`` with ``batch``, numbered from 0 within each key by the whole number ``order``.

    Numbers are counted in stretches of ``width`` and shifted by the sizes of the stretches before, so a key
    with a third of all rows isn't one task's sort.
    """
    t = rows.withColumn("__stretch", F.floor(F.col(order) / width))
    sizes = t.groupBy(key, "__stretch").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(key).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select(key, "__stretch", F.coalesce(before, F.lit(0)).alias("__shift"))
    place = F.row_number().over(Window.partitionBy(key, "__stretch").orderBy(order)) - 1
    numbered = t.withColumn("__place", place).join(shifts, [key, "__stretch"])
    return numbered.withColumn("batch", F.floor((F.col("__shift") + F.col("__place")) / size).cast("int")).drop("__stretch", "__place", "__shift")


def text_dump(rows: DataFrame) -> DataFrame:
    """``transcript_id, part, n_messages, dump``: the messages of a transcript as text, rules between them.

    A part holds ``STRETCH`` positions, so that no text grows with its transcript.
    """
    line = F.concat(F.col("role"), F.lit(": "), F.col("content"))
    ordered = F.array_sort(F.collect_list(F.struct("seq", "pair_id", line.alias("line"))))
    parts = rows.groupBy("transcript_id", F.floor(F.col("seq") / STRETCH).alias("part")).agg(ordered.alias("m"))
    return parts.select("transcript_id", "part", F.size("m").alias("n_messages"), F.array_join(F.transform("m", lambda x: x["line"]), "\n----------\n").alias("dump"))
