"""Sources mixed to target weights along a curriculum (problem 7).

Each source demands its share of the total tokens, or what it has times its cap if that is less. Its weight
may change along the training: a schedule of weights over [0, 1] is integrated, and the cumulative demand is
inverted to give each copy of a document its position. Sorting by position in ranges gives the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import checkpointed
from .tokens import VOCABULARY, with_token_counts

#: Documents of one bucket of a source's order; a source of any size is that many times more buckets.
BUCKET_DOCS = 50_000


def source_name(source: Column) -> Column:
    """Sources are compared without letter case and outer blanks."""
    return F.lower(F.trim(source))


def counted(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, name, n_tokens`` of all documents; a NULL source or text stays, the latter with no tokens."""
    return with_token_counts(documents.select("doc_id", source_name(F.col("source")).alias("name"), "text"), "text", vocabulary)


def demands(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: what it has, wants and can give of a mixture as large as the corpus itself.

    ``source, name, target_share, max_repeat, n_docs, available, total, wanted, given``. A source without
    documents has nothing; documents of other sources, or of none, count in the total only. One row a source,
    whatever the number of documents: they are summed in each task before the shuffle.
    """
    sums = counts.groupBy("name").agg(F.sum("n_tokens").alias("available"), F.count(F.lit(1)).alias("n_docs"))
    total = sums.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("total"))
    t = targets.where("source IS NOT NULL").select("source", source_name(F.col("source")).alias("name"), "target_share", "max_repeat").dropDuplicates()
    # the total is a single row
    joined = t.join(sums, "name", "left").join(F.broadcast(total), how="cross").na.fill(0, ["available", "n_docs"])
    capacity = F.col("available") * F.col("max_repeat")
    wanted = F.col("target_share") * F.col("total")
    return joined.select("source", "name", "target_share", "max_repeat", "n_docs", "available", "total", wanted.alias("wanted"), F.least(wanted, capacity.cast("double")).alias("given"))


def placements(counts: DataFrame, need: DataFrame, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """The cumulative demand inverted: ``doc_id, source, n_tokens, start, passes`` of each document that is placed.

    A source's documents follow each other by a hash of their id; ``start`` is where a document begins in one pass
    over them, ``passes`` how often it is met until the demand is, at most ``max_repeat`` times. The running sums of
    tokens come from sums of buckets and sums within a bucket, so a source with a third of all rows is many
    tasks' work. Documents of no target source, and of no tokens, give no row.
    """
    plan = need.where((F.col("given") > 0) & (F.col("available") > 0)).select("source", "name", "available", "given", "max_repeat", F.ceil(F.col("n_docs") / bucket_docs).alias("n_buckets"))
    # one row a target source
    t = counts.where("n_tokens > 0").withColumn("order", F.xxhash64("doc_id")).join(F.broadcast(plan), "name")
    # buckets are ranges of the hash, so their order is the documents' order
    t = t.withColumn("bucket", F.floor((F.col("order") / F.lit(2.0**64) + 0.5) * F.col("n_buckets")))
    sums = t.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("source", "bucket", before.alias("offset"))
    within = Window.partitionBy("source", "bucket").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(offsets, ["source", "bucket"])
    start = F.col("offset") + F.col("inner")
    passes = F.least(F.ceil((F.col("given") - start) / F.col("available")), F.col("max_repeat").cast("bigint"))
    return t.where(passes > 0).select("doc_id", "source", "name", "n_tokens", "available", "given", start.alias("start"), passes.alias("passes"))


def reached(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """``demands`` with ``placed``, the tokens of all placed copies, and ``n_copies``, of each target source.

    Copies are whole documents, so a source in reach of its share has its demand and at most a document more. Every
    text is tokenised once.
    """
    counts = checkpointed(counted(documents, vocabulary))
    need = checkpointed(demands(counts, targets))
    copies = placements(counts, need, bucket_docs).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("passes")).alias("placed"), F.sum("passes").alias("n_copies"))
    return need.join(copies, "source", "left").na.fill(0, ["placed", "n_copies"])


def out_of_reach(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Distinct ``source`` of the targets whose placed copies stay below their share, though their cap of repeats is used up.

    Rows of targets with a NULL source, share or cap can't be judged and give no row; an empty corpus has no size, so
    every share of it is reached.
    """
    return reached(documents, targets, vocabulary).where(F.col("placed") < F.col("wanted")).where("max_repeat IS NOT NULL").select("source").distinct()


def shares(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per target source: the share that its placed copies reach of all placed tokens, and the repeats that takes."""
    d = reached(documents, targets, vocabulary)
    everything = d.agg(F.sum("placed").alias("everything"))
    actual = F.when(F.col("everything") > 0, F.col("placed") / F.col("everything")).otherwise(0.0)
    repeats = F.when(F.col("available") > 0, F.col("placed") / F.col("available")).otherwise(0.0)
    reachable = ~(F.col("placed") < F.col("wanted"))
    return d.join(F.broadcast(everything), how="cross").select("source", "target_share", "max_repeat", "available", "placed", reachable.alias("reachable"), F.round(actual, 9).alias("actual_share"), F.round(repeats, 9).alias("repeats"))


def segments(schedules: DataFrame) -> DataFrame:
    """``name, parts``: a piecewise linear weight schedule integrated, its integral taken as 1.

    ``schedules`` has ``source`` and ``knots``, an array of ``(t, w)`` with t from 0 to 1 and w not negative.
    A part holds the cumulative demand at its ends (u0, u1), its times and weights.
    """
    k = F.array_sort("knots")
    pairs = F.zip_with(F.slice(k, 1, F.size(k) - 1), F.slice(k, 2, F.size(k) - 1), lambda a, b: F.struct(a["t"].alias("t0"), b["t"].alias("t1"), a["w"].alias("w0"), b["w"].alias("w1"), ((a["w"] + b["w"]) / 2 * (b["t"] - a["t"])).alias("area")))
    areas = schedules.select(source_name(F.col("source")).alias("name"), pairs.alias("pairs"))
    whole = F.aggregate("pairs", F.lit(0.0), lambda s, p: s + p["area"])
    until = lambda i: F.aggregate(F.slice("pairs", F.lit(1), i), F.lit(0.0), lambda s, p: s + p["area"]) / F.col("whole")
    summed = F.transform("pairs", lambda p, i: F.struct(until(i).alias("u0"), until(i + 1).alias("u1"), p["t0"].alias("t0"), p["t1"].alias("t1"), (p["w0"] / F.col("whole")).alias("w0"), (p["w1"] / F.col("whole")).alias("w1")))
    return areas.withColumn("whole", whole).where("whole > 0").select("name", summed.alias("parts"))


def _inverse(u: Column, parts: Column) -> Column:
    """The time at which a schedule's cumulative demand is ``u``."""
    part = F.get(F.filter(parts, lambda p: u < p["u1"]), F.lit(0))
    slope = (part["w1"] - part["w0"]) / (part["t1"] - part["t0"])
    rest = F.greatest(u - part["u0"], F.lit(0.0))
    root = F.sqrt(F.greatest(part["w0"] * part["w0"] + 2 * slope * rest, F.lit(0.0)))
    # the stable form of the quadratic's root, which also holds for a constant weight
    step = F.when(rest > 0, 2 * rest / (part["w0"] + root)).otherwise(0.0)
    return F.when(parts.isNull(), u).otherwise(F.coalesce(part["t0"] + step, F.lit(1.0)))


def curriculum(documents: DataFrame, targets: DataFrame, schedules: DataFrame | None = None, vocabulary: str = VOCABULARY, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """``doc_id, source, copy, n_tokens, position``: every copy to train on, in order of its position in [0, 1].

    Pass follows pass over a source's documents until its demand is met. A source without a schedule has a constant
    weight. Documents of no target source, and of no tokens, give no row.
    """
    counts = checkpointed(counted(documents, vocabulary))
    placed = placements(counts, demands(counts, targets), bucket_docs)
    if schedules is None:
        placed = placed.withColumn("parts", F.lit(None).cast("array<struct<u0:double,u1:double,t0:double,t1:double,w0:double,w1:double>>"))
    else:
        # one row a target source
        placed = placed.join(F.broadcast(segments(schedules)), "name", "left")
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("passes") - 1).cast("int"))))
    middle = F.col("copy") * F.col("available") + F.col("start") + F.col("n_tokens") / 2
    out = copies.select("doc_id", "source", "copy", "n_tokens", _inverse(F.least(middle / F.col("given"), F.lit(1.0)), F.col("parts")).alias("position"))
    return out.repartitionByRange("position").sortWithinPartitions("position", "source", "doc_id", "copy")
