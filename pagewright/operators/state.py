"""State of earlier runs joined with what is there now."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unseen(rows: DataFrame, key: str, *known: DataFrame) -> DataFrame:
    """Rows whose key none of ``known`` has: an anti join with the union of their keys; NULL keys are unseen."""
    keys = reduce(DataFrame.unionByName, [k.select(key) for k in known]).where(F.col(key).isNotNull()).distinct()
    return rows.join(keys, key, "left_anti")


def refreshed_cache(live: DataFrame, snapshot: DataFrame, key: str, values: list[str], fetched: dict[str, Column]) -> DataFrame:
    """Live keys with the snapshot's values; what the snapshot lacks is taken from ``fetched``, expressions over the live row.

    ``origin`` says which. Only the misses need fetching; keys that are no longer live fall away.
    """
    s = snapshot.select(key, *[F.col(v).alias(f"__{v}") for v in values], F.lit(True).alias("__there")).dropDuplicates([key])
    t = live.join(s, key, "left")
    there = F.coalesce("__there", F.lit(False))
    return t.select(*live.columns, *[F.when(there, F.col(f"__{v}")).otherwise(fetched[v]).alias(v) for v in values], F.when(there, "snapshot").otherwise("fetched").alias("origin"))


def escaped_mentions(dumps: DataFrame, text: str, names: DataFrame, name: str) -> DataFrame:
    """``name, n``: how often each name stands in escaped quotes in the dumps; names that never do have 0.

    The names are a closed list: they meet the dumps as one array, and each dump is read once a name.
    """
    # one row with all names
    listed = names.where(F.col(name).isNotNull()).agg(F.array_sort(F.collect_set(name)).alias("__names"))
    mark = lambda n: F.concat(F.lit('\\"'), n, F.lit('\\"'))
    times = lambda n: (F.length(text) - F.length(F.replace(F.col(text), mark(n), F.lit("")))) / F.length(mark(n))
    found = dumps.where(F.col(text).isNotNull()).join(F.broadcast(listed), how="cross").select(F.explode(F.transform("__names", lambda n: F.struct(n.alias(name), times(n).cast("bigint").alias("n")))).alias("x")).select("x.*")
    sums = found.groupBy(name).agg(F.sum("n").alias("n"))
    return names.where(F.col(name).isNotNull()).select(name).distinct().join(sums, name, "left").na.fill(0, ["n"])


def newer_than_mark(rows: DataFrame, source: str, moment: str, marks: DataFrame, mark: str) -> DataFrame:
    """``source, n_new, mark``: rows of each source beyond its mark and the mark after them; a source without a mark has all rows new."""
    t = rows.where(F.col(moment).isNotNull()).join(marks.select(source, F.col(mark).alias("__mark")), source, "left")
    is_new = F.col("__mark").isNull() | (F.col(moment) > F.col("__mark"))
    return t.groupBy(source).agg(F.count_if(is_new).alias("n_new"), F.greatest(F.max("__mark"), F.max(moment)).alias("mark"))
