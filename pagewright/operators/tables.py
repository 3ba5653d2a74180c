"""Keyed tables kept up to date: upserts, deletions, merges, versions. Each is one shuffle on the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest attribute value that the knowledge table takes.
ATTRIBUTE_CHARS = 512


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` with all rows of ``source``'s keys replaced by ``source``'s; NULL keys of either side stay."""
    kept = target.join(source.select(key).distinct(), key, "left_anti")
    return kept.unionByName(source)


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``target`` and the rows of ``source`` whose keys it lacks, the first in ``order`` of each key."""
    fresh = source.join(target.select(*keys).distinct(), keys, "left_anti")
    row = F.struct(*[F.col(c) for c in fresh.columns])
    first = fresh.groupBy(*keys).agg(F.min_by(row, F.col(order)).alias("r")).select("r.*")
    return target.unionByName(first)


def merge_links(old: DataFrame, new: DataFrame, key: str, values: list[str], order: str) -> DataFrame:
    """Full outer merge: new values win, positions stay, unknown keys are appended after the old ones."""
    n = new.select(F.col(key), *[F.col(v).alias(f"n_{v}") for v in values], F.col(order).alias("n_order"))
    joined = old.select(key, *values, order).join(n, key, "full_outer")
    return joined.select(key, *[F.coalesce(f"n_{v}", v).alias(v) for v in values], F.col(order).isNull().alias("appended"), F.coalesce(order, "n_order").alias(order))


def delete_removed(target: DataFrame, removed: DataFrame, lookup: str, base: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``target`` that stay and those that go: all ``#...`` variants of each removed base URL."""
    based = target.withColumn("__base", F.substring_index(lookup, "#", 1))
    gone = removed.select(F.col(base).alias("__base")).distinct()
    return based.join(gone, "__base", "left_anti").drop("__base"), based.join(gone, "__base", "left_semi").drop("__base")


# Fixed value: the fragments that the engine itself gives to chunks.
CHUNK_MARK = r"^(?:PAGE\d+)?chunk[A-Z]+$"


def key_class(key: Column) -> Column:
    """What a key's fragments say: ``legit``, ``fragment_polluted`` or ``unknown``.

    One chunk mark alone is legit. A foreign fragment first and a chunk mark last is polluted. Everything else
    is unknown: a bare URL, a single foreign fragment, a mark before another one.
    """
    parts = F.split(key, "#", -1)
    first, last = F.get(parts, F.lit(1)).rlike(CHUNK_MARK), F.element_at(parts, -1).rlike(CHUNK_MARK)
    n = F.size(parts) - 1
    return F.when((n == 1) & first, "legit").when((n > 1) & last & ~first, "fragment_polluted").otherwise("unknown")


def key_decisions(keys: DataFrame, key: str, snapshot: DataFrame, url: str) -> DataFrame:
    """``key, cls, base, base_has_legit, base_in_snapshot, action`` of each distinct key.

    A polluted key is deleted only where its page survives: a legit key of its base is among the keys, or the
    base is among the snapshot's URLs. The only copy is skipped, as is what is unknown; legit keys are kept.
    """
    k = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct().withColumn("cls", key_class(F.col("key")))
    k = k.withColumn("base", F.when(F.col("cls") != "unknown", F.substring_index("key", "#", 1)))
    legit = k.where("cls = 'legit'").select("base").distinct().withColumn("__legit", F.lit(True))
    listed = snapshot.where(F.col(url).isNotNull()).select(F.col(url).alias("base")).distinct().withColumn("__listed", F.lit(True))
    t = k.join(legit, "base", "left").join(listed, "base", "left").na.fill(False, ["__legit", "__listed"])
    survives = F.col("__legit") | F.col("__listed")
    action = F.when(F.col("cls") == "legit", "KEEP").when((F.col("cls") == "fragment_polluted") & survives, "DELETE").otherwise("SKIP")
    return t.select("key", "cls", "base", F.col("__legit").alias("base_has_legit"), F.col("__listed").alias("base_in_snapshot"), action.alias("action"))


def delete_keys(keys: DataFrame, key: str, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keys that stay after the decisions, and a row ``would_delete, deleted, left_over`` that verifies it."""
    gone = decisions.where("action = 'DELETE'").select(F.col("key").alias(key))
    stay = keys.join(gone, key, "left_anti")
    there = keys.select(key).distinct()
    counts = [gone.agg(F.count(F.lit(1)).alias("would_delete")), there.join(gone, key, "left_semi").agg(F.count(F.lit(1)).alias("deleted")), stay.join(gone, key, "left_semi").agg(F.count(F.lit(1)).alias("left_over"))]
    # three single rows
    return stay, counts[0].join(F.broadcast(counts[1]), how="cross").join(F.broadcast(counts[2]), how="cross")


def newest_versions(files: DataFrame, name: str) -> DataFrame:
    """``name, keep``: the highest ``_V<n>`` of each base name is kept, and the one without a version."""
    number = F.regexp_extract(F.col(name), r"(?i)_V(\d+)$", 1).try_cast("int")
    base = F.regexp_replace(F.col(name), r"(?i)_V\d+$", "")
    t = files.select(F.col(name), number.alias("__n"), base.alias("__base"))
    highest = t.groupBy("__base").agg(F.max("__n").alias("__highest"))
    return t.join(highest, "__base").select(name, (F.col("__n").isNull() | (F.col("__n") == F.col("__highest"))).alias("keep"))


def attributes(columns: list[str]) -> Column:
    """A map of the columns' texts, cut at what the knowledge table takes; NULL values are left out."""
    entries = [F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("k"), F.left(F.col(c).cast("string"), F.lit(ATTRIBUTE_CHARS)).alias("v"))) for c in columns]
    return F.map_from_entries(F.array_compact(F.array(*entries)))
