"""Frontiers of URLs: which one is kept, what it was last seen as, what is new and what is gone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls


def keep_first(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in ``order``, which must be total; NULL keys form one group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keep_best(df: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """One row a key, that with the least ``rank``.

    A struct minimum, which is folded in each task before the shuffle: a key with a third of all rows costs
    one row a task, where a window would sort all its rows in one place.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.min_by(row, rank).alias("__best"))
    return best.select("__best.*")


def numbered(df: DataFrame, keys: list[str], order: str, width: int = 100_000) -> DataFrame:
    """``df`` with ``n``, the number from 1 of each row within its key, in ``order``, a column of whole numbers.

    A key's rows are numbered in stretches of ``width`` values and the stretches' counts added up, so a key with a
    third of all rows is many tasks' work. Rows with equal ``order`` are numbered in any order; rows with NULL keys are left out.
    """
    t = df.where(F.forall(F.array(*[F.col(k).isNotNull() for k in keys]), lambda x: x)).withColumn("__stretch", F.floor(F.col(order) / width))
    counts = t.groupBy(*keys, "__stretch").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(*keys, "__stretch", before.alias("__before"))
    within = F.row_number().over(Window.partitionBy(*keys, "__stretch").orderBy(order))
    return t.withColumn("__row", within).join(offsets, [*keys, "__stretch"]).withColumn("n", F.col("__row") + F.col("__before")).drop("__row", "__before", "__stretch")


def union_of_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows of all sources with ``source_ord``, columns missing in one as NULL; duplicates stay."""
    tagged = [f.withColumn("source_ord", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def snapshot_diff(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """``key, change``: new, removed or unchanged. One shuffle of both key sets, each key once."""
    both = previous.select(key, F.lit(1).alias("was"), F.lit(0).alias("now")).unionByName(current.select(key, F.lit(0).alias("was"), F.lit(1).alias("now")))
    g = both.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("was").alias("was"), F.max("now").alias("now"))
    return g.select(key, F.when(F.col("was") == 0, "new").when(F.col("now") == 0, "removed").otherwise("unchanged").alias("change"))


def lastmod_lookup(pages: DataFrame, sitemap: DataFrame) -> DataFrame:
    """``page_id, strategy, lastmod`` by four keys tried in order; the first that matches stops the search.

    1 the exact URL, 2 the canonical one without the slash at the end, 3 that without ``www.``, 4 host and
    path in lower case. Of several sitemap rows with one key the earliest listed counts. The keys of both
    sides are exploded and joined at once, so there is one join instead of four.
    """

    def keys(url: Column) -> Column:
        canon = F.rtrim(urls.canonical(url), F.lit("/"))
        loose = F.concat(urls.domain_key(url), F.lower(F.rtrim(urls.path_of(url), F.lit("/"))))
        return F.array(*[F.struct(F.lit(i).alias("strategy"), k.alias("key")) for i, k in enumerate((url, canon, F.regexp_replace(canon, r"://www\.", "://"), loose), 1)])

    s = sitemap.where("url IS NOT NULL").select(F.inline(keys(F.col("url"))), "lastmod", "list_ord")
    first = s.groupBy("strategy", "key").agg(F.min_by(F.struct("lastmod"), F.col("list_ord")).alias("hit"))
    p = pages.where("url IS NOT NULL").select("page_id", F.inline(keys(F.col("url"))))
    hits = p.join(first, ["strategy", "key"]).groupBy("page_id").agg(F.min(F.struct("strategy", "hit")).alias("m"))
    return pages.select("page_id").join(hits, "page_id", "left").select("page_id", F.col("m.strategy").alias("strategy"), F.col("m.hit.lastmod").alias("lastmod"))


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """``node, depth``: nodes within ``max_depth`` steps of a seed, at their least depth.

    Level by level: the frontier joins the edges, what is known already is taken out by an anti join. The
    loop is bounded by the depth, its state is checkpointed.
    """
    from ..session import checkpointed

    links = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    known = checkpointed(seeds.select("node", F.lit(0).alias("depth")).where("node IS NOT NULL").distinct())
    frontier = known
    for depth in range(1, max_depth + 1):
        step = frontier.join(links, frontier["node"] == links["src"]).select(F.col("dst").alias("node")).distinct()
        frontier = checkpointed(step.join(known.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        known = known.unionByName(frontier)
    return known
