"""What was fetched: status tallies, the choice among providers, links written in texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.sites import site_key


def status(content: Column) -> Column:
    """``ok``, ``skipped`` for blank content, ``failed`` for none."""
    return F.when(content.isNull(), "failed").when(F.trim(content) == "", "skipped").otherwise("ok")


def tally(pages: DataFrame, by: str, content: str) -> DataFrame:
    """``by, n_ok, n_skipped, n_failed, success_rate``."""
    s = pages.select(by, status(F.col(content)).alias("s"))
    g = s.groupBy(by).agg(*[F.count_if(F.col("s") == x).alias(f"n_{x}") for x in ("ok", "skipped", "failed")])
    total = F.col("n_ok") + F.col("n_skipped") + F.col("n_failed")
    return g.withColumn("success_rate", F.round(F.col("n_ok") / total, 6))


def chosen_provider(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """``url, page_id, provider``: of each URL's pages with content that of the provider its site lists first.

    Providers that the site does not list come after those it does, in order of their names; of equal ones
    the newest page counts.
    """
    order = sites.select(site_key(F.col("base_url")).alias("site"), F.split("provider_sequence", r"\s*,\s*").alias("sequence"))
    p = pages.where("url IS NOT NULL AND content IS NOT NULL").select("url", "page_id", "provider", site_key(F.col("base_url")).alias("site"))
    joined = p.join(order, "site", "left")
    place = F.coalesce(F.nullif(F.array_position("sequence", F.col("provider")), F.lit(0)), F.lit(1_000_000))
    best = joined.groupBy("url").agg(F.min_by(F.struct("page_id", "provider"), F.struct(place, "provider", -F.col("page_id"))).alias("b"))
    return best.select("url", "b.page_id", "b.provider")


def written_links(texts: DataFrame, text: str, base_url: str) -> DataFrame:
    """Distinct ``site, target``: URLs written in the texts of a site that stay on it, signs at their end apart."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"https?://[^\s<>\"'()\[\]{}|]+"), F.lit(0))
    t = texts.where(F.contains(text, F.lit("://"))).select(site_key(F.col(base_url)).alias("site"), F.explode(F.array_distinct(found)).alias("raw"))
    t = t.select("site", urls.without_fragment(F.regexp_replace("raw", r"[.,;:!?*]+$", "")).alias("target"))
    return t.where(urls.domain_key(F.col("target")) == F.col("site")).distinct()


def set_sizes(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row ``n_left, n_right, n_both, n_left_only, n_right_only`` of two key sets, from one pass over both."""
    both = a.select(key, F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionByName(b.select(key, F.lit(False).alias("in_a"), F.lit(True).alias("in_b")))
    g = both.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_or("in_a").alias("a"), F.bool_or("in_b").alias("b"))
    c = lambda x: F.count_if(x)
    return g.agg(c(F.col("a")).alias("n_left"), c(F.col("b")).alias("n_right"), c(F.col("a") & F.col("b")).alias("n_both"), c(F.col("a") & ~F.col("b")).alias("n_left_only"), c(F.col("b") & ~F.col("a")).alias("n_right_only"))
