"""Queries on URL frontiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.timestamps import as_ntz, parse_moment
from ..operators import frontier, zones
from ..sources.tables import table

#: Days from which on a page belongs to the current snapshot, and up to which to the previous one.
CUT = "2026-01-05 12:00:00"

PATH_SQL = r"regexp_extract(split_part(url, '#', 1), '^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)', 1)"
HOST_SQL = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#]*)', 1)), '^www\.', '')"
QUERY_SQL = r"regexp_extract(split_part(url, '#', 1), '\?(.*)$', 1)"
CANONICAL_SQL = rf"""CASE WHEN NOT contains(split_part(url, '#', 1), '?') THEN split_part(url, '#', 1)
  ELSE split_part(split_part(url, '#', 1), '?', 1) ||
    CASE WHEN len(list_filter(string_split({QUERY_SQL}, '&'), lambda p : regexp_matches(p, '^[^=]+=.'))) = 0 THEN ''
    ELSE '?' || array_to_string(list_transform(list_sort(list_transform(list_filter(string_split({QUERY_SQL}, '&'), lambda p : regexp_matches(p, '^[^=]+=.')), lambda p, i : {{'name': url_decode(replace(split_part(p, '=', 1), '+', ' ')), 'i': i, 'v': url_decode(replace(substr(p, strpos(p, '=') + 1), '+', ' '))}})), lambda s : replace(url_encode(s.name), '%20', '+') || '=' || replace(url_encode(s.v), '%20', '+')), '&') END END"""
SEGMENTS_SQL = f"list_filter(string_split({PATH_SQL}, '/'), lambda s : s <> '')"


def url_canonical(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "sitemap").where("url IS NOT NULL").select("sitemap_id", urls.canonical(u).alias("canonical"), urls.domain_key(u).alias("domain"), urls.is_file(u).alias("is_file"), urls.title_from_path(u).alias("path_title"), urls.breadcrumb(u, "XML Sitemap").alias("breadcrumb"))


def url_page_variant(spark: SparkSession, d: str) -> DataFrame:
    """Each listed URL for its second page."""
    return table(spark, d, "sitemap").where("url IS NOT NULL").select("sitemap_id", urls.page_url(F.col("url"), F.lit(2)).alias("second_page"))


def url_path_filter(spark: SparkSession, d: str) -> DataFrame:
    """Sitemap rows that no blacklisted path covers: a bounded list of prefixes, whole segments only."""
    prefixes = [F.lit(p) for p in ("/uredni-deska", "/turista", "/kultura")]
    s = table(spark, d, "sitemap").where("url IS NOT NULL")
    covered = F.lit(False)
    for p in prefixes:
        covered = covered | urls.under_path(F.col("url"), p)
    return s.where(~covered).groupBy("site_id").agg(F.count(F.lit(1)).alias("n_kept"))


def _sitemap_in_utc(spark: SparkSession, d: str) -> DataFrame:
    """Sitemap rows with the moment of any readable lastmod, by its own offset, else by its site's zone."""
    s = table(spark, d, "sitemap")
    stamps = zones.project_stamps(s, table(spark, d, "event_items"))
    z = zones.site_zones(stamps, table(spark, d, "site_config"))
    parsed = parse_moment(s.select("sitemap_id", "site_id", "url", "list_ord", "lastmod"), "lastmod")
    return zones.normalise(parsed, z, "site_id").withColumnRenamed("utc_text", "moment")


def frontier_keep_newest(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of each canonical URL by the moment of every readable lastmod; the others last, earlier listing first."""
    s = _sitemap_in_utc(spark, d).where("url IS NOT NULL").withColumn("canonical", urls.canonical(F.col("url")))
    rank = F.struct(F.col("moment").isNull(), F.translate(F.coalesce("moment", F.lit("")), "0123456789", "9876543210"), F.col("list_ord"), F.col("sitemap_id"))
    return frontier.keep_best(s.select("canonical", "sitemap_id", "moment", "list_ord"), ["canonical"], rank).select("canonical", "sitemap_id", "moment")


def frontier_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Sitemap, pages and events in this order: the first that lists a canonical URL keeps it."""
    sources = [
        table(spark, d, "sitemap").select("url", F.col("list_ord").alias("item_ord")),
        table(spark, d, "scraped_pages").select("url", F.col("page_id").alias("item_ord")),
        table(spark, d, "event_items").select(F.col("source_url").alias("url"), F.col("event_id").alias("item_ord")),
    ]
    all_rows = frontier.union_of_sources(sources).where("url IS NOT NULL").withColumn("canonical", urls.canonical(F.col("url")))
    return frontier.keep_best(all_rows, ["canonical"], F.struct("source_ord", "item_ord")).groupBy("source_ord").agg(F.count(F.lit(1)).alias("n_kept"), F.min("item_ord").alias("first_ord"))


def frontier_snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """URLs crawled before against those crawled from a cut on: new, removed, unchanged."""
    p = table(spark, d, "scraped_pages").where("url IS NOT NULL").select(urls.canonical(F.col("url")).alias("canonical"), as_ntz(F.col("fetched_at")).alias("at"))
    cut = F.to_timestamp_ntz(F.lit(CUT))
    return frontier.snapshot_diff(p.where(F.col("at") < cut), p.where(F.col("at") >= cut), "canonical")


def frontier_lastmod_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The sitemap's lastmod of every event page, with the strategy that found it."""
    e = table(spark, d, "event_items").select(F.col("event_id").alias("page_id"), F.col("source_url").alias("url"))
    s = table(spark, d, "sitemap")
    e = e.unionByName(s.select((-F.col("sitemap_id")).alias("page_id"), F.concat(F.regexp_replace("url", "://www\\.", "://"), F.lit("/")).alias("url")))
    return frontier.lastmod_lookup(e, s).na.fill(0, ["strategy"])


def frontier_known_pages(spark: SparkSession, d: str) -> DataFrame:
    """Sitemap URLs that have a scraped page (semi join on the canonical URL), by site."""
    s = table(spark, d, "sitemap").where("url IS NOT NULL").select("site_id", urls.canonical(F.col("url")).alias("canonical"))
    p = table(spark, d, "documents").select(urls.canonical(F.col("url")).alias("canonical"))
    known = s.join(p, "canonical", "left_semi").groupBy("site_id").agg(F.count(F.lit(1)).alias("n_known"))
    return s.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_urls")).join(known, "site_id", "left").na.fill(0, ["n_known"])


def frontier_modified_since(spark: SparkSession, d: str) -> DataFrame:
    """Rows changed after the mark of their site, which is its newest lastmod of the first half of its listing."""
    s = _sitemap_in_utc(spark, d)
    marks = s.groupBy("site_id").agg(F.percentile_approx("list_ord", 0.5, 1_000_000).alias("mid"))
    s = s.where("moment IS NOT NULL")
    first_half = s.join(marks, "site_id").where("list_ord <= mid").groupBy("site_id").agg(F.max("moment").alias("mark"))
    return s.join(first_half, "site_id").where(F.col("moment") > F.col("mark")).select("sitemap_id", "site_id", "moment", "mark")


def frontier_reachable(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of the sites' navigation within three steps of their root: edges are the steps of nav_path."""
    s = table(spark, d, "sitemap").where("nav_path IS NOT NULL")
    parts = F.split("nav_path", " > ")
    prefix = lambda i: F.concat_ws("|", F.col("site_id").cast("string"), F.array_join(F.slice(parts, F.lit(1), i), " > "))
    edges = s.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.struct(prefix(i).alias("src"), prefix(i + 1).alias("dst")))).alias("e")).select("e.*").where("src <> dst")
    seeds = s.select(F.concat_ws("|", F.col("site_id").cast("string"), F.get(parts, F.lit(0))).alias("node"))
    found = frontier.reachable(edges, seeds, 3)
    return found.groupBy("depth").agg(F.count(F.lit(1)).alias("n_nodes"), F.min("node").alias("first_node"))


QUERIES = {
    "url_canonical": url_canonical, "url_page_variant": url_page_variant, "url_path_filter": url_path_filter,
    "frontier_keep_newest": frontier_keep_newest, "frontier_first_wins": frontier_first_wins,
    "frontier_snapshot_diff": frontier_snapshot_diff, "frontier_lastmod_lookup": frontier_lastmod_lookup,
    "frontier_known_pages": frontier_known_pages, "frontier_modified_since": frontier_modified_since, "frontier_reachable": frontier_reachable,
}
FILES = urls.FILE_ENDINGS.replace(" ", "|")
SQL = {
    "url_canonical": rf"""SELECT sitemap_id, {CANONICAL_SQL} AS canonical, {HOST_SQL} AS domain,
  regexp_matches(lower({PATH_SQL}), '\.(?:{FILES})$') OR (regexp_matches(lower({PATH_SQL}), '\.(?:ashx|aspx|jsp|php)$') AND regexp_matches(lower({QUERY_SQL}), 'id_dokumenty|file|download')) AS is_file,
  CASE WHEN len({SEGMENTS_SQL}) = 0 THEN 'Homepage' ELSE {SEGMENTS_SQL}[-1] END AS path_title,
  array_to_string(list_concat(['XML Sitemap'], {SEGMENTS_SQL}), ' > ') AS breadcrumb
FROM sitemap WHERE url IS NOT NULL""",
    "url_page_variant": rf"""WITH q AS (SELECT sitemap_id, url, {QUERY_SQL} AS q FROM sitemap WHERE url IS NOT NULL),
n AS (SELECT *, CASE WHEN regexp_matches('&' || q, '&stranka=') THEN 'stranka' WHEN regexp_matches('&' || q, '&page=') THEN 'page' WHEN regexp_matches('&' || q, '&p=') THEN 'p'
  WHEN regexp_matches('&' || q, '&pg=') THEN 'pg' WHEN regexp_matches('&' || q, '&pagenum=') THEN 'pagenum' ELSE 'stranka' END AS name FROM q)
SELECT sitemap_id, split_part(split_part(url, '#', 1), '?', 1) || '?' || array_to_string(list_concat(list_filter(string_split(q, '&'), lambda p : p <> '' AND split_part(p, '=', 1) <> name), [name || '=2']), '&') AS second_page FROM n""",
    "url_path_filter": rf"""WITH p AS (SELECT site_id, rtrim({PATH_SQL}, '/') AS path FROM sitemap WHERE url IS NOT NULL)
SELECT site_id, count(*) AS n_kept FROM p WHERE NOT (path = '/uredni-deska' OR starts_with(path, '/uredni-deska/') OR path = '/turista' OR starts_with(path, '/turista/') OR path = '/kultura' OR starts_with(path, '/kultura/')) GROUP BY site_id""",
    "frontier_first_wins": rf"""WITH a AS (SELECT url, list_ord AS item_ord, 0 AS source_ord FROM sitemap UNION ALL SELECT url, page_id, 1 FROM scraped_pages UNION ALL SELECT source_url, event_id, 2 FROM event_items),
k AS (SELECT source_ord, item_ord, {CANONICAL_SQL} AS canonical FROM a WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY source_ord, item_ord) = 1)
SELECT CAST(source_ord AS INTEGER) AS source_ord, count(*) AS n_kept, min(item_ord) AS first_ord FROM k GROUP BY source_ord""",
    "frontier_snapshot_diff": rf"""WITH p AS (SELECT {CANONICAL_SQL} AS canonical, strftime(fetched_at AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS t FROM scraped_pages WHERE url IS NOT NULL),
g AS (SELECT canonical, bool_or(t < '{CUT}') AS was, bool_or(t >= '{CUT}') AS now FROM p GROUP BY canonical)
SELECT canonical, CASE WHEN NOT was THEN 'new' WHEN NOT now THEN 'removed' ELSE 'unchanged' END AS change FROM g""",
    "frontier_lastmod_lookup": rf"""WITH p AS (SELECT event_id AS page_id, source_url AS url FROM event_items UNION ALL SELECT -sitemap_id, regexp_replace(url, '://www\.', '://') || '/' FROM sitemap),
pk AS (SELECT page_id, url, rtrim({CANONICAL_SQL}, '/') AS k2, regexp_replace(rtrim({CANONICAL_SQL}, '/'), '://www\.', '://') AS k3, {HOST_SQL} || lower(rtrim({PATH_SQL}, '/')) AS k4 FROM p WHERE url IS NOT NULL),
sk AS (SELECT url, lastmod, list_ord, rtrim({CANONICAL_SQL}, '/') AS k2, regexp_replace(rtrim({CANONICAL_SQL}, '/'), '://www\.', '://') AS k3, {HOST_SQL} || lower(rtrim({PATH_SQL}, '/')) AS k4 FROM sitemap WHERE url IS NOT NULL),
hits AS (SELECT page_id, 1 AS strategy, lastmod, list_ord FROM pk JOIN sk USING (url) UNION ALL SELECT page_id, 2, lastmod, list_ord FROM pk JOIN sk USING (k2)
  UNION ALL SELECT page_id, 3, lastmod, list_ord FROM pk JOIN sk USING (k3) UNION ALL SELECT page_id, 4, lastmod, list_ord FROM pk JOIN sk USING (k4)),
best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY strategy, list_ord) = 1)
SELECT page_id, CAST(coalesce(strategy, 0) AS INTEGER) AS strategy, lastmod FROM p LEFT JOIN best USING (page_id)""",
    "frontier_known_pages": rf"""WITH s AS (SELECT site_id, {CANONICAL_SQL} AS canonical FROM sitemap WHERE url IS NOT NULL), p AS (SELECT DISTINCT {CANONICAL_SQL} AS canonical FROM documents)
SELECT site_id, count(*) AS n_urls, count(p.canonical) AS n_known FROM s LEFT JOIN p USING (canonical) GROUP BY site_id""",
    "frontier_reachable": r"""WITH RECURSIVE parts AS (SELECT site_id, string_split(nav_path, ' > ') AS p FROM sitemap WHERE nav_path IS NOT NULL),
e AS (SELECT DISTINCT site_id || '|' || array_to_string(p[1:i], ' > ') AS src, site_id || '|' || array_to_string(p[1:i + 1], ' > ') AS dst FROM (SELECT site_id, p, unnest(range(1, len(p))) AS i FROM parts)),
r(node, depth) AS (SELECT DISTINCT site_id || '|' || p[1], 0 FROM parts UNION SELECT dst, depth + 1 FROM r JOIN e ON node = src WHERE depth < 3),
f AS (SELECT node, min(depth) AS depth FROM r GROUP BY node)
SELECT CAST(depth AS INTEGER) AS depth, count(*) AS n_nodes, min(node) AS first_node FROM f GROUP BY depth""",
}
