"""Queries on keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.timestamps import as_ntz, parse_moment
from ..operators import frontier, tables, zones
from ..sources.tables import table
from .frontier import CANONICAL_SQL

#: What was fetched before is the state so far, what was fetched from here on is the next run's.
CUT = "2026-01-05 12:00:00"


def _late(column: str):
    return as_ntz(F.col(column)) >= F.to_timestamp_ntz(F.lit(CUT))


def kb_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The knowledge table of documents and early pages after the later pages replaced their URLs' rows."""
    docs = table(spark, d, "documents").select(F.col("url").alias("lookup_url"), F.col("doc_id").alias("row_id"), F.lit("document").alias("origin"))
    pages = table(spark, d, "scraped_pages").where("url IS NOT NULL").select(F.col("url").alias("lookup_url"), F.col("page_id").alias("row_id"), F.lit("page").alias("origin"), _late("ingested_at").alias("late"))
    both = tables.upsert(docs.unionByName(pages.where("NOT late").drop("late")), pages.where("late").drop("late"), "lookup_url")
    return both.groupBy("origin").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("lookup_url").alias("n_urls"), F.sum("row_id").alias("sum_ids"))


def kb_delete_removed(spark: SparkSession, d: str) -> DataFrame:
    """Sitemap keys of pages that are gone, fragments included, by site."""
    s = table(spark, d, "sitemap").where("url IS NOT NULL").select("site_id", F.col("url").alias("lookup_url"))
    removed = table(spark, d, "sitemap").where("lastmod IS NULL AND url IS NOT NULL").select(urls.without_fragment(F.col("url")).alias("base"))
    stay, go = tables.delete_removed(s, removed, "lookup_url", "base")
    return stay.groupBy("site_id").agg(F.count(F.lit(1)).alias("n")).withColumn("state", F.lit("kept")).unionByName(go.groupBy("site_id").agg(F.count(F.lit(1)).alias("n")).withColumn("state", F.lit("deleted")))


def kb_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Attributes of event rows as one cut text each."""
    e = table(spark, d, "event_items")
    m = tables.attributes(["place", "summary", "speakers"])
    return e.select("event_id", F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda x: F.concat(x["key"], F.lit("="), x["value"]))), ";").alias("attributes"))


def event_insert_absent(spark: SparkSession, d: str) -> DataFrame:
    """The event table after later rows were added only where name and date were missing."""
    e = table(spark, d, "event_items").select("event_id", F.coalesce("event_name", F.lit("")).alias("event_name"), F.coalesce("event_date", F.lit("")).alias("event_date"), _late("crawled_at").alias("late"))
    out = tables.insert_absent(e.where("NOT late"), e.where("late"), ["event_name", "event_date"], "event_id")
    return out.select("event_id")


def links_merge(spark: SparkSession, d: str) -> DataFrame:
    """A site's link table brought up to date by the later listing: new titles, old positions."""
    s = table(spark, d, "sitemap").where("url IS NOT NULL")
    one = s.groupBy(urls.canonical(F.col("url")).alias("url"), _late("ingested_at").alias("late")).agg(F.min("list_ord").alias("list_ord"), F.max_by("title", "list_ord").alias("title"))
    return tables.merge_links(one.where("NOT late").drop("late"), one.where("late").drop("late"), "url", ["title"], "list_ord")


def _cache_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys under which chunks of the sitemap's URLs would be stored, and the URLs themselves."""
    s = table(spark, d, "sitemap").where("url IS NOT NULL")
    mark = F.concat(F.lit("#chunk"), urls.chunk_postfix((F.col("sitemap_id") % 30).cast("int")))
    return s.select(F.concat("url", mark).alias("key")).unionByName(s.select(F.col("url").alias("key")))


def _key_decisions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    keys = _cache_keys(spark, d)
    return keys, tables.key_decisions(keys, "key", table(spark, d, "documents"), "url")


def key_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Cache keys of the sitemap's URLs: which ones a fragment has spoilt and may go, as documents or legit keys survive."""
    decided = _key_decisions(spark, d)[1]
    return decided.groupBy("cls", "base_has_legit", "base_in_snapshot", "action").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"))


def key_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """The verification of the deletion: what was to go, what went, what is left over."""
    keys, decided = _key_decisions(spark, d)
    return tables.delete_keys(keys, "key", decided)[1]


def version_prune(spark: SparkSession, d: str) -> DataFrame:
    """Files saved for each title, later ones as versions; the highest version and the plain file stay."""
    s = table(spark, d, "sitemap").where("title IS NOT NULL").select("site_id", "sitemap_id", urls.safe_filename(F.col("title")).alias("base"))
    t = frontier.numbered(s, ["site_id", "base"], "sitemap_id").withColumn("n", F.col("n") - 1)
    names = t.select(F.concat_ws("/", F.col("site_id").cast("string"), F.when(F.col("n") == 0, F.col("base")).otherwise(F.concat_ws("_V", "base", F.col("n").cast("string")))).alias("name"))
    return tables.newest_versions(names, "name")


def event_years(spark: SparkSession, d: str) -> DataFrame:
    """Events by the year of any readable date, as the site's calendar has it, and the span of their days as numbers."""
    e = table(spark, d, "event_items")
    stamps = zones.project_stamps(table(spark, d, "sitemap"), e)
    z = zones.site_zones(stamps, table(spark, d, "site_config"))
    local = zones.localise(parse_moment(e.select("event_id", "site_id", "event_date"), "event_date"), z, "site_id")
    number = F.date_format(F.to_date("local"), "yyyyMMdd").cast("int")
    days = local.where("local IS NOT NULL").select(number.alias("day"))
    return days.groupBy(F.lpad(F.floor(F.col("day") / 10000).cast("string"), 4, "0").alias("year")).agg(F.count(F.lit(1)).alias("n_events"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


QUERIES = {
    "kb_upsert": kb_upsert, "kb_delete_removed": kb_delete_removed, "kb_attributes": kb_attributes, "event_insert_absent": event_insert_absent,
    "links_merge": links_merge, "key_decisions": key_decisions, "key_cleanup": key_cleanup, "version_prune": version_prune, "event_years": event_years,
}
LATE_SQL = "(strftime({} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') >= '" + CUT + "')"
KEYS_SQL = r"""WITH s AS (SELECT url, sitemap_id % 30 AS n FROM sitemap WHERE url IS NOT NULL),
k AS (SELECT url || '#chunk' || CASE WHEN n < 26 THEN chr(CAST(65 + n AS INTEGER)) ELSE 'A' || chr(CAST(65 + n - 26 AS INTEGER)) END AS key FROM s UNION SELECT url FROM s),
f AS (SELECT key, string_split(key, '#') AS p FROM k),
m AS (SELECT key, p[1] AS page, len(p) - 1 AS n, regexp_full_match(p[2], '(chunk[A-Z]+|PAGE\d+chunk[A-Z]+)') AS first_is_mark, regexp_full_match(p[-1], '(chunk[A-Z]+|PAGE\d+chunk[A-Z]+)') AS last_is_mark FROM f),
c AS (SELECT key, page, CASE WHEN n = 0 THEN 'unknown' WHEN n = 1 THEN CASE WHEN first_is_mark THEN 'legit' ELSE 'unknown' END WHEN last_is_mark AND NOT first_is_mark THEN 'fragment_polluted' ELSE 'unknown' END AS cls FROM m),
l AS (SELECT DISTINCT page FROM c WHERE cls = 'legit'), x AS (SELECT DISTINCT url AS page FROM documents WHERE url IS NOT NULL),
b AS (SELECT key, cls, cls <> 'unknown' AND page IN (SELECT page FROM l) AS base_has_legit, cls <> 'unknown' AND page IN (SELECT page FROM x) AS base_in_snapshot FROM c),
d AS (SELECT *, CASE cls WHEN 'legit' THEN 'KEEP' WHEN 'unknown' THEN 'SKIP' ELSE CASE WHEN base_has_legit OR base_in_snapshot THEN 'DELETE' ELSE 'SKIP' END END AS action FROM b)
"""
SQL = {
    "kb_upsert": f"""WITH pages AS (SELECT url AS lookup_url, page_id AS row_id, 'page' AS origin, {LATE_SQL.format('ingested_at')} AS late FROM scraped_pages WHERE url IS NOT NULL),
t AS (SELECT url AS lookup_url, doc_id AS row_id, 'document' AS origin FROM documents UNION ALL SELECT lookup_url, row_id, origin FROM pages WHERE NOT late),
s AS (SELECT lookup_url, row_id, origin FROM pages WHERE late),
u AS (SELECT * FROM t WHERE lookup_url IS NULL OR lookup_url NOT IN (SELECT lookup_url FROM s) UNION ALL SELECT * FROM s)
SELECT origin, count(*) AS n_rows, count(DISTINCT lookup_url) AS n_urls, CAST(sum(row_id) AS BIGINT) AS sum_ids FROM u GROUP BY origin""",
    "kb_delete_removed": """WITH r AS (SELECT DISTINCT split_part(url, '#', 1) AS base FROM sitemap WHERE lastmod IS NULL AND url IS NOT NULL)
SELECT site_id, count(*) AS n, CASE WHEN base IS NULL THEN 'kept' ELSE 'deleted' END AS state FROM sitemap LEFT JOIN r ON base = split_part(url, '#', 1) WHERE url IS NOT NULL GROUP BY site_id, state""",
    "kb_attributes": """SELECT event_id, coalesce(array_to_string(list_sort(list_filter(['place=' || left(place, 512), 'summary=' || left(summary, 512), 'speakers=' || left(speakers, 512)], lambda x : x IS NOT NULL)), ';'), '') AS attributes FROM event_items""",
    "event_insert_absent": f"""WITH e AS (SELECT event_id, coalesce(event_name, '') AS n, coalesce(event_date, '') AS t, {LATE_SQL.format('crawled_at')} AS late FROM event_items), h AS (SELECT * FROM e WHERE NOT late)
SELECT event_id FROM h UNION ALL SELECT min(event_id) FROM e WHERE late AND NOT EXISTS (SELECT 1 FROM h WHERE h.n = e.n AND h.t = e.t) GROUP BY n, t""",
    "links_merge": f"""WITH c AS (SELECT {CANONICAL_SQL} AS url, list_ord, title, {LATE_SQL.format('ingested_at')} AS late FROM sitemap WHERE url IS NOT NULL),
one AS (SELECT url, late, min(list_ord) AS list_ord, max_by(title, list_ord) AS title FROM c GROUP BY url, late),
o AS (SELECT * FROM one WHERE NOT late), n AS (SELECT * FROM one WHERE late)
SELECT coalesce(o.url, n.url) AS url, coalesce(n.title, o.title) AS title, o.list_ord IS NULL AS appended, coalesce(o.list_ord, n.list_ord) AS list_ord FROM o FULL OUTER JOIN n ON o.url = n.url""",
    "key_decisions": KEYS_SQL + "SELECT cls, base_has_legit, base_in_snapshot, action, count(*) AS n, min(key) AS first_key FROM d GROUP BY ALL",
    "key_cleanup": KEYS_SQL + "SELECT count(*) FILTER (action = 'DELETE') AS would_delete, count(*) FILTER (action = 'DELETE') AS deleted, CAST(0 AS BIGINT) AS left_over FROM d",
    "version_prune": r"""WITH s AS (SELECT site_id, sitemap_id, left(regexp_replace(regexp_replace(regexp_replace(replace(strip_accents(title), '..', '_'), '[<>:"/\\|?*\s\x00-\x1f]+', '_', 'g'), '_+', '_', 'g'), '^[_.]+|[_.]+$', '', 'g'), 200) AS base FROM sitemap WHERE title IS NOT NULL),
v AS (SELECT site_id, base, row_number() OVER (PARTITION BY site_id, base ORDER BY sitemap_id) - 1 AS n FROM s)
SELECT site_id || '/' || base || CASE WHEN n = 0 THEN '' ELSE '_V' || n END AS name, n = 0 OR n = max(n) OVER (PARTITION BY site_id, base) AS keep FROM v""",
}
