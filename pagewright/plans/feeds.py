"""Queries on sitemap files and feeds built from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import feeds
from ..sources.tables import table


def sitemap_xml(spark: SparkSession, d: str) -> DataFrame:
    """The sites' sitemap files, written and read again: the last entry of each URL."""
    s = table(spark, d, "sitemap").withColumn("lastmod", F.nullif(F.trim(F.regexp_replace("lastmod", r"\s+", " ")), F.lit("")))
    return feeds.last_of_url(feeds.sitemap_rows(feeds.sitemap_files(s, "site_id", "list_ord", "url", "lastmod"))).withColumnRenamed("site", "site_id")


def event_feed(spark: SparkSession, d: str) -> DataFrame:
    """Events as feeds, written and read again."""
    e = table(spark, d, "event_items")
    clean = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    files = feeds.rss_files(e, "site_id", "event_id", clean("event_name"), clean("source_url"), clean("event_date"), clean("summary"))
    return feeds.rss_rows(files).select(F.col("site").alias("site_id"), "title", "link", "published", "description")


def feed_dialects(spark: SparkSession, d: str) -> DataFrame:
    """Events as the feeds of three kinds of sites, read by one reader for all kinds: Atom, RSS with guid and dc:date, events XML."""
    clean = lambda c: F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))
    e = table(spark, d, "event_items").select("event_id", "site_id", clean("event_name").alias("name"), clean("source_url").alias("url"), clean("event_date").alias("day"), clean("summary").alias("text"))
    element, quoted = feeds.element, F.replace(feeds.escaped(F.coalesce("url", F.lit(""))), F.lit('"'), F.lit("&quot;"))
    atom = F.concat(F.lit('<entry><link rel="self" href="/self"/><link rel="alternate" href="'), quoted, F.lit('"/>'), element("title", F.col("name")), element("updated", F.col("day")), element("summary", F.col("text")), F.lit("</entry>"))
    rss = F.concat(F.lit("<item>"), element("title", F.col("name")), element("guid", F.col("url")), element("dc:date", F.col("day")), element("description", F.col("text")), F.lit("</item>"))
    iso = F.when(F.col("day").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("day"))
    event = F.concat(F.lit("<event><id>"), F.col("event_id").cast("string"), F.lit("</id><details>"), element("url", F.col("url")), F.lit("</details>"), element("name", F.col("name")), F.lit("<dates><date>"), element("start_date", iso), F.lit("</date></dates>"), element("description", F.col("text")), F.lit("</event>"))
    kind = F.col("site_id") % 3
    entry = F.when(kind == 0, atom).when(kind == 1, rss).otherwise(event)
    numbered = e.select("site_id", F.floor(F.col("event_id") / feeds.FILE_URLS).alias("file_no"), F.struct("event_id", entry.alias("x")).alias("entry"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda x: x["x"]), "")
    files = numbered.groupBy("site_id", "file_no").agg(body.alias("body"))
    wrap = lambda a, b: F.concat(F.lit(a), F.col("body"), F.lit(b))
    xml = F.when(kind == 0, wrap('<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")).when(kind == 1, wrap('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>', "</channel></rss>")).otherwise(wrap("<events>", "</events>"))
    sites = table(spark, d, "site_config").select("site_id", F.col("base_url").alias("base"))
    read = feeds.feed_rows(files.join(sites, "site_id").select(F.col("site_id").alias("feed"), "base", xml.alias("xml")))
    return read.select(F.col("feed").alias("site_id"), "kind", "url", "title", "published", "description")


def sitemap_tree(spark: SparkSession, d: str) -> DataFrame:
    """The sites' sitemaps reached from indexes of their files, by site's first file."""
    s = table(spark, d, "sitemap").withColumn("lastmod", F.nullif(F.trim(F.regexp_replace("lastmod", r"\s+", " ")), F.lit("")))
    named = feeds.sitemap_files(s, "site_id", "list_ord", "url", "lastmod").select("site", "file_no", F.format_string("sitemap-%d-%012d.xml", "site", "file_no").alias("url"), "xml")
    part = F.floor(F.col("file_no") / feeds.FILE_URLS)
    entries = F.array_join(F.transform(F.array_sort(F.collect_list("url")), lambda u: F.concat(F.lit("<sitemap><loc>"), u, F.lit("</loc></sitemap>"))), "")
    indexes = named.groupBy("site", part.alias("part")).agg(F.concat(F.lit("<sitemapindex>"), entries, F.lit("</sitemapindex>")).alias("xml")).select(F.concat_ws("-", F.lit("index"), F.col("site").cast("string"), F.col("part").cast("string")).alias("url"), "xml")
    files = named.select("url", "xml").unionByName(indexes)
    found = feeds.sitemap_tree(files, indexes.select("url"), 2)
    return found.select("loc", "lastmod")


QUERIES = {"sitemap_xml": sitemap_xml, "event_feed": event_feed, "feed_dialects": feed_dialects, "sitemap_tree": sitemap_tree}
CLEAN = r"nullif(trim(regexp_replace({}, '\s+', ' ', 'g'), ' '), '')"
SQL = {
    "sitemap_xml": f"SELECT site_id, url AS loc, {CLEAN.format('lastmod')} AS lastmod FROM sitemap WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY site_id, url ORDER BY list_ord DESC) = 1",
    "event_feed": f"SELECT site_id, {CLEAN.format('event_name')} AS title, {CLEAN.format('source_url')} AS link, {CLEAN.format('event_date')} AS published, {CLEAN.format('summary')} AS description FROM event_items",
    "feed_dialects": rf"""WITH e AS (SELECT event_id, site_id, {CLEAN.format('event_name')} AS name, {CLEAN.format('source_url')} AS url, {CLEAN.format('event_date')} AS day, {CLEAN.format('summary')} AS text FROM event_items),
i AS (SELECT *, CASE WHEN regexp_full_match(day, '\d{{4}}-\d{{2}}-\d{{2}}') THEN day END AS iso FROM e JOIN site_config USING (site_id) WHERE url IS NOT NULL)
SELECT site_id, ['atom', 'rss', 'events'][site_id % 3 + 1] AS kind, split_part(url, '#', 1) AS url,
  CASE WHEN site_id % 3 < 2 THEN coalesce(name, 'No title') ELSE coalesce(name, 'Event ' || event_id) || coalesce(' (' || iso || ')', '') END AS title,
  CASE WHEN site_id % 3 < 2 THEN day ELSE iso END AS published,
  CASE WHEN site_id % 3 < 2 THEN text WHEN length(text) > 500 THEN 'Popis: ' || left(text, 500) || '...' ELSE 'Popis: ' || text END AS description FROM i""",
    "sitemap_tree": f"""WITH s AS (SELECT trim(url, ' ') AS loc, {CLEAN.format('lastmod')} AS lastmod, printf('sitemap-%d-%012d.xml', site_id, list_ord // 1000) AS f, list_ord FROM sitemap WHERE url IS NOT NULL)
SELECT loc, lastmod FROM s QUALIFY row_number() OVER (PARTITION BY loc ORDER BY f DESC, list_ord DESC) = 1""",
}
