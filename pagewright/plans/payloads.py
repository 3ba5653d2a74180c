"""Queries on payloads: JSON of models, saved files, titles, and state joined with what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payloads as p
from ..functions import urls
from ..functions.timestamps import as_ntz
from ..operators import frontier, state
from ..sources.tables import table
from .frontier import CANONICAL_SQL
from .tables import CUT


def unseen_urls(spark: SparkSession, d: str) -> DataFrame:
    """Listed pages that neither documents nor scraped pages know, by site."""
    canonical = lambda t, c: table(spark, d, t).where(F.col(c).isNotNull()).select(*(["site_id"] if t == "sitemap" else []), urls.canonical(F.col(c)).alias("canonical"))
    fresh = state.unseen(canonical("sitemap", "url"), "canonical", canonical("documents", "url"), canonical("scraped_pages", "url"))
    return fresh.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("canonical").alias("n_urls"))


def cache_refreshed(spark: SparkSession, d: str) -> DataFrame:
    """The cache of pages after a run: titles of known documents are reused, the others are taken from the page."""
    live = table(spark, d, "scraped_pages").where("url IS NOT NULL").select("url", "page_id", F.coalesce("title", F.lit("")).alias("page_title"))
    docs = table(spark, d, "documents").where("url IS NOT NULL").groupBy("url").agg(F.min_by(F.coalesce("title", F.lit("")), "doc_id").alias("title"))
    out = state.refreshed_cache(live, docs, "url", ["title"], {"title": F.col("page_title")})
    return out.select("page_id", "origin", "title")


def category_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Categories in the dumps of transcripts, where a model's answer is JSON within JSON; unused ones count 0."""
    f = table(spark, d, "faq_pairs")
    dumps = f.select(F.to_json(F.struct("project", F.to_json(F.struct("category", "pair_seq")).alias("debug"))).alias("dump"))
    names = f.select("category").unionByName(table(spark, d, "mix_targets").select(F.col("source").alias("category")))
    return state.escaped_mentions(dumps, "dump", names, "category")


def news_since(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each site published after what was known at the cut, and the site's mark after them."""
    t = table(spark, d, "documents").where("site IS NOT NULL").select("site", F.unix_seconds("published_at").alias("at"), (as_ntz(F.col("ingested_at")) < F.to_timestamp_ntz(F.lit(CUT))).alias("early"))
    marks = t.where("early AND at IS NOT NULL").groupBy("site").agg(F.max("at").alias("known"))
    return state.newer_than_mark(t, "site", "at", marks, "known")


def json_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Pairs as a model would write them, in a fence after some words and with trailing commas, read back; broken ones have a fallback."""
    f = table(spark, d, "faq_pairs")
    body = F.regexp_replace(F.to_json(F.struct("question", "answer")), r"\}$", ", }")
    written = F.concat(F.lit("Here is the result:\n```json\n"), body, F.lit("\n```\nDone."))
    read = f.select("pair_id", F.from_json(p.repaired_json(written), "question STRING, answer STRING").alias("r"))
    return read.select("pair_id", F.coalesce("r.question", F.lit("?")).alias("question"), F.coalesce("r.answer", F.lit("")).alias("answer"))


def links_of_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Links of JSON summaries, a summary for each hundred positions of a listing, exploded in their order."""
    s = table(spark, d, "sitemap").where("url IS NOT NULL")
    entry = F.struct("list_ord", "sitemap_id", "url", "title")
    summaries = s.groupBy("site_id", F.floor(F.col("list_ord") / 100).alias("part")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(entry)).alias("links"))).alias("json"))
    read = summaries.select("site_id", F.posexplode(F.from_json("json", "links ARRAY<STRUCT<sitemap_id: BIGINT, url: STRING, title: STRING>>")["links"]).alias("pos", "l"))
    return read.select("site_id", "pos", "l.sitemap_id", "l.url", "l.title")


def saved_formats(spark: SparkSession, d: str) -> DataFrame:
    """By which form the URL of a scraped file is found."""
    t = table(spark, d, "scraped_pages").where("content IS NOT NULL").select(F.inline(F.array(p.saved_url(F.col("content")))))
    return t.groupBy(F.coalesce("form", F.lit("none")).alias("form")).agg(F.count(F.lit(1)).alias("n_files"), F.countDistinct("url").alias("n_urls"))


def title_parts(spark: SparkSession, d: str) -> DataFrame:
    """Titles with a page mark set and read again."""
    s = table(spark, d, "sitemap").where("title IS NOT NULL")
    n = F.col("sitemap_id") % 5
    marked = F.when(n == 0, F.col("title")).otherwise(F.concat("title", F.lit("_PAGE"), n.cast("string"), F.when(n > 2, "B").otherwise("")))
    return s.select("sitemap_id", F.inline(F.array(p.page_of_title(p.clean_title(marked)))))


def document_dates(spark: SparkSession, d: str) -> DataFrame:
    """The year of a document by the first ISO day in its text, else by its publication."""
    t = table(spark, d, "documents").where("text IS NOT NULL")
    year = p.whole_number(F.left(p.first_day(F.col("text")), F.lit(4)), F.coalesce(F.year(as_ntz(F.col("published_at"))), F.lit(0)))
    return t.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length(p.truncated(F.col("text"), 50))).alias("n_chars"))


def fetch_plan(spark: SparkSession, d: str) -> DataFrame:
    """Listed URLs by what is to be done: the site's first page, a page, or nothing for lack of a scheme."""
    s = table(spark, d, "sitemap").select("site_id", "url")
    # ten forms of each site's base
    bases = table(spark, d, "site_config").where("base_url IS NOT NULL").select("site_id", F.explode(p.base_forms(F.col("base_url"))).alias("form")).distinct()
    plain = F.lower(F.regexp_replace("url", r"[?#].*$", ""))
    t = s.withColumn("form", plain).join(bases.withColumn("base", F.lit(True)), ["site_id", "form"], "left")
    what = F.when(F.col("url").isNull() | ~p.fetchable(F.col("url")), "none").when(F.col("base"), "base").otherwise("page")
    return t.groupBy("site_id", what.alias("what")).agg(F.count(F.lit(1)).alias("n"))


def first_of_section(spark: SparkSession, d: str) -> DataFrame:
    """The first listing of each URL within the section that its path begins with."""
    s = table(spark, d, "sitemap").where("url IS NOT NULL").select("site_id", "sitemap_id", "list_ord", urls.canonical(F.col("url")).alias("canonical"))
    s = s.withColumn("section", F.regexp_extract(urls.path_of(F.col("canonical")), r"^/([^/]*)", 1))
    kept = frontier.keep_best(s, ["section", "canonical"], F.struct("list_ord", "sitemap_id"))
    return kept.groupBy("section").agg(F.count(F.lit(1)).alias("n_urls"), F.min("sitemap_id").alias("first_id"))


def pages_untabled(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "scraped_pages").where("content IS NOT NULL")
    return t.select("page_id", F.length(p.untabled(F.col("content"))).alias("n_chars"))


QUERIES = {
    "unseen_urls": unseen_urls, "cache_refreshed": cache_refreshed, "category_mentions": category_mentions, "news_since": news_since, "json_repaired": json_repaired, "links_of_summaries": links_of_summaries,
    "saved_formats": saved_formats, "title_parts": title_parts, "document_dates": document_dates, "fetch_plan": fetch_plan, "first_of_section": first_of_section, "pages_untabled": pages_untabled,
}
_FORMS = "".join(f" WHEN regexp_matches(head, '{pattern}') THEN {{'form': '{name}', 'url': regexp_replace(regexp_extract(head, '{pattern}', 1), '[.,;)*]+$', '')}}" for name, pattern in p.URL_FORMS)
SQL = {
    "unseen_urls": f"""WITH s AS (SELECT site_id, {CANONICAL_SQL} AS c FROM sitemap WHERE url IS NOT NULL), k AS (SELECT {CANONICAL_SQL} AS c FROM documents WHERE url IS NOT NULL UNION SELECT {CANONICAL_SQL} FROM scraped_pages WHERE url IS NOT NULL)
SELECT site_id, count(*) AS n_rows, count(DISTINCT c) AS n_urls FROM s WHERE c NOT IN (SELECT c FROM k) GROUP BY site_id""",
    "cache_refreshed": """WITH d AS (SELECT url, coalesce(title, '') AS t FROM documents WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1)
SELECT page_id, CASE WHEN d.url IS NULL THEN 'fetched' ELSE 'snapshot' END AS origin, CASE WHEN d.url IS NULL THEN coalesce(p.title, '') ELSE d.t END AS title FROM scraped_pages AS p LEFT JOIN d USING (url) WHERE p.url IS NOT NULL""",
    "category_mentions": """WITH n AS (SELECT category FROM faq_pairs WHERE category IS NOT NULL UNION SELECT source FROM mix_targets WHERE source IS NOT NULL)
SELECT n.category, count(f.pair_id) AS n FROM n LEFT JOIN faq_pairs AS f ON f.category = n.category GROUP BY n.category""",
    "news_since": f"""WITH t AS (SELECT site, CAST(floor(epoch(published_at)) AS BIGINT) AS moment, strftime(ingested_at AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') < '{CUT}' AS early FROM documents WHERE site IS NOT NULL AND published_at IS NOT NULL),
m AS (SELECT site, max(moment) AS known FROM t WHERE early GROUP BY site)
SELECT site, count(*) FILTER (known IS NULL OR moment > known) AS n_new, greatest(max(known), max(moment)) AS mark FROM t LEFT JOIN m USING (site) GROUP BY site""",
    "json_repaired": "SELECT pair_id, coalesce(question, '?') AS question, coalesce(answer, '') AS answer FROM faq_pairs",
    "links_of_summaries": "SELECT site_id, CAST(row_number() OVER (PARTITION BY site_id, list_ord // 100 ORDER BY list_ord, sitemap_id) - 1 AS INTEGER) AS pos, sitemap_id, url, title FROM sitemap WHERE url IS NOT NULL",
    "saved_formats": f"""WITH h AS (SELECT left(content, 3000) AS head FROM scraped_pages WHERE content IS NOT NULL), f AS (SELECT CASE{_FORMS} END AS x FROM h)
SELECT coalesce(x.form, 'none') AS form, count(*) AS n_files, count(DISTINCT x.url) AS n_urls FROM f GROUP BY 1""",
    "title_parts": r"""WITH s AS (SELECT sitemap_id, left(trim(regexp_replace(regexp_replace(CASE WHEN sitemap_id % 5 = 0 THEN title ELSE title || '_PAGE' || sitemap_id % 5 || CASE WHEN sitemap_id % 5 > 2 THEN 'B' ELSE '' END END, '["''„“”‚‘’]', '', 'g'), '\s+', ' ', 'g'), ' '), 200) AS t FROM sitemap WHERE title IS NOT NULL)
SELECT sitemap_id, regexp_replace(t, '_PAGE(\d+)([A-Z]{0,2})$', '') AS base, TRY_CAST(nullif(regexp_extract(t, '_PAGE(\d+)([A-Z]{0,2})$', 1), '') AS INTEGER) AS page, nullif(regexp_extract(t, '_PAGE(\d+)([A-Z]{0,2})$', 2), '') AS letters FROM s""",
    "document_dates": r"""SELECT coalesce(TRY_CAST(nullif(left(regexp_extract(text, '(\d{4}-\d{2}-\d{2})', 1), 4), '') AS INTEGER), CAST(year(published_at AT TIME ZONE 'UTC') AS INTEGER), 0) AS year, count(*) AS n_docs, CAST(sum(CASE WHEN length(text) > 200 THEN 203 ELSE length(text) END) AS BIGINT) AS n_chars FROM documents WHERE text IS NOT NULL GROUP BY 1""",
    "fetch_plan": r"""WITH b AS (SELECT site_id, regexp_replace(regexp_replace(lower(base_url), '/+$', ''), '://www\.', '://') AS bare FROM site_config),
f AS (SELECT DISTINCT site_id, h || x AS form FROM (SELECT site_id, unnest([bare, replace(bare, '://', '://www.')]) AS h FROM b), (SELECT unnest(['', '/', '/index.html', '/index.htm', '/index.php']) AS x))
SELECT s.site_id, CASE WHEN url IS NULL OR NOT regexp_matches(url, '(?i)^https?://[^/]') THEN 'none' WHEN f.form IS NOT NULL THEN 'base' ELSE 'page' END AS what, count(*) AS n
FROM sitemap AS s LEFT JOIN f ON f.site_id = s.site_id AND f.form = lower(regexp_replace(s.url, '[?#].*$', '')) GROUP BY ALL""",
    "first_of_section": rf"""WITH s AS (SELECT sitemap_id, list_ord, {CANONICAL_SQL} AS url FROM sitemap WHERE url IS NOT NULL),
c AS (SELECT sitemap_id, regexp_extract(regexp_extract(url, '^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)', 1), '^/([^/]*)', 1) AS section, url, list_ord FROM s),
k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY section, url ORDER BY list_ord, sitemap_id) = 1)
SELECT section, count(*) AS n_urls, min(sitemap_id) AS first_id FROM k GROUP BY section""",
    "pages_untabled": r"""SELECT page_id, CAST(length(trim(regexp_replace(regexp_replace(regexp_replace(content, '(?is)<table\b.*?</table\s*>', ' [TABLE DATA] ', 'g'), '<[^<>]*>', ' ', 'g'), '\s+', ' ', 'g'), ' ')) AS INTEGER) AS n_chars FROM scraped_pages WHERE content IS NOT NULL""",
}
