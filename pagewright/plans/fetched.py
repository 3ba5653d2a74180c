"""Queries on what was fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import fetched as f
from ..sources.tables import table
from .frontier import CANONICAL_SQL, HOST_SQL


def fetch_tally(spark: SparkSession, d: str) -> DataFrame:
    return f.tally(table(spark, d, "scraped_pages"), "provider", "content")


def provider_choice(spark: SparkSession, d: str) -> DataFrame:
    return f.chosen_provider(table(spark, d, "scraped_pages"), table(spark, d, "site_config"))


def written_links(spark: SparkSession, d: str) -> DataFrame:
    return f.written_links(table(spark, d, "scraped_pages"), "content", "base_url")


def url_set_sizes(spark: SparkSession, d: str) -> DataFrame:
    """URLs that the sitemaps list against those that were scraped or made documents."""
    listed = table(spark, d, "sitemap").select(urls.canonical(F.col("url")).alias("url"))
    had = table(spark, d, "scraped_pages").select(urls.canonical(F.col("url")).alias("url")).unionByName(table(spark, d, "documents").select(urls.canonical(F.col("url")).alias("url")))
    return f.set_sizes(listed, had, "url")


QUERIES = {"fetch_tally": fetch_tally, "provider_choice": provider_choice, "written_links": written_links, "url_set_sizes": url_set_sizes}
SITE_SQL = r"regexp_replace(regexp_replace(regexp_replace(lower(trim(base_url, ' ')), '^[a-z][a-z0-9+.\-]*://', ''), '^www\.', ''), '/+$', '')"
SQL = {
    "fetch_tally": """WITH s AS (SELECT provider, CASE WHEN content IS NULL THEN 'failed' WHEN trim(content, ' ') = '' THEN 'skipped' ELSE 'ok' END AS s FROM scraped_pages)
SELECT provider, count(*) FILTER (s = 'ok') AS n_ok, count(*) FILTER (s = 'skipped') AS n_skipped, count(*) FILTER (s = 'failed') AS n_failed, CAST(round(count(*) FILTER (s = 'ok') / count(*), 6) AS DOUBLE) AS success_rate FROM s GROUP BY provider""",
    "provider_choice": rf"""WITH o AS (SELECT {SITE_SQL} AS site, string_split_regex(provider_sequence, '\s*,\s*') AS seq FROM site_config),
p AS (SELECT url, page_id, provider, {SITE_SQL} AS site FROM scraped_pages WHERE url IS NOT NULL AND content IS NOT NULL)
SELECT url, page_id, provider FROM p LEFT JOIN o USING (site) QUALIFY row_number() OVER (PARTITION BY url ORDER BY CASE WHEN list_contains(seq, provider) THEN list_position(seq, provider) ELSE 1000000 END, provider, page_id DESC) = 1""",
    "written_links": rf"""WITH t AS (SELECT {SITE_SQL} AS site, unnest(regexp_extract_all(content, 'https?://[^\s<>"''()\[\]{{}}|]+')) AS raw FROM scraped_pages WHERE contains(content, '://')),
u AS (SELECT DISTINCT site, split_part(regexp_replace(raw, '[.,;:!?*]+$', ''), '#', 1) AS url FROM t) SELECT site, url AS target FROM u WHERE {HOST_SQL} = site""",
    "url_set_sizes": f"""WITH a AS (SELECT DISTINCT {CANONICAL_SQL} AS u FROM sitemap WHERE url IS NOT NULL), b AS (SELECT DISTINCT {CANONICAL_SQL} AS u FROM (SELECT url FROM scraped_pages UNION ALL SELECT url FROM documents) WHERE url IS NOT NULL)
SELECT count(a.u) AS n_left, count(b.u) AS n_right, count(*) FILTER (a.u = b.u) AS n_both, count(*) FILTER (b.u IS NULL) AS n_left_only, count(*) FILTER (a.u IS NULL) AS n_right_only FROM a FULL OUTER JOIN b ON a.u = b.u""",
}
