"""Queries on scraped pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sites import site_key
from ..operators import pages
from ..session import spread
from ..sources.tables import table
from .frontier import FILES, HOST_SQL, PATH_SQL, QUERY_SQL


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of each HTML page and how many lead on."""
    found = pages.links(table(spark, d, "scraped_pages"))
    return found.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"), F.count("target").alias("n_targets"), F.min("target").alias("first_target"))


def page_inner_links(spark: SparkSession, d: str) -> DataFrame:
    """The link graph of the sites: pages that each target is linked from."""
    return pages.inner_links(table(spark, d, "scraped_pages")).groupBy("target").agg(F.count(F.lit(1)).alias("n_pages"))


def page_crawl_links(spark: SparkSession, d: str) -> DataFrame:
    """Links worth a crawl: news and offices, but neither their archive nor what is under the official board."""
    found = pages.inner_links(table(spark, d, "scraped_pages"), ("/uredni-deska",), ("^/aktuality", "^/urad"), ("archiv", "-0$"))
    return found.groupBy("target").agg(F.count(F.lit(1)).alias("n_pages"))


def page_markdown(spark: SparkSession, d: str) -> DataFrame:
    """HTML pages as Markdown without what their site's selectors name."""
    sites = table(spark, d, "site_config").select(site_key(F.col("base_url")).alias("site"), "remove_selectors")
    p = spread(table(spark, d, "scraped_pages").where("content IS NOT NULL").select("page_id", "base_url", "content")).withColumn("site", site_key(F.col("base_url")))
    joined = p.join(sites, "site", "left")
    return pages.as_markdown(joined, F.col("remove_selectors"))


def document_chunks(spark: SparkSession, d: str) -> DataFrame:
    return pages.chunks(table(spark, d, "documents"), "doc_id", "text")


def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    """Chunks with headers, as they are saved, and the words of the chunk before as a lead."""
    docs = table(spark, d, "documents")
    return pages.with_headers(pages.chunks(docs, "doc_id", "text"), docs, "doc_id")


def chunk_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of each document, counted over its chunks: none is lost or doubled."""
    c = pages.chunks(table(spark, d, "documents"), "doc_id", "text")
    return c.groupBy("doc_id").agg(F.sum(F.regexp_count("content", F.lit(r"\S+"))).alias("n_words"))


def page_sections(spark: SparkSession, d: str) -> DataFrame:
    s = pages.sections(table(spark, d, "scraped_pages"), "page_id", "content", 2000)
    return s.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_sections"), F.max(F.length("content")).alias("longest"))


QUERIES = {"page_links": page_links, "page_inner_links": page_inner_links, "page_crawl_links": page_crawl_links, "page_markdown": page_markdown, "document_chunks": document_chunks, "chunk_documents": chunk_documents, "chunk_words": chunk_words, "page_sections": page_sections}
HREF = r"""(?i)<a\s[^<>]*?href\s*=\s*["'']([^"'']*)["'']"""
INNER_SQL = rf"""WITH l AS (SELECT page_id, base_url, coalesce(url, base_url) AS base, unnest(regexp_extract_all(content, '{HREF}', 1)) AS href FROM scraped_pages WHERE contains(lower(content), '<a ')),
t AS (SELECT page_id, base_url, CASE WHEN regexp_matches(href, '(?i)^(?:#|$|mailto:|tel:|javascript:|data:)') THEN NULL WHEN regexp_matches(href, '^[a-zA-Z][\w+.-]*:') THEN split_part(href, '#', 1)
  WHEN starts_with(href, '/') THEN split_part(regexp_extract(base, '^([a-zA-Z][\w+.-]*://[^/?#]*)', 1) || href, '#', 1) ELSE 'other' END AS url FROM l),
h AS (SELECT page_id, url, {HOST_SQL} AS host, {PATH_SQL} AS path, {QUERY_SQL} AS query, {HOST_SQL.replace("(url,", "(base_url,")} AS own FROM t WHERE url IS NOT NULL),
i AS (SELECT * FROM h WHERE host = own AND NOT (path IN ('', '/') AND query = '') AND NOT (regexp_matches(lower(path), '\.(?:{FILES})$') OR (regexp_matches(lower(path), '\.(?:ashx|aspx|jsp|php)$') AND regexp_matches(lower(query), 'id_dokumenty|file|download'))))
"""
SQL = {
    "page_links": rf"""WITH l AS (SELECT page_id, base_url, coalesce(url, base_url) AS base, unnest(regexp_extract_all(content, '{HREF}', 1)) AS href FROM scraped_pages WHERE contains(lower(content), '<a ')),
t AS (SELECT page_id, CASE WHEN regexp_matches(href, '(?i)^(?:#|$|mailto:|tel:|javascript:|data:)') THEN NULL WHEN regexp_matches(href, '^[a-zA-Z][\w+.-]*:') THEN split_part(href, '#', 1)
  WHEN starts_with(href, '/') THEN split_part(regexp_extract(base, '^([a-zA-Z][\w+.-]*://[^/?#]*)', 1) || href, '#', 1) ELSE 'other' END AS target FROM l)
SELECT page_id, count(*) AS n_links, count(target) AS n_targets, min(target) AS first_target FROM t GROUP BY page_id""",
    "page_inner_links": INNER_SQL + "SELECT url AS target, count(DISTINCT page_id) AS n_pages FROM i GROUP BY url",
    "page_crawl_links": INNER_SQL + "SELECT url AS target, count(DISTINCT page_id) AS n_pages FROM i WHERE regexp_matches(path, '^/aktuality|^/urad') AND NOT regexp_matches(path, 'archiv|-0$') AND NOT (rtrim(path, '/') = '/uredni-deska' OR starts_with(path, '/uredni-deska/')) GROUP BY url",
    "chunk_words": r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS n_words FROM documents WHERE regexp_matches(text, '\S')",
}
