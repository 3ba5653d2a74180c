"""Queries on lines repeated within a site (problem 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import site_lines


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.repeated_lines(table(spark, d, "scraped_pages"))


def p4_cleaned(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "scraped_pages")
    return site_lines.without_lines(pages, site_lines.repeated_lines(pages))


def p4_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.outcomes(table(spark, d, "scraped_pages"))


QUERIES = {"p4_found": p4_found, "p4_cleaned": p4_cleaned, "p4_outcomes": p4_outcomes}
NORMAL = r"""regexp_replace(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\s\p{Z}]+', ' ', 'g'), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g')"""
SQL = {
    "p4_found": rf"""
WITH pages AS (
  SELECT page_id, coalesce(url, '') AS url, content,
         regexp_replace(regexp_replace(regexp_replace(lower(trim(base_url)), '^[a-z][a-z0-9+.\-]*://', ''), '^www\.', ''), '/+$', '') AS site
  FROM scraped_pages WHERE content IS NOT NULL),
lines AS (
  SELECT page_id, site, url, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS line_no FROM pages),
normal AS (
  SELECT page_id, site, url, CAST(line_no AS INTEGER) AS line_no, {NORMAL} AS norm FROM lines
  WHERE NOT (contains(line, '<') AND trim(regexp_replace(line, '<[^<>]*>', '', 'g')) = '')),
long AS (SELECT * FROM normal WHERE length(regexp_replace(norm, '\P{{L}}+', '', 'g')) >= 12),
often AS (SELECT site, norm FROM long GROUP BY site, norm HAVING count(DISTINCT url) >= 10)
SELECT DISTINCT page_id, line_no FROM long JOIN often USING (site, norm)"""
}
SQL["p4_cleaned"] = SQL["p4_found"].replace("SELECT DISTINCT page_id", ", cut AS (SELECT DISTINCT page_id") + """),
kept AS (
  SELECT page_id, string_agg(line, chr(10) ORDER BY n) AS content, count(*) AS n_kept
  FROM (SELECT page_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS n FROM pages) AS l
  WHERE NOT EXISTS (SELECT 1 FROM cut WHERE cut.page_id = l.page_id AND cut.line_no = l.n) GROUP BY page_id)
SELECT p.page_id, CASE WHEN p.content IS NULL THEN NULL ELSE coalesce(k.content, '') END AS content,
       coalesce(CAST(len(string_split(p.content, chr(10))) - coalesce(k.n_kept, 0) AS INTEGER), 0) AS n_cut
FROM scraped_pages AS p LEFT JOIN kept AS k USING (page_id)"""
