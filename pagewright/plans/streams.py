"""Queries that run streams to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import as_ntz
from ..sources.tables import table
from ..streaming import jobs


def stream_latest_pages(spark: SparkSession, d: str) -> DataFrame:
    """The newest crawl of each page's URL, kept by a stream of crawls."""
    path = f"{d}/scraped_pages.parquet"
    s = jobs.read_stream(spark, path, table(spark, d, "scraped_pages").schema)
    rows = s.where("url IS NOT NULL").select("url", "page_id", F.unix_seconds("fetched_at").alias("at"))
    newest = jobs.latest_by_key(rows, ["url"], F.struct(-F.col("at"), -F.col("page_id")))
    return newest.select("url", "page_id")


def stream_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """Sitemap rows by the hour of their arrival and site, counted by a windowed stream, however late a row is."""
    path = f"{d}/sitemap.parquet"
    s = jobs.read_stream(spark, path, table(spark, d, "sitemap").schema)
    counts = jobs.window_counts(s.select("site_id", "ingested_at"), "ingested_at", "site_id", "1 hour")
    return counts.select(F.left(as_ntz(F.col("start")).cast("string"), F.lit(16)).alias("hour"), "site_id", "n")


QUERIES = {"stream_latest_pages": stream_latest_pages, "stream_arrivals": stream_arrivals}
SQL = {
    "stream_latest_pages": "SELECT url, page_id FROM scraped_pages WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY date_trunc('second', fetched_at) DESC, page_id DESC) = 1",
    "stream_arrivals": "SELECT strftime(date_trunc('hour', ingested_at AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M') AS hour, site_id, count(*) AS n FROM sitemap WHERE ingested_at IS NOT NULL GROUP BY ALL",
}
