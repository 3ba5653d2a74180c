"""Queries on written moments (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import zones
from ..sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return zones.moments_in_utc(table(spark, d, "sitemap"), table(spark, d, "event_items"), table(spark, d, "site_config"))


def p2_zones(spark: SparkSession, d: str) -> DataFrame:
    """Every site's offset history: the one taken, the best one without its declaration, and that declaration."""
    stamps = zones.project_stamps(table(spark, d, "sitemap"), table(spark, d, "event_items"))
    config = table(spark, d, "site_config")
    found = zones.site_zones(stamps, config).withColumnRenamed("source", "site_id")
    return found.join(config.select("site_id", F.col("time_zone").alias("declared")), "site_id", "left")


QUERIES = {"p2_found": p2_found, "p2_zones": p2_zones}
SQL: dict[str, str] = {}
