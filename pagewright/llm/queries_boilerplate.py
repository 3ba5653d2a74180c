"""Queries on page boilerplate (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import boilerplate


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.boilerplate_lines(table(spark, d, "scraped_pages"), table(spark, d, "site_config"))


def p5_reasons(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.reasons(table(spark, d, "scraped_pages"), table(spark, d, "site_config"))


def p5_main_content(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.main_content(table(spark, d, "scraped_pages"), table(spark, d, "site_config"))


QUERIES = {"p5_found": p5_found, "p5_reasons": p5_reasons, "p5_main_content": p5_main_content}
SQL: dict[str, str] = {}
