"""Queries on prompt and response pairs (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import pairs


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defects(table(spark, d, "faq_pairs"))


def p1_all_triggers(spark: SparkSession, d: str) -> DataFrame:
    return pairs.all_defects(table(spark, d, "faq_pairs"))


QUERIES = {"p1_found": p1_found, "p1_all_triggers": p1_all_triggers}
SQL: dict[str, str] = {}
