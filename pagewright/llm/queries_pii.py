"""Queries on personal information (problem 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import pii


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(table(spark, d, "documents"))


def p8_masked(spark: SparkSession, d: str) -> DataFrame:
    return pii.masked(table(spark, d, "documents"))


QUERIES = {"p8_found": p8_found, "p8_masked": p8_masked}
SQL: dict[str, str] = {}
