"""Queries on credentials in code (problem 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import credentials


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return credentials.find(table(spark, d, "code_files"))


def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    return credentials.redact(table(spark, d, "code_files"))


QUERIES = {"p3_found": p3_found, "p3_redacted": p3_redacted}
SQL: dict[str, str] = {}
