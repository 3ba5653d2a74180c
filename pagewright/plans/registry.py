"""All queries of the core library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import documents, feeds, fetched, frontier, pages, payloads, records, streams, tables, timestamps, transcripts

MODULES = (frontier, tables, fetched, transcripts, documents, pages, payloads, records, feeds, streams, timestamps)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}


def flagship(spark: SparkSession, directory: str) -> DataFrame:
    return timestamps.p2_found(spark, directory)
