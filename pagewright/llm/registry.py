"""All queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    queries_boilerplate,
    queries_credentials,
    queries_leakage,
    queries_mixing,
    queries_pairs,
    queries_pii,
    queries_site_lines,
)

MODULES = (queries_pairs, queries_credentials, queries_site_lines, queries_boilerplate, queries_leakage, queries_mixing, queries_pii)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
