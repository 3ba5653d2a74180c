"""Queries on evaluation texts in training documents (problem 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import leakage


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p6_by_task(spark: SparkSession, d: str) -> DataFrame:
    """How many items and documents each task and split has leaked."""
    items = table(spark, d, "eval_items")
    found = leakage.leaks(table(spark, d, "documents"), items).join(items.select("item_id", "task", "split_name"), "item_id")
    return found.groupBy("task", "split_name").agg(F.countDistinct("item_id").alias("n_items"), F.countDistinct("doc_id").alias("n_docs"), F.count(F.lit(1)).alias("n_pairs"))


QUERIES = {"p6_found": p6_found, "p6_by_task": p6_by_task}
WORDS_SQL = r"list_filter(string_split_regex(strip_accents(lower(text)), '[^\p{L}\p{N}]+'), lambda w : w <> '')"
LEAKS_SQL = f"""WITH i AS (SELECT item_id, {WORDS_SQL} AS w FROM eval_items WHERE text IS NOT NULL), d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents WHERE text IS NOT NULL),
n AS (SELECT item_id, least(12, len(w)) AS n, w FROM i WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS passage FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM n)),
dw AS (SELECT DISTINCT doc_id, s.n AS n, array_to_string(w[k : k + s.n - 1], ' ') AS passage FROM (SELECT doc_id, w, z.n AS n, unnest(range(1, len(w) - z.n + 2)) AS k FROM d, (SELECT DISTINCT n FROM n) AS z) AS s),
found AS (SELECT DISTINCT doc_id, item_id FROM iw JOIN dw USING (n, passage))
"""
SQL = {
    "p6_found": LEAKS_SQL + "SELECT doc_id, item_id FROM found",
    "p6_by_task": LEAKS_SQL + "SELECT task, split_name, count(DISTINCT item_id) AS n_items, count(DISTINCT doc_id) AS n_docs, count(*) AS n_pairs FROM found JOIN eval_items USING (item_id) GROUP BY ALL",
}
