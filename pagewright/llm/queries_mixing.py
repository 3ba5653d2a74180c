"""Queries on mixtures of sources (problem 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import mixing


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.out_of_reach(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_curriculum(spark: SparkSession, d: str) -> DataFrame:
    """A curriculum whose often repeated sources grow towards the end while the others shrink."""
    targets = table(spark, d, "mix_targets")
    end = F.when(F.col("max_repeat") > 2, 2.0).otherwise(0.5)
    knots = F.array(F.struct(F.lit(0.0).alias("t"), F.lit(1.0).alias("w")), F.struct(F.lit(0.5).alias("t"), F.lit(1.0).alias("w")), F.struct(F.lit(1.0).alias("t"), end.alias("w")))
    return mixing.curriculum(table(spark, d, "documents"), targets, targets.select("source", knots.alias("knots")))


QUERIES = {"p7_found": p7_found, "p7_shares": p7_shares, "p7_curriculum": p7_curriculum}
# the answer is the same for any usual tokenizer, so SQL counts words and signs
SQL = {
    "p7_found": r"""WITH n AS (SELECT lower(trim(source, ' ')) AS name, CAST(len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]{1,4}|[^\s\p{L}\p{N}]')) AS DOUBLE) AS n FROM documents),
s AS (SELECT name, sum(n) AS available FROM n GROUP BY name)
SELECT DISTINCT t.source FROM mix_targets AS t LEFT JOIN s ON s.name = lower(trim(t.source, ' '))
WHERE coalesce(s.available, 0) * t.max_repeat < t.target_share * (SELECT sum(n) FROM n)""",
}
