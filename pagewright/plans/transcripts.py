"""Queries on chatbot transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import estimated_tokens
from ..operators import transcripts as t
from ..sources.tables import table


def transcript_messages(spark: SparkSession, d: str) -> DataFrame:
    m = t.messages(table(spark, d, "faq_pairs"))
    return m.groupBy("project", "role").agg(F.count(F.lit(1)).alias("n_messages"), F.sum(F.length("content")).alias("n_chars"))


def transcript_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = t.paired(t.messages(table(spark, d, "faq_pairs")))
    return p.where(t.usable(F.col("question"), F.col("answer"))).select("transcript_id", "question_seq", "answer_seq", (F.length("question") + F.length("answer")).alias("n_chars"))


def transcript_dump(spark: SparkSession, d: str) -> DataFrame:
    return t.text_dump(t.messages(table(spark, d, "faq_pairs")))


def pair_keep_last(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "faq_pairs").select("pair_id", "question", "answer")
    return t.keep_last(p, ["question", "answer"], "pair_id").select("pair_id")


def questions_by_category(spark: SparkSession, d: str) -> DataFrame:
    """How many distinct questions each category has, the first and the last of them in order of their texts."""
    p = table(spark, d, "faq_pairs").where("question IS NOT NULL").select(F.coalesce("category", F.lit("Nezařazeno")).alias("category"), "question").distinct()
    ranked = p.groupBy("category").agg(F.count(F.lit(1)).alias("n_questions"), F.min("question").alias("first_question"), F.max("question").alias("last_question"))
    return ranked


def category_report(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of each category, for the categories that questions of other transcripts have as well."""
    p = table(spark, d, "faq_pairs")
    categories = p.where("category IS NOT NULL").select("category").unionByName(table(spark, d, "documents").where("source IS NOT NULL").select(F.lower(F.trim("source")).alias("category"))).distinct()
    return t.category_report(p, categories)


def project_summary(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "faq_pairs")
    said = F.length(F.trim(F.coalesce("answer", F.lit("")))) > 0
    return p.groupBy("project").agg(F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("transcript_id").alias("n_transcripts"), F.count_if(said).alias("n_answered"), F.sum(estimated_tokens(F.coalesce("answer", F.lit("")))).alias("answer_tokens"))


def pair_batches(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "faq_pairs").where(t.usable(F.col("question"), F.col("answer"))).select("project", "pair_id")
    return t.batches(p, "project", "pair_id").groupBy("project", "batch").agg(F.count(F.lit(1)).alias("n_pairs"), F.min("pair_id").alias("first_pair"))


QUERIES = {
    "transcript_messages": transcript_messages, "transcript_pairs": transcript_pairs, "transcript_dump": transcript_dump, "pair_keep_last": pair_keep_last,
    "questions_by_category": questions_by_category, "category_report": category_report, "project_summary": project_summary, "pair_batches": pair_batches,
}
MESSAGES_SQL = "m AS (SELECT project, transcript_id, pair_id, pair_seq * 2 AS seq, 'HUMAN' AS role, question AS content FROM faq_pairs WHERE question IS NOT NULL AND transcript_id IS NOT NULL UNION ALL SELECT project, transcript_id, pair_id, pair_seq * 2 + 1, 'BOT', answer FROM faq_pairs WHERE answer IS NOT NULL AND transcript_id IS NOT NULL)"
USABLE_SQL = "length(trim(question, ' ')) > 0 AND length(question) < 1000 AND length(trim(answer, ' ')) > 0 AND length(answer) < 1000"
ANSWER_SQL = "coalesce(answer, '')"
TOKENS_SQL = "CASE WHEN {0} = '' THEN 0 ELSE greatest(1, CAST(floor(length({0}) / 3.2::DOUBLE) AS INTEGER)) END"
SQL = {
    "transcript_messages": f"WITH {MESSAGES_SQL} SELECT project, role, count(*) AS n_messages, CAST(sum(length(content)) AS BIGINT) AS n_chars FROM m GROUP BY project, role",
    "transcript_pairs": f"""WITH {MESSAGES_SQL}, w AS (SELECT *, lag(role) OVER o AS r, lag(seq) OVER o AS s, lag(content) OVER o AS question, content AS answer FROM m WINDOW o AS (PARTITION BY transcript_id ORDER BY seq, pair_id))
SELECT transcript_id, s AS question_seq, seq AS answer_seq, CAST(length(question) + length(answer) AS INTEGER) AS n_chars FROM w WHERE role = 'BOT' AND r = 'HUMAN' AND {USABLE_SQL}""",
    "transcript_dump": f"WITH {MESSAGES_SQL} SELECT transcript_id, seq // 1000 AS part, CAST(count(*) AS INTEGER) AS n_messages, string_agg(role || ': ' || content, chr(10) || '----------' || chr(10) ORDER BY seq, pair_id) AS dump FROM m GROUP BY transcript_id, part",
    "pair_keep_last": "SELECT max(pair_id) AS pair_id FROM faq_pairs GROUP BY question, answer",
    "questions_by_category": "WITH p AS (SELECT DISTINCT coalesce(category, 'Nezařazeno') AS category, question FROM faq_pairs WHERE question IS NOT NULL) SELECT category, count(*) AS n_questions, min(question) AS first_question, max(question) AS last_question FROM p GROUP BY category",
    "category_report": "WITH c AS (SELECT category FROM faq_pairs WHERE category IS NOT NULL UNION SELECT lower(trim(source, ' ')) FROM documents WHERE source IS NOT NULL), n AS (SELECT c.category, count(p.category) AS n FROM c LEFT JOIN faq_pairs p ON p.category = c.category GROUP BY c.category) SELECT category, n, CAST(round(n / sum(n) OVER (), 6) AS DOUBLE) AS share FROM n",
    "project_summary": f"SELECT project, count(*) AS n_pairs, count(DISTINCT transcript_id) AS n_transcripts, count(*) FILTER (length(trim(coalesce(answer, ''), ' ')) > 0) AS n_answered, CAST(sum({TOKENS_SQL.format(ANSWER_SQL)}) AS BIGINT) AS answer_tokens FROM faq_pairs GROUP BY project",
    "pair_batches": f"WITH b AS (SELECT project, pair_id, CAST(floor((row_number() OVER (PARTITION BY project ORDER BY pair_id) - 1) / 100) AS INTEGER) AS batch FROM faq_pairs WHERE {USABLE_SQL}) SELECT project, batch, count(*) AS n_pairs, min(pair_id) AS first_pair FROM b GROUP BY project, batch",
}
