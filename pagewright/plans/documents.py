"""Queries on document texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import estimated_tokens
from ..operators import documents as docs
from ..sources.tables import table
from .transcripts import TOKENS_SQL


def token_bands(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("text IS NOT NULL").select(F.lower(F.trim("source")).alias("source"), estimated_tokens(F.col("text")).alias("tokens"))
    return t.groupBy("source", docs.band(F.col("tokens")).alias("band")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("tokens"))


def structure_counts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("text IS NOT NULL")
    return t.select("doc_id", F.inline(F.array(docs.structure(F.col("text")))))


def page_quality(spark: SparkSession, d: str) -> DataFrame:
    """Pages by provider and quality, the text's share taken of the page as fetched."""
    p = table(spark, d, "scraped_pages")
    markdown = F.length(F.trim(F.regexp_replace("content", r"<[^<>]*>", "")))
    return p.groupBy("provider", docs.quality(markdown, F.length("content")).alias("quality")).agg(F.count(F.lit(1)).alias("n_pages"))


def markdown_cleaned(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "scraped_pages").where("content IS NOT NULL")
    return p.select("page_id", docs.cleaned(F.col("content")).alias("content"))


def header_budgets(spark: SparkSession, d: str) -> DataFrame:
    """Header budgets of each site's chunk size, and how many documents of the site exceed it."""
    s = table(spark, d, "site_config").select("site_id", F.regexp_replace("base_url", r"^https?://", "").alias("site"), "max_chunk_size")
    n = table(spark, d, "documents").where("text IS NOT NULL").select("site", estimated_tokens(F.col("text")).alias("tokens"))
    over = n.join(s, "site").where("tokens > max_chunk_size").groupBy("site_id").agg(F.count(F.lit(1)).alias("n_over"))
    return s.join(over, "site_id", "left").na.fill(0, ["n_over"]).select("site_id", "n_over", F.inline(F.array(docs.budgets(F.col("max_chunk_size")))))


def first_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Summaries of 40 tokens at sentence ends."""
    t = table(spark, d, "event_items").where("summary IS NOT NULL")
    return t.select("event_id", docs.first_sentences(F.col("summary"), 40).alias("summary"))


def document_headers(spark: SparkSession, d: str) -> DataFrame:
    """Documents under 300 tokens with as much of a header as fits: which parts had to go, and what is left."""
    t = table(spark, d, "documents").where("text IS NOT NULL")
    header = F.concat_ws("\n", F.concat(F.lit("# "), "title"), F.concat(F.lit("## URL: "), "url"))
    summaries = [F.concat(F.lit("## SITE: "), "site"), F.concat(F.lit("## SOURCE: "), F.trim("source")), F.concat(F.lit("## BEGINS: "), F.left("text", F.lit(120)))]
    fitted = docs.fitted_document(header, summaries, F.concat(F.lit("# QUESTION: "), "title"), F.col("text"), 300)
    return t.select("doc_id", F.inline(F.array(fitted))).select("doc_id", "stage", F.length("document").alias("n_chars"))


def table_rows(spark: SparkSession, d: str) -> DataFrame:
    return docs.table_rows(table(spark, d, "scraped_pages"), "page_id", "content")


def json_keys(spark: SparkSession, d: str) -> DataFrame:
    """Top-level keys of JSON files by number of files, a missing language read off the path."""
    lang = F.coalesce(F.nullif(F.lower(F.trim("file_lang")), F.lit("")), F.lower(F.regexp_extract("file_path", r"\.(\w+)$", 1)))
    f = table(spark, d, "code_files").where((lang == "json") & F.col("body").isNotNull()).select("file_id", F.json_object_keys("body").alias("keys"))
    return f.where("keys IS NOT NULL").select("file_id", F.explode("keys").alias("key")).groupBy("key").agg(F.countDistinct("file_id").alias("n_files"))


QUERIES = {
    "token_bands": token_bands, "structure_counts": structure_counts, "page_quality": page_quality, "markdown_cleaned": markdown_cleaned,
    "header_budgets": header_budgets, "first_sentences": first_sentences, "table_rows": table_rows, "json_keys": json_keys, "document_headers": document_headers,
}
_ENTITY_SQL = "content"
for _e, _c in docs.ENTITIES:
    _ENTITY_SQL = f"replace({_ENTITY_SQL}, '{_e}', '{_c.replace(chr(39), chr(39) * 2)}')"


def _count(p: str) -> str:
    return f"CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER)"


SQL = {
    "first_sentences": rf"""WITH e AS (SELECT event_id, summary, string_split(regexp_replace(summary, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s FROM event_items WHERE summary IS NOT NULL),
k AS (SELECT *, len(list_filter(range(1, len(s) + 1), lambda i : {TOKENS_SQL.format("array_to_string(s[1:i], ' ')")} <= 40)) AS n FROM e)
SELECT event_id, CASE WHEN {TOKENS_SQL.format('summary')} <= 40 THEN summary WHEN n > 0 THEN array_to_string(s[1:n], ' ') ELSE regexp_replace(regexp_replace(left(summary, 128), '\s*\S*$', ''), '[,;:\- ]+$', '') || ' …' END AS summary FROM k""",
    "token_bands": f"WITH t AS (SELECT lower(trim(source, ' ')) AS source, {TOKENS_SQL.format('text')} AS tokens FROM documents WHERE text IS NOT NULL) SELECT source, CASE WHEN tokens > 20000 THEN 'CRITICAL' WHEN tokens > 15000 THEN 'HIGH' WHEN tokens > 8000 THEN 'MODERATE' ELSE 'LOW' END AS band, count(*) AS n_docs, CAST(sum(tokens) AS BIGINT) AS tokens FROM t GROUP BY source, band",
    "structure_counts": rf"""WITH c AS (SELECT doc_id, {_count(r'(?m)^#{1,6}[ \t]+\S')} AS headings, {_count(r'(?m)^[ \t]*[-*+•][ \t]+\S')} AS bullets, {_count(r'(?m)^[ \t]*\d+[.)][ \t]+\S')} AS numbered, {_count(r'(?m)^[ \t]*\|.*\|[ \t]*$')} AS tables, {_count(r'(?m)^[^\n]*\S')} AS lines FROM documents WHERE text IS NOT NULL)
SELECT *, CASE greatest(headings, bullets, numbered, tables, lines) WHEN headings THEN 'headings' WHEN bullets THEN 'bullets' WHEN numbered THEN 'numbered' WHEN tables THEN 'tables' ELSE 'lines' END AS dominant FROM c""",
    "page_quality": """WITH p AS (SELECT provider, length(trim(regexp_replace(content, '<[^<>]*>', '', 'g'), ' ')) AS m, length(content) AS h FROM scraped_pages)
SELECT provider, CASE WHEN coalesce(m, 0) = 0 THEN 'empty' WHEN h < 2000 THEN 'good' WHEN m < 100 OR m / h < 0.02 THEN 'suspect' ELSE 'good' END AS quality, count(*) AS n_pages FROM p GROUP BY provider, quality""",
    "markdown_cleaned": rf"""SELECT page_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace({_ENTITY_SQL}, '&#\d+;', '', 'g'), '[ \t]+', ' ', 'g'), chr(10)), lambda x : trim(x, ' ')), lambda x : x <> ''), chr(10)) AS content FROM scraped_pages WHERE content IS NOT NULL""",
    "header_budgets": rf"""WITH s AS (SELECT site_id, regexp_replace(base_url, '^https?://', '') AS site, max_chunk_size AS m FROM site_config),
n AS (SELECT site_id, count(*) AS n_over FROM documents JOIN s USING (site) WHERE text IS NOT NULL AND {TOKENS_SQL.format('text')} > m GROUP BY site_id),
a AS (SELECT site_id, m - 100 AS avail, least((m - 100) // 4, 300) AS page FROM s), b AS (SELECT *, least((avail - page) // 3, 400) AS file FROM a), c AS (SELECT *, least((avail - page - file) // 2, 250) AS overlap FROM b)
SELECT site_id, coalesce(n_over, 0) AS n_over, CAST(page AS INTEGER) AS page, CAST(file AS INTEGER) AS file, CAST(overlap AS INTEGER) AS overlap, CAST(avail - page - file - overlap AS INTEGER) AS question FROM c LEFT JOIN n USING (site_id)""",
    "table_rows": r"""WITH p AS (SELECT page_id, string_split(content, chr(10)) AS x FROM scraped_pages WHERE contains(content, '|')),
l AS (SELECT page_id, CAST(generate_subscripts(x, 1) AS INTEGER) AS line_no, trim(regexp_replace(unnest(x), '<[^<>]*>', '', 'g'), ' ') AS line FROM p),
r AS (SELECT *, regexp_matches(line, '^\|.*\|$') AS is_row FROM l), q AS (SELECT *, lag(is_row, 1, false) OVER (PARTITION BY page_id ORDER BY line_no) AS prev FROM r),
h AS (SELECT *, last_value(CASE WHEN is_row AND NOT prev THEN line END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY line_no) AS header FROM q),
c AS (SELECT page_id, line_no, list_transform(string_split(regexp_replace(line, '^\||\|$', '', 'g'), '|'), lambda c : trim(c, ' ')) AS cells, list_transform(string_split(regexp_replace(header, '^\||\|$', '', 'g'), '|'), lambda c : trim(c, ' ')) AS names FROM h WHERE is_row AND prev AND NOT regexp_matches(line, '^\|(?:\s*:?-+:?\s*\|)+$'))
SELECT page_id, line_no, CAST(len(cells) AS INTEGER) AS n_cells, array_to_string(list_filter(list_transform(cells, lambda c, i : CASE WHEN c <> '' THEN coalesce(names[i], '') || ': ' || c END), lambda z : z IS NOT NULL), ' | ') AS record FROM c""",
    "json_keys": r"WITH f AS (SELECT file_id, unnest(json_keys(body)) AS key FROM code_files WHERE coalesce(nullif(lower(trim(file_lang, ' ')), ''), lower(regexp_extract(file_path, '\.(\w+)$', 1))) = 'json' AND body IS NOT NULL AND json_valid(body) AND json_type(body) = 'OBJECT') SELECT key, count(DISTINCT file_id) AS n_files FROM f GROUP BY key",
    "document_headers": f"""WITH d AS (SELECT doc_id, text, concat_ws(chr(10), '# ' || title, '## URL: ' || url) AS h, '## SITE: ' || site AS a, '## SOURCE: ' || trim(source, ' ') AS b, '## BEGINS: ' || left(text, 120) AS c, '# QUESTION: ' || title AS q FROM documents WHERE text IS NOT NULL),
l AS (SELECT *, chr(10) || chr(10) || text AS t, {TOKENS_SQL.format('text')} AS n FROM d),
s AS (SELECT doc_id, text, h, n, [concat_ws(chr(10), h, a, b, c, q) || t, concat_ws(chr(10), h, a, b, q) || t, concat_ws(chr(10), h, a, q) || t, concat_ws(chr(10), h, q) || t, h || t] AS v, CAST(floor((300 - n) * 3.2::DOUBLE) AS INTEGER) AS room FROM l),
f AS (SELECT *, list_position(list_transform(v, lambda x : {TOKENS_SQL.format('x')} <= 300), true) AS i, left(h, room) AS cut FROM s),
k AS (SELECT *, regexp_replace(cut, '\\n[^\\n]*$', '') AS line FROM f)
SELECT doc_id, CAST(CASE WHEN i IS NOT NULL THEN i - 1 WHEN room > 0 THEN 5 ELSE 6 END AS INTEGER) AS stage,
  CAST(CASE WHEN i IS NOT NULL THEN length(v[i]) WHEN room > 0 THEN 6 + length(text) + CASE WHEN contains(cut, chr(10)) AND length(line) > room // 2 THEN length(line) ELSE length(cut) END ELSE length(text) END AS INTEGER) AS n_chars FROM k""",
}
