"""Queries on typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.timestamps import as_ntz
from ..operators import records as r
from ..sources.tables import table
from .frontier import CANONICAL_SQL
from .tables import CUT, LATE_SQL

LANGUAGES = ("Čeština", "English", "Deutsch", "Polski", "Slovenčina", "CZ", "EN", "DE", "PL", "SK")


def contacts(spark: SparkSession, d: str) -> DataFrame:
    return r.best_contacts(r.contact_rows(table(spark, d, "documents"))).withColumn("phone", F.col("phone").cast("string"))


def speaker_names(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "event_items").where("speakers IS NOT NULL").select("event_id", F.posexplode(F.split("speakers", r"\s*\|\s*")).alias("pos", "speaker"))
    return e.select("event_id", "pos", F.inline(F.array(r.name_parts(F.col("speaker")))))


def event_times(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "event_items").select("event_id", r.minutes_of(F.col("time_from")).alias("begins"), r.minutes_of(F.col("time_to")).alias("ends"))
    lasts = F.when(F.col("ends") >= F.col("begins"), F.col("ends") - F.col("begins"))
    return e.withColumn("lasts", lasts).na.fill(-1, ["begins", "ends", "lasts"])


def items_under_headings(spark: SparkSession, d: str) -> DataFrame:
    return r.under_headings(table(spark, d, "scraped_pages"), "page_id", "content")


def frontier_cap(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sitemap").where("url IS NOT NULL").select("site_id", urls.canonical(F.col("url")).alias("url")).distinct()
    return r.capped(s, "site_id", 100)


def removal_guard(spark: SparkSession, d: str) -> DataFrame:
    """Whether so many of a site's early URLs are missing later that cleaning up would be wrong."""
    s = table(spark, d, "sitemap").where("url IS NOT NULL").select("site_id", urls.canonical(F.col("url")).alias("url"), (as_ntz(F.col("ingested_at")) >= F.to_timestamp_ntz(F.lit(CUT))).alias("late"))
    k = s.groupBy("site_id", "url").agg(F.bool_or(~F.col("late")).alias("was"), F.bool_or("late").alias("now"))
    g = k.groupBy("site_id").agg(F.count_if("was").alias("n_before"), F.count_if(F.col("was") & ~F.col("now")).alias("n_removed"))
    return g.withColumn("blocked", F.col("n_removed") * 2 > F.col("n_before"))


def token_usage(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "scraped_pages")
    return p.groupBy("provider", F.left(as_ntz(F.col("fetched_at")).cast("string"), F.lit(10)).alias("day")).agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("most"))


def language_walls_cut(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "scraped_pages").where("content IS NOT NULL")
    cut = r.without_language_walls(F.col("content"), LANGUAGES)
    return p.select("page_id", F.length("content").alias("n_before"), F.length(cut).alias("n_after"))


def summary_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "event_items").groupBy("site_id", r.summary_verdict(F.col("summary")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "contacts": contacts, "speaker_names": speaker_names, "event_times": event_times, "items_under_headings": items_under_headings, "frontier_cap": frontier_cap,
    "removal_guard": removal_guard, "token_usage": token_usage, "language_walls_cut": language_walls_cut, "summary_verdicts": summary_verdicts,
}
WALL = r"^\s*(?:(?:" + "|".join(LANGUAGES) + r")[\s|,/·]*){2,}$"
PHONE = r"regexp_replace(regexp_replace(regexp_replace(p, '^[^0-9+(]*', ''), '[^0-9+]', '', 'g'), '^(?:\+|00)42[01]', '')"
IS_PHONE = rf"(regexp_matches(x, '{r.PHONE_FIELD}') AND regexp_matches(regexp_replace(x, '[^0-9]', '', 'g'), '^\d{{9,14}}$'))".replace(r"\u00a0", "\u00a0")
SQL = {
    "contacts": rf"""WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, CAST(generate_subscripts(x, 1) AS INTEGER) AS line_no, unnest(x) AS line FROM t),
f AS (SELECT doc_id, line_no, list_filter(list_transform(string_split_regex(regexp_replace(line, '^[\s\-*•|]+|[\s|]+$', '', 'g'), '\s*[|;]\s*'), lambda x : trim(x, ' ')), lambda x : x <> '') AS f FROM l WHERE regexp_matches(line, '[|;]') AND regexp_matches(line, '\d{{3}}|@')),
c AS (SELECT doc_id, line_no, list_filter(f, lambda x : NOT regexp_matches(x, '^{r.MAIL}$') AND NOT {IS_PHONE} AND regexp_matches(x, '\p{{L}}')) AS w, list_filter(f, lambda x : regexp_matches(x, '^{r.MAIL}$'))[1] AS email, list_filter(f, lambda x : {IS_PHONE})[1] AS p FROM f WHERE len(f) > 1),
n AS (SELECT doc_id, line_no, w[1] AS name, w[2] AS role, w[3] AS department, lower(email) AS email, CASE WHEN regexp_matches({PHONE}, '^\d{{9}}$') THEN {PHONE} END AS phone FROM c),
b AS (SELECT *, trim(regexp_replace(regexp_replace(coalesce(name, ''), '{r.TITLES_BEFORE}', ''), '{r.TITLES_AFTER}', ''), ' ') AS bare FROM n WHERE (email IS NOT NULL OR phone IS NOT NULL) AND (email IS NOT NULL OR name IS NOT NULL)),
s AS (SELECT *, (trim(regexp_replace(bare, '\S+$', ''), ' ') <> '')::INT + (regexp_extract(bare, '(\S+)$', 1) <> '')::INT + (role IS NOT NULL)::INT + (department IS NOT NULL)::INT + (phone IS NOT NULL)::INT AS filled FROM b)
SELECT email, doc_id, line_no, name, role, department, CAST(CAST(phone AS BIGINT) AS VARCHAR) AS phone FROM s
QUALIFY row_number() OVER (PARTITION BY email, CASE WHEN email IS NULL THEN lower(name) END, CASE WHEN email IS NULL THEN phone END ORDER BY CASE WHEN email IS NULL THEN 0 ELSE filled END DESC, doc_id DESC, line_no DESC) = 1""",
    "speaker_names": rf"""WITH s AS (SELECT event_id, string_split_regex(speakers, '\s*\|\s*') AS x FROM event_items WHERE speakers IS NOT NULL), l AS (SELECT event_id, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS pos, trim(regexp_replace(unnest(x), '\s+', ' ', 'g'), ' ') AS t FROM s),
b AS (SELECT *, regexp_extract(t, '{r.TITLES_BEFORE}') AS before, regexp_extract(t, '{r.TITLES_AFTER}') AS after, trim(regexp_replace(regexp_replace(t, '{r.TITLES_BEFORE}', ''), '{r.TITLES_AFTER}', ''), ' ') AS bare FROM l)
SELECT event_id, pos, trim(trim(before, ' ') || ' ' || regexp_replace(after, '^,\s*', ''), ' ') AS title, trim(regexp_replace(bare, '\S+$', ''), ' ') AS first_name, regexp_extract(bare, '(\S+)$', 1) AS last_name FROM b""",
    "event_times": r"""WITH m AS (SELECT event_id, TRY_CAST(regexp_extract(time_from, '(\d{1,2})', 1) AS INTEGER) AS h1, coalesce(TRY_CAST(regexp_extract(time_from, '\d{1,2}[:.](\d{2})', 1) AS INTEGER), 0) AS m1, TRY_CAST(regexp_extract(time_to, '(\d{1,2})', 1) AS INTEGER) AS h2, coalesce(TRY_CAST(regexp_extract(time_to, '\d{1,2}[:.](\d{2})', 1) AS INTEGER), 0) AS m2 FROM event_items),
t AS (SELECT event_id, CASE WHEN h1 < 24 AND m1 < 60 THEN h1 * 60 + m1 END AS begins, CASE WHEN h2 < 24 AND m2 < 60 THEN h2 * 60 + m2 END AS ends FROM m)
SELECT event_id, coalesce(begins, -1) AS begins, coalesce(ends, -1) AS ends, CASE WHEN ends >= begins THEN ends - begins ELSE -1 END AS lasts FROM t""",
    "items_under_headings": r"""WITH t AS (SELECT page_id, string_split(content, chr(10)) AS x FROM scraped_pages WHERE content IS NOT NULL), l AS (SELECT page_id, CAST(generate_subscripts(x, 1) AS INTEGER) AS line_no, unnest(x) AS line FROM t),
h AS (SELECT *, last_value(CASE WHEN regexp_matches(line, '^#{1,6}\s+\S') THEN trim(regexp_replace(line, '^#{1,6}\s+', ''), ' ') END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY line_no) AS heading FROM l)
SELECT page_id, line_no, heading, trim(regexp_replace(line, '^\s*[-*•]\s+', ''), ' ') AS item FROM h WHERE regexp_matches(line, '^\s*[-*•]\s+\S') AND heading IS NOT NULL""",
    "frontier_cap": f"WITH s AS (SELECT DISTINCT site_id, {CANONICAL_SQL} AS url FROM sitemap WHERE url IS NOT NULL) SELECT site_id, least(count(*), 100) AS n_kept, greatest(count(*) - 100, 0) AS n_over FROM s GROUP BY site_id",
    "removal_guard": f"""WITH k AS (SELECT site_id, {CANONICAL_SQL} AS u, bool_or(NOT {LATE_SQL.format('ingested_at')}) AS was, bool_or({LATE_SQL.format('ingested_at')}) AS now FROM sitemap WHERE url IS NOT NULL GROUP BY site_id, u)
SELECT site_id, count(*) FILTER (was) AS n_before, count(*) FILTER (was AND NOT now) AS n_removed, count(*) FILTER (was AND NOT now) * 2 > count(*) FILTER (was) AS blocked FROM k GROUP BY site_id""",
    "token_usage": "SELECT provider, strftime(fetched_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, count(*) AS n_pages, CAST(sum(n_tokens) AS BIGINT) AS n_tokens, max(n_tokens) AS most FROM scraped_pages GROUP BY provider, day",
    "language_walls_cut": f"SELECT page_id, CAST(length(content) AS INTEGER) AS n_before, CAST(length(array_to_string(list_filter(string_split(content, chr(10)), lambda x : NOT regexp_matches(x, '{WALL}')), chr(10))) AS INTEGER) AS n_after FROM scraped_pages WHERE content IS NOT NULL",
    "summary_verdicts": r"""WITH b AS (SELECT site_id, trim(regexp_replace(trim(summary, ' '), '^["„“]+|["“”]+$', '', 'g'), ' ') AS s FROM event_items)
SELECT site_id, CASE WHEN length(coalesce(s, '')) < 15 THEN 'short' WHEN NOT regexp_matches(s, '[.!?…)]$') THEN 'cut' ELSE 'valid' END AS verdict, count(*) AS n FROM b GROUP BY site_id, verdict""",
}
