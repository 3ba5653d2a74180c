"""Texts of models, files and addresses as typed values, all by Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of a saved file in which its URL is looked for.
HEAD_CHARS = 3000
# How saved files name their URL, in the order in which they are tried.
URL_FORMS = (
    ("header", r"(?m)^## (?:\S+ )?\*{0,2}URL:?\*{0,2}:? *(https?://\S+)"),
    ("bold", r"\*\*URL:?\*\*:? *(https?://\S+)"),
    ("source", r"(?i)\bsource(?: url)?: *(https?://\S+)"),
    ("link", r"\]\((https?://[^)\s]+)"),
    ("any", r"(https?://[^\s<>\"]+)"),
)
# Fixed value: a page number and chunk letters at the end of a title.
PAGE_MARK = r"_PAGE(\d+)([A-Z]{0,2})$"


def repaired_json(text: Column) -> Column:
    """The JSON object or array in a model's answer: fences and words around it, control characters and trailing commas gone."""
    unfenced = F.regexp_replace(text, r"(?s)^.*?```(?:json)?[ \t]*\n(.*?)```.*$", "$1")
    outer = F.regexp_extract(unfenced, r"(?s)([{\[].*[}\]])", 1)
    return F.nullif(F.regexp_replace(F.regexp_replace(outer, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), r",(\s*[}\]])", "$1"), F.lit(""))


def saved_url(text: Column) -> Column:
    """Struct ``form, url``: the URL that the beginning of a saved file names, by the first form that fits; marks at its end gone."""
    head = F.left(text, F.lit(HEAD_CHARS))
    found = [F.when(head.rlike(p), F.struct(F.lit(name).alias("form"), F.regexp_replace(F.regexp_extract(head, p, 1), r"[.,;)*]+$", "").alias("url"))) for name, p in URL_FORMS]
    return F.coalesce(*found)


def page_of_title(title: Column) -> Column:
    """Struct ``base, page, letters`` of a title with a page mark; one without has its base only."""
    marked = title.rlike(PAGE_MARK)
    return F.struct(
        F.regexp_replace(title, PAGE_MARK, "").alias("base"),
        F.when(marked, F.regexp_extract(title, PAGE_MARK, 1).try_cast("int")).alias("page"),
        F.when(marked, F.nullif(F.regexp_extract(title, PAGE_MARK, 2), F.lit(""))).alias("letters"),
    )


def clean_title(title: Column, most: int = 200) -> Column:
    """Quotes gone, blanks single, at most ``most`` characters."""
    return F.left(F.trim(F.regexp_replace(F.regexp_replace(title, "[\"'„“”‚‘’]", ""), r"\s+", " ")), F.lit(most))


def truncated(text: Column, tokens: int) -> Column:
    """Four characters a token, then ``...``."""
    return F.when(F.length(text) > 4 * tokens, F.concat(F.left(text, F.lit(4 * tokens)), F.lit("..."))).otherwise(text)


def first_day(text: Column) -> Column:
    """The first ``YYYY-MM-DD`` in a text, NULL without one."""
    return F.nullif(F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def whole_number(text: Column, default: Column) -> Column:
    """A trimmed text as a number, else ``default``."""
    return F.coalesce(F.trim(text).try_cast("int"), default)


def fetchable(url: Column) -> Column:
    """Whether a page may be fetched by its scheme."""
    return F.coalesce(url.rlike(r"(?i)^https?://[^/]"), F.lit(False))


def base_forms(base_url: Column) -> Column:
    """The forms in which a site's first page is written: with and without ``www.``, slash and index page."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(base_url), r"/+$", ""), r"://www\.", "://")
    hosts = F.array(bare, F.regexp_replace(bare, "://", "://www."))
    return F.flatten(F.transform(hosts, lambda h: F.array(h, *[F.concat(h, F.lit(p)) for p in ("/", "/index.html", "/index.htm", "/index.php")])))


def untabled(html: Column) -> Column:
    """HTML made plain for another try: tables as a mark, tags gone, blanks single."""
    marked = F.regexp_replace(html, r"(?is)<table\b.*?</table\s*>", " [TABLE DATA] ")
    return F.trim(F.regexp_replace(F.regexp_replace(marked, r"<[^<>]*>", " "), r"\s+", " "))
