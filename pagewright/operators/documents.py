"""Texts of documents: structure, budgets, cleaning, tables. Spark expressions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import estimated_tokens

# Lower bounds of the size bands, in estimated tokens.
BANDS = ((20_000, "CRITICAL"), (15_000, "HIGH"), (8_000, "MODERATE"))
#: Content shorter than this, or less than this share of its HTML, is suspect; HTML shorter than the last is exempt.
SUSPECT_CHARS, SUSPECT_SHARE, EXEMPT_HTML = 100, 0.02, 2000
# HTML entities and the characters they stand for.
ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&laquo;", "«"), ("&raquo;", "»"), ("&copy;", "©"))


def structure(text: Column) -> Column:
    """Struct of counts: headings, bullets, numbered lines, table lines, lines; and the dominant one of them.

    Of equal counts the first in this order dominates.
    """
    count = lambda p: F.regexp_count(text, F.lit(p))
    parts = [("headings", count(r"(?m)^#{1,6}[ \t]+\S")), ("bullets", count(r"(?m)^[ \t]*[-*+•][ \t]+\S")), ("numbered", count(r"(?m)^[ \t]*\d+[.)][ \t]+\S")), ("tables", count(r"(?m)^[ \t]*\|.*\|[ \t]*$")), ("lines", count(r"(?m)^[^\n]*\S"))]
    best = F.array_max(F.array(*[F.struct(c.alias("c"), F.lit(-i).alias("i"), F.lit(n).alias("n")) for i, (n, c) in enumerate(parts)]))["n"]
    return F.struct(*[c.alias(n) for n, c in parts], best.alias("dominant"))


def band(tokens: Column) -> Column:
    cases = F
    for least, name in BANDS:
        cases = cases.when(tokens > least, name)
    return cases.otherwise("LOW")


def quality(markdown_chars: Column, html_chars: Column) -> Column:
    """``empty``, ``suspect`` or ``good`` by the length of the text and its share of the page it was taken from."""
    return (
        F.when(F.coalesce(markdown_chars, F.lit(0)) == 0, "empty")
        .when(html_chars < EXEMPT_HTML, "good")
        .when((markdown_chars < SUSPECT_CHARS) | (markdown_chars / html_chars < SUSPECT_SHARE), "suspect")
        .otherwise("good")
    )


def cleaned(text: Column) -> Column:
    """Entities resolved, numeric ones dropped, blanks collapsed, lines trimmed, empty lines out."""
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.regexp_replace(F.regexp_replace(text, r"&#\d+;", ""), r"[ \t]+", " ")
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != ""), "\n")


def budgets(total: Column, reserve: int = 100) -> Column:
    """Tokens of a header's parts: page, file and overlap summaries and the question, from what is left at each step."""
    avail = total - reserve
    page = F.least(F.floor(avail / 4), F.lit(300))
    rest = avail - page
    file = F.least(F.floor(rest / 3), F.lit(400))
    rest2 = rest - file
    overlap = F.least(F.floor(rest2 / 2), F.lit(250))
    small = F.lit(50)
    part = lambda c: F.when(avail <= 0, small).otherwise(c).cast("int")
    return F.struct(part(page).alias("page"), part(file).alias("file"), part(overlap).alias("overlap"), part(rest2 - overlap).alias("question"))


def fitted_document(header: Column, summaries: list[Column], question: Column, content: Column, limit: int) -> Column:
    """Struct ``stage, document``: header, summaries, question and content within ``limit`` tokens; the content is never cut.

    ``summaries`` stand from the most to the least important. While the whole is too long the least important one
    goes (stages 1 to their number), then the question, then the end of the header, at a line's end if its second
    half has one. Content that alone has the limit stands by itself (the last stage). NULL parts take no room.
    """
    body = lambda *parts: F.concat(F.concat_ws("\n", *parts), F.lit("\n\n"), content)
    stages = [body(header, *summaries[: len(summaries) - i], question) for i in range(len(summaries) + 1)] + [body(header)]
    fits = [F.when(estimated_tokens(doc) <= limit, F.struct(F.lit(i).alias("stage"), doc.alias("document"))) for i, doc in enumerate(stages)]
    room = (F.lit(limit) - estimated_tokens(content)).cast("double") * F.expr("3.2D")
    cut = F.left(header, room.cast("int"))
    line = F.regexp_replace(cut, r"\n[^\n]*$", "")
    shorter = F.when(F.contains(cut, F.lit("\n")) & (F.length(line) > F.floor(room.cast("int") / 2)), line).otherwise(cut)
    last = F.when(room > 0, F.struct(F.lit(len(stages)).alias("stage"), F.concat(shorter, F.lit("\n---\n\n"), content).alias("document")))
    return F.coalesce(*fits, last, F.struct(F.lit(len(stages) + 1).alias("stage"), content.alias("document")))


def first_sentences(text: Column, tokens: int) -> Column:
    """As many whole sentences as ``tokens`` take, at least one; a longer first sentence is cut at a word, with ``…``."""
    parts = F.split(text, r"(?<=[.!?])\s+")
    fit = F.aggregate(
        parts,
        F.struct(F.lit("").alias("s"), F.lit(True).alias("open")),
        lambda a, p: F.when(
            a["open"] & (estimated_tokens(F.when(a["s"] == "", p).otherwise(F.concat(a["s"], F.lit(" "), p))) <= tokens),
            F.struct(F.when(a["s"] == "", p).otherwise(F.concat(a["s"], F.lit(" "), p)).alias("s"), F.lit(True).alias("open")),
        ).otherwise(F.struct(a["s"].alias("s"), F.lit(False).alias("open"))),
    )["s"]
    cut = F.left(text, F.lit(int(tokens * 3.2)))
    at_word = F.concat(F.regexp_replace(F.regexp_replace(cut, r"\s*\S*$", ""), r"[,;:\- ]+$", ""), F.lit(" …"))
    return F.when(estimated_tokens(text) <= tokens, text).when(fit != "", fit).otherwise(at_word)


def table_rows(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key, line_no, n_cells, record``: rows of Markdown tables as ``header: cell`` records.

    The first line of a run of lines between bars is its header, rules of dashes are passed over; tags around
    the bars don't count. The lines of one document stay together, so no shuffle is needed.
    """
    lines = F.transform(F.split(F.col(text), "\n"), lambda x: F.trim(F.regexp_replace(x, r"<[^<>]*>", "")))
    is_row = lambda x: x.rlike(r"^\|.*\|$")
    rule = r"^\|(?:\s*:?-+:?\s*\|)+$"
    cells = lambda x: F.transform(F.split(F.regexp_replace(x, r"^\||\|$", ""), r"\|", -1), lambda c: F.trim(c))
    t = documents.where(F.contains(text, F.lit("|"))).select(key, F.inline(F.array(F.struct(lines.alias("lines")))))
    rows = F.filter(F.transform("lines", lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("line"), F.coalesce(F.get("lines", i - 1), F.lit("")).alias("prev"))), lambda r: is_row(r["line"]))
    t = t.select(key, F.inline(F.array(F.struct(rows.alias("rows")))))
    headers = F.filter("rows", lambda r: ~is_row(r["prev"]))
    body = F.filter("rows", lambda r: is_row(r["prev"]) & ~r["line"].rlike(rule))
    exploded = t.select(key, headers.alias("headers"), F.inline(body))
    own = F.element_at(F.filter("headers", lambda h: h["line_no"] < F.col("line_no")), -1)
    joined = exploded.select(key, "line_no", cells(own["line"]).alias("names"), cells(F.col("line")).alias("cells"))
    record = F.array_join(F.filter(F.zip_with("names", "cells", lambda n, c: F.when(c != "", F.concat(F.coalesce(n, F.lit("")), F.lit(": "), c))), lambda x: x.isNotNull()), " | ")
    return joined.select(key, "line_no", F.size("cells").alias("n_cells"), record.alias("record"))
