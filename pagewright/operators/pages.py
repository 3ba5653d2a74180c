"""Scraped pages to rows: links, Markdown and chunks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chunking, html, urls
from ..session import spread


def links(pages: DataFrame) -> DataFrame:
    """``page_id, ord, href, anchor, target``: links of HTML pages in their order, resolved against the page.

    Links within the page, mails and phone numbers have no target. Pages without HTML give no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ords, hrefs, anchors = [], [], [], []
            for page, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, (href, anchor) in enumerate(html.read(content).links):
                    ids.append(page)
                    ords.append(i)
                    hrefs.append(href or "")
                    anchors.append(anchor)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ords, pa.int32()), pa.array(hrefs, pa.string()), pa.array(anchors, pa.string())], ["page_id", "ord", "href", "anchor"])

    source = spread(pages.where(F.lower("content").contains("<a ")).select("page_id", "content"))
    found = source.mapInArrow(scan, "page_id bigint, ord int, href string, anchor string")
    bases = pages.select("page_id", F.coalesce("url", "base_url").alias("base"))
    outward = ~F.col("href").rlike(r"(?i)^(?:#|$|mailto:|tel:|javascript:|data:)")
    joined = found.join(bases, "page_id")
    return joined.select("page_id", "ord", "href", "anchor", F.when(outward, urls.without_fragment(urls.resolved(F.col("base"), F.col("href")))).alias("target"))


def passes(url: Column, blacklist: tuple[str, ...] = (), include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> Column:
    """Whether a URL may be crawled: under no path of ``blacklist``, no file, and its path fits ``include``, if there are any, and none of ``exclude``."""
    path = urls.path_of(url)
    fits = lambda patterns: reduce(lambda a, p: a | path.rlike(p), patterns, F.lit(False))
    barred = reduce(lambda a, p: a | urls.under_path(url, F.lit(p)), blacklist, F.lit(False))
    return ~barred & ~urls.is_file(url) & (fits(include) if include else F.lit(True)) & ~fits(exclude)


def inner_links(pages: DataFrame, blacklist: tuple[str, ...] = (), include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> DataFrame:
    """``page_id, target``: distinct links that stay on the page's host and pass the filters; files and the host's first page are left out."""
    found = links(pages).where("target IS NOT NULL")
    hosts = pages.select("page_id", urls.domain_key(F.col("base_url")).alias("host"))
    same = found.join(hosts, "page_id").where(urls.domain_key(F.col("target")) == F.col("host"))
    beyond = ~urls.path_of(F.col("target")).isin("", "/") | (urls.query_of(F.col("target")) != "")
    return same.where(beyond & passes(F.col("target"), blacklist, include, exclude)).select("page_id", "target").distinct()


def as_markdown(pages: DataFrame, selectors: Column) -> DataFrame:
    """``page_id, markdown, title``: HTML pages as Markdown without the elements of ``selectors``, a comma list.

    Only selectors of one tag, id or class are understood; others are passed over. Text that holds no HTML
    comes out as it is.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, titles = [], []
            for content, chosen in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if content is None or "<" not in content:
                    texts.append(content)
                    titles.append(None)
                    continue
                skipped = {s.strip() for s in (chosen or "").split(",") if s.strip()}
                text, title = html.page(content, skipped)
                texts.append(text)
                titles.append(title or None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(titles, pa.string())], ["page_id", "markdown", "title"])

    return pages.select("page_id", "content", selectors.alias("selectors")).mapInArrow(scan, "page_id bigint, markdown string, title string")


def chunks(documents: DataFrame, key: str, text: str, most: int = 4096, offset: int = 500, ratio: float = 0.5) -> DataFrame:
    """``key, chunk_number, chunk_postfix, tokens, content``: chunks within the content budget, numbered from 1."""
    budget = chunking.content_budget(most, offset, ratio)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, counts, contents = [], [], [], []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, (content, n) in enumerate(chunking.by_budget(body, budget), 1):
                    ids.append(doc)
                    numbers.append(i)
                    counts.append(n)
                    contents.append(content)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(counts, pa.int32()), pa.array(contents, pa.string())], ["doc", "chunk_number", "tokens", "content"])

    cut = spread(documents.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint"), text)).mapInArrow(scan, "doc bigint, chunk_number int, tokens int, content string")
    return cut.select(F.col("doc").alias(key), "chunk_number", urls.chunk_postfix(F.col("chunk_number") - 1).alias("chunk_postfix"), "tokens", "content")


def sections(documents: DataFrame, key: str, text: str, most_chars: int = 6000) -> DataFrame:
    """``key, section_number, content``: sections between headings, at paragraphs where they are too long."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, i, s) for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, s in enumerate(chunking.by_headings(body, most_chars), 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string())], ["doc", "section_number", "content"])

    cut = spread(documents.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint"), text)).mapInArrow(scan, "doc bigint, section_number int, content string")
    return cut.withColumnRenamed("doc", key)


#: Words of the chunk before that lead a chunk in.
LEAD_WORDS = 30


def with_headers(chunked: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Chunks as saved documents: a header of title, URL, source and the last words of the chunk before, then the content.

    ``lookup_key`` names each. The window is over the chunks of one document.
    """
    head = documents.select(key, F.col("title").alias("__title"), F.col("url").alias("__url"), F.col("source").alias("__source"))
    before = F.split(F.trim(F.lag("content").over(Window.partitionBy(key).orderBy("chunk_number"))), r"\s+")
    lead = F.array_join(F.slice(before, F.greatest(F.size(before) - LEAD_WORDS + 1, F.lit(1)), F.lit(LEAD_WORDS)), " ")
    lines = F.concat_ws("\n", F.concat(F.lit("# "), F.col("__title")), F.concat(F.lit("## URL: "), F.col("__url")), F.concat(F.lit("## SOURCE: "), F.trim("__source")), F.concat(F.lit("## BEFORE: "), F.col("__lead")))
    joined = chunked.withColumn("__lead", lead).join(head, key)
    return joined.select(key, "chunk_number", F.concat("__url", F.lit("#chunk"), F.col("chunk_postfix")).alias("lookup_key"), F.concat_ws("\n\n", F.nullif(lines, F.lit("")), "content").alias("document"))
