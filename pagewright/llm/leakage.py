"""Evaluation texts inside training documents (problem 6).

MinHash containment search, partitioned by size. An item is searched for by windows of ``PASSAGE`` words, or
as a whole if it is shorter; documents are cut into windows of the same size, so that a contained window and
the one that contains it are equal sets of shingles and agree in each MinHash value: no true pair is missed.
Windows of one size differ in a few places only, so neighbours share their least shingle and a document has
few distinct values. Candidates are verified by their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .wordhash import chunks, shingles, sliding_min, word_hashes, words_of

#: Consecutive words that make a leak.
PASSAGE = 12
#: Sizes of the partitions: an item belongs to the largest size that it has words for.
SIZES = (PASSAGE, 8, 5, 3, 2, 1)
#: Words of a shingle, at most.
SHINGLE = 5
#: Items' total characters up to which their index goes to every task; beyond, keys are joined by a shuffle.
INDEX_CHARS = 16_000_000


def _keys(words: np.ndarray, size: int) -> np.ndarray:
    """MinHash value of each window of ``size`` words, of another family for each size."""
    k = min(SHINGLE, size)
    return sliding_min(shingles(words ^ np.uint64(size * 0x9E3779B9), k), size - k + 1)


def item_keys(items: pd.DataFrame) -> pd.DataFrame:
    """``item_id, size, key`` of an item's windows: all of a long item's, the first of a short one's."""
    rows = []
    for item, text in zip(items["item_id"], items["text"]):
        words, _ = word_hashes([text or ""])
        size = next((s for s in SIZES if len(words) >= s), 0)
        if size:
            keys = _keys(words, size)
            rows += [(item, size, int(k)) for k in np.unique(keys if size == PASSAGE else keys[:1]).view(np.int64)]
    return pd.DataFrame(rows, columns=["item_id", "size", "key"])


def document_keys(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window values of ``size`` and the index of each one's text; runs of equal values once."""
    words, owner = word_hashes(texts)
    keys = _keys(words, size)
    if not len(keys):
        return keys.view(np.int64), owner[:0]
    first, last = owner[: len(keys)], owner[size - 1 :]
    use = first == last
    use[1:] &= (keys[1:] != keys[:-1]) | (first[1:] != first[:-1]) | ~use[:-1]
    return keys[use].view(np.int64), first[use]


def contains(document: str, item_words: list[str]) -> bool:
    """Whether ``document``, plain words between single blanks, has a passage of the item or all of it."""
    n = min(PASSAGE, len(item_words))
    return n > 0 and any(f" {' '.join(item_words[i : i + n])} " in document for i in range(len(item_words) - n + 1))


def _padded(text: str) -> str:
    return f" {' '.join(words_of(text))} "


def _by_index(documents: DataFrame, items: pd.DataFrame) -> DataFrame:
    """Pairs found by a broadcast index of the items, whose size is checked before."""
    keys = item_keys(items)
    by_key: dict[int, dict[int, list]] = {}
    for item, size, key in keys.itertuples(index=False):
        by_key.setdefault(size, {}).setdefault(key, []).append(item)
    words = {i: words_of(t or "") for i, t in zip(items["item_id"], items["text"])}
    index = documents.sparkSession.sparkContext.broadcast(({s: (np.sort(np.fromiter(k, np.int64, len(k))), k) for s, k in by_key.items()}, words))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, item_words = index.value
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            pairs: set[tuple[int, int]] = set()
            for a, b in chunks(texts):
                for size, (known, owners) in sizes.items():
                    found, at = document_keys(texts[a:b], size)
                    place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    hit = known[place] == found
                    pairs.update((a + i, item) for k, i in zip(found[hit].tolist(), at[hit].tolist()) for item in owners[k])
            padded = {i: _padded(texts[i]) for i in {i for i, _ in pairs}}
            sure = [(ids[i], item) for i, item in pairs if contains(padded[i], item_words[item])]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in sure], pa.int64()), pa.array([i for _, i in sure], pa.int32())], ["doc_id", "item_id"])

    return documents.mapInArrow(search, "doc_id bigint, item_id int")


def _by_join(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The same pairs by a shuffle on the keys, for item sets too large for a task."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(item_keys, batches)

    keys = items.mapInPandas(index, "item_id int, size int, key bigint").distinct()
    sizes = sorted(r["size"] for r in keys.select("size").distinct().collect())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                for size in sizes:
                    found, at = document_keys(texts[a:b], size)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a + at], pa.int64()), pa.array(np.full(len(found), size), pa.int32()), pa.array(found, pa.int64())], ["doc_id", "size", "key"])

    candidates = documents.mapInArrow(cut, "doc_id bigint, size int, key bigint").join(keys, ["size", "key"]).select("doc_id", "item_id").distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            sure = [contains(_padded(d), words_of(i)) for d, i in zip(t["text"], t["item_text"])]
            yield t.loc[sure, ["doc_id", "item_id"]]

    texts = candidates.join(documents, "doc_id").join(items.select("item_id", F.col("text").alias("item_text")), "item_id")
    return texts.select("doc_id", "item_id", "text", "item_text").mapInPandas(verify, "doc_id bigint, item_id int")


def leaks(documents: DataFrame, items: DataFrame, index_chars: int = INDEX_CHARS) -> DataFrame:
    """Distinct ``doc_id, item_id``: the document has ``PASSAGE`` consecutive words of the item, or all of it.

    Letter case, diacritics, punctuation and spacing don't count. NULL texts and ids and items without words give no
    row, equal items and documents one under each id; an empty table on either side gives none. A text of
    any length is searched whole. Further columns are ignored.
    """
    docs = spread(documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text"))
    held_out = items.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text").dropDuplicates()
    size = held_out.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    found = _by_index(docs, held_out.toPandas()) if size <= index_chars else _by_join(docs, held_out)
    return found.distinct()
