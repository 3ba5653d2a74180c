import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import leakage
from pagewright.llm.wordhash import sliding_min, word_hashes, words_of

LONG = "Most u mlýna Mrupovov měří 56 metrů, stavěl ho cech Hvozlatiště a kámen vozili povozníci od Dranovoves k jezu."
SHORT = "Kdo založil Ždizlatoves u brodu?"
ITEMS = [(1, LONG), (2, SHORT), (3, None), (4, "..."), (5, "Ano"), (6, LONG)]
DOCS = [
    (1, "Úvod. " + LONG.upper()),
    (2, "x " + " ".join(unicodedata.normalize("NFD", LONG).split()[3:15]) + " y"),
    (3, " ".join(LONG.split()[3:14])),
    (4, "**Kdo**\nzaložil   ŽDIZLATOVES, u_brodu"),
    (5, "Kdo založil Ždizlatoves u brodů; nový"),
    (6, None),
    (7, ""),
    (8, "slovo " * 300_000 + SHORT),
    (9, "ano i ne"),
    (10, "Kdo založil Ždizlatoves"),
    (11, "u brodu"),
]
WANTED = {(1, 1), (1, 6), (2, 1), (2, 6), (4, 2), (5, 2), (8, 2), (9, 5)}


@pytest.mark.parametrize("index_chars", [10**9, -1])
def test_leaks_by_index_and_by_join(spark, index_chars):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("*", "1 AS item_id", "2 AS key")
    items = spark.createDataFrame(ITEMS, "item_id int, text string").selectExpr("*", "1 AS size", "2 AS doc_id")
    found = {tuple(r) for r in leakage.leaks(docs, items, index_chars).collect()}
    assert found == {(d, i) for d, i in WANTED}
    assert leakage.leaks(docs.limit(0), items, index_chars).count() == 0
    assert leakage.leaks(docs, items.limit(0), index_chars).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aáAč ǅ½ﬁ-_1٣\n𝟙中ŔŽ́", max_size=30), min_size=1, max_size=5))
def test_word_hashes_agree_with_words(texts):
    hashes, owner = word_hashes(texts)
    words = [(i, w) for i, t in enumerate(texts) for w in words_of(t)]
    assert owner.tolist() == [i for i, _ in words]
    seen = {}
    for h, (_, w) in zip(hashes.tolist(), words):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = "Žluťoučký kůň " * 50 + "x" * 40 + " ódy " * 30
    whole = word_hashes(["a b", text])
    monkeypatch.setattr("pagewright.llm.wordhash.CHUNK_CHARS", 37)
    pieces = word_hashes(["a b", text])
    assert whole[0].tolist() == pieces[0].tolist() and whole[1].tolist() == pieces[1].tolist()


@given(st.lists(st.integers(0, 9), max_size=30), st.integers(1, 9))
def test_sliding_min(values, width):
    got = sliding_min(np.array(values, np.uint64), width).tolist()
    assert got == [min(values[i : i + width]) for i in range(len(values) - width + 1)]
