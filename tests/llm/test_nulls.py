"""NULL ids, keys and texts, and ids beyond what floating point holds: a defined result, no crash."""

from pagewright.llm import boilerplate, credentials, leakage, mixing, pairs, pii, site_lines

BIG = 9007199254740993


def test_null_ids(spark):
    pages = spark.createDataFrame([(None, "https://a.example", "u1", "t", "# T\nText."), (BIG, "https://a.example", "u", "t", "Menu\n# T\nText."), (3, None, None, None, None)], "page_id bigint, base_url string, url string, title string, content string").coalesce(1)
    assert {tuple(r) for r in boilerplate.boilerplate_lines(pages).collect()} == {(BIG, 1)}
    assert site_lines.repeated_lines(pages).count() == 0 and boilerplate.main_content(pages).count() == 3
    files = spark.createDataFrame([(None, "a.py", None, 'password = "kocour77x"'), (BIG, "a.py", None, 'password = "kocour77x"'), (4, None, None, None)], "file_id bigint, file_path string, file_lang string, body string").coalesce(1)
    assert {tuple(r) for r in credentials.find(files).collect()} == {(None, 1, "kocour77x"), (BIG, 1, "kocour77x")}
    assert {r.file_id: r.n_secrets for r in credentials.redact(files).collect()} == {None: 1, BIG: 1, 4: 0}
    answers = spark.createDataFrame([(None, None, None), (BIG, "a", None)], "pair_id bigint, question string, answer string").coalesce(1)
    assert {tuple(r) for r in pairs.defects(answers).collect()} == {(None, "empty"), (BIG, "empty")}


def test_null_documents_and_targets(spark):
    docs = spark.createDataFrame([(None, "Volejte 602 111 222, jedna dva", "x"), (BIG, "Volejte 602 111 222, jedna dva", None), (5, None, "x")], "doc_id bigint, text string, source string").coalesce(1)
    items = spark.createDataFrame([(None, "jedna dva"), (2, "jedna dva"), (3, None)], "item_id int, text string")
    assert {tuple(r) for r in pii.find(docs).collect()} == {(None, "phone", "602 111 222"), (BIG, "phone", "602 111 222")}
    assert pii.masked(docs).count() == 3
    for size in (leakage.INDEX_CHARS, 0):
        assert {tuple(r) for r in leakage.leaks(docs, items, size).collect()} == {(BIG, 2)}
    targets = spark.createDataFrame([("x", 0.9, 1), (None, 0.1, 1), ("y", None, 1), ("z", 0.2, None)], "source string, target_share double, max_repeat int")
    assert [r.source for r in mixing.out_of_reach(docs, targets).collect()] == ["x"]
    assert {r.source for r in mixing.shares(docs, targets).collect()} == {"x", "y", "z"}
