import pytest
from pyspark.sql import functions as F

from pagewright.functions import chunking, html, urls
from pagewright.functions.text import estimated_tokens, folded, unaccented
from pagewright.operators import documents, frontier, pages, records, tables, transcripts
from pagewright.session import ship
from pagewright.sources import feeds


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).collect()[0].r


@pytest.mark.parametrize(
    ("raw", "wanted"),
    [
        ("https://e.com/o-webu#zou", "https://e.com/o-webu"),
        ("https://e.com/a#", "https://e.com/a"),
        ("https://e.com/a/", "https://e.com/a/"),
        ("https://e.com/p?x=1#f", "https://e.com/p?x=1"),
        ("https://e.com/p?b=2&a=1&b=1", "https://e.com/p?a=1&b=2&b=1"),
        ("https://e.com/a%23b", "https://e.com/a%23b"),
        ("", ""),
        (None, None),
        ("https://e.com/?q=%C3%A1", "https://e.com/?q=%C3%A1"),
        ("https://e.com/?q=á", "https://e.com/?q=%C3%A1"),
        ("https://e.com/?b=1&a=x+y&b=0&a=a~b*", "https://e.com/?a=x+y&a=a~b%2A&b=1&b=0"),
        ("https://e.com/?q=100%", "https://e.com/?q=100%25"),
    ],
)
def test_canonical(spark, raw, wanted):
    assert one(spark, urls.canonical, raw) == wanted


@pytest.mark.parametrize(
    ("href", "wanted"),
    [("https://b.cz/x", "https://b.cz/x"), ("//b.cz/x", "https://b.cz/x"), ("/x", "https://a.cz/x"), ("?q=1", "https://a.cz/d/e?q=1"), ("f", "https://a.cz/d/f"), ("./f", "https://a.cz/d/f"), ("#t", "https://a.cz/d/e?s=1#t")],
)
def test_resolved(spark, href, wanted):
    assert one(spark, lambda c: urls.resolved(F.lit("https://a.cz/d/e?s=1"), c), href) == wanted


@pytest.mark.parametrize(("url", "wanted"), [("https://e.cz/a.PDF?x=1", True), ("https://e.cz/h.aspx?id_dokumenty=3", True), ("https://e.cz/h.aspx", False), ("https://e.cz/pdf", False)])
def test_is_file(spark, url, wanted):
    assert one(spark, urls.is_file, url) is wanted


def test_small_expressions(spark):
    assert [one(spark, lambda c: urls.chunk_postfix(c), n, "int") for n in (0, 25, 26, 51, 52, 701)] == ["A", "Z", "AA", "AZ", "BA", "ZZ"]
    assert one(spark, urls.safe_filename, " ..Příliš/žluťoučký  kůň?. ") == "Prilis_zlutoucky_kun"
    assert one(spark, unaccented, "Ďábelské ódy, łódź") == "Dabelske ody, lodz"
    assert one(spark, folded, "  Příliš -- ŽLUŤOUČKÝ!\n") == "prilis zlutoucky"
    assert [one(spark, estimated_tokens, t) for t in ("", "a", "a" * 32, None)] == [0, 1, 10, None]
    assert one(spark, lambda c: urls.page_url(c, F.lit(3)), "https://e.cz/a?x=1&page=2") == "https://e.cz/a?x=1&page=3"


def test_keep_best_newest_null_and_tie(spark):
    df = spark.createDataFrame([("u", 1, "2020"), ("u", 2, None), ("u", 3, "2024"), ("v", 4, None), ("v", 5, None), ("w", 6, "2021"), ("w", 7, "2021")], "url string, ord int, at string")
    rank = F.struct(F.col("at").isNull(), -F.coalesce(F.col("at").try_cast("int"), F.lit(0)), F.col("ord"))
    assert {(r.url, r.ord) for r in frontier.keep_best(df, ["url"], rank).collect()} == {("u", 3), ("v", 4), ("w", 6)}
    assert {(r.url, r.ord) for r in frontier.keep_first(df, ["url"], "ord").collect()} == {("u", 1), ("v", 4), ("w", 6)}


def test_snapshot_diff(spark):
    old = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "u string")
    new = spark.createDataFrame([("b",), ("c",)], "u string")
    assert {tuple(r) for r in frontier.snapshot_diff(old, new, "u").collect()} == {("a", "removed"), ("b", "unchanged"), ("c", "new")}
    assert frontier.snapshot_diff(old.limit(0), new.limit(0), "u").count() == 0


def test_lastmod_lookup_strategies(spark):
    sitemap = spark.createDataFrame([("https://www.e.cz/A/", "1", 1), ("https://e.cz/b", None, 2), ("https://e.cz/b", "2", 3)], "url string, lastmod string, list_ord bigint")
    asked = spark.createDataFrame([(1, "https://www.e.cz/A/"), (2, "https://www.e.cz/A#x"), (3, "https://e.cz/A"), (4, "https://E.cz/a/"), (5, "https://e.cz/b"), (6, "https://e.cz/zzz"), (7, None)], "page_id bigint, url string")
    got = {r.page_id: (r.strategy, r.lastmod) for r in frontier.lastmod_lookup(asked, sitemap).collect()}
    assert got == {1: (1, "1"), 2: (2, "1"), 3: (3, "1"), 4: (4, "1"), 5: (1, None), 6: (None, None), 7: (None, None)}


def test_reachable_stops_at_depth_and_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), (None, "x")], "src string, dst string")
    seeds = spark.createDataFrame([("a",), (None,)], "node string")
    assert {tuple(r) for r in frontier.reachable(edges, seeds, 3).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}


def test_tables(spark):
    t = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    s = spark.createDataFrame([("a", 9), ("c", 8)], "k string, v int")
    assert {tuple(r) for r in tables.upsert(t, s, "k").collect()} == {("a", 9), ("b", 3), ("c", 8), (None, 4)}
    stay, go = tables.delete_removed(spark.createDataFrame([("u#chunkA",), ("u",), ("w#x",)], "k string"), spark.createDataFrame([("u",)], "b string"), "k", "b")
    assert ({r.k for r in stay.collect()}, {r.k for r in go.collect()}) == ({"w#x"}, {"u#chunkA", "u"})


@pytest.mark.parametrize(
    ("key", "wanted"),
    [
        ("https://e.cz/a#chunkA", "legit"), ("https://e.cz/a#chunkAA", "legit"), ("https://e.cz/a#PAGE2chunkA", "legit"), ("https://e.cz/a#PAGE10chunkBB", "legit"),
        ("https://e.cz/a#zou#chunkA", "fragment_polluted"), ("https://e.cz/a#accessibility#chunkA", "fragment_polluted"), ("https://e.cz/a#cookies#PAGE2chunkA", "fragment_polluted"),
        ("https://e.cz/a#summarizedA", "unknown"), ("https://e.cz/a#zou", "unknown"), ("https://e.cz/a", "unknown"), ("https://e.cz/a#chunkA#chunkB", "unknown"), ("https://e.cz/a#", "unknown"),
    ],
)
def test_key_class(spark, key, wanted):
    assert one(spark, tables.key_class, key) == wanted


def test_key_decisions(spark):
    keys = spark.createDataFrame([("p#zou#chunkA",), ("p#chunkA",), ("q#zou#chunkA",), ("r#zou#chunkB",), ("r",), ("s#x",), ("p#chunkA#chunkB",), (None,)], "k string")
    listed = spark.createDataFrame([("q",), ("s",), (None,)], "u string")
    decided = tables.key_decisions(keys, "k", listed, "u")
    got = {r.key: (r.cls, r.base, r.base_has_legit, r.base_in_snapshot, r.action) for r in decided.collect()}
    assert got["p#zou#chunkA"] == ("fragment_polluted", "p", True, False, "DELETE") and got["p#chunkA"] == ("legit", "p", True, False, "KEEP")
    assert got["q#zou#chunkA"] == ("fragment_polluted", "q", False, True, "DELETE") and got["r#zou#chunkB"] == ("fragment_polluted", "r", False, False, "SKIP")
    assert {got[k][1:] for k in ("r", "s#x", "p#chunkA#chunkB")} == {(None, False, False, "SKIP")}
    stay, counts = tables.delete_keys(keys, "k", decided)
    assert {r.k for r in stay.collect()} == {"p#chunkA", "r#zou#chunkB", "r", "s#x", "p#chunkA#chunkB", None}
    assert tuple(counts.first()) == (2, 2, 0)


def test_contacts(spark):
    text = "| Ing. Jan Novák | vedoucí | matrika | 602 111 222 | jan@a.cz |\n- Jan Novák; JAN@a.cz; +420 602 111 222\nEva Bílá; tel.: 603 333 444\neva bílá; 603 333 444\n| 604 555 666 |\n| Cena | 300 |\nPetr; petr@a.cz"
    df = spark.createDataFrame([(1, text), (2, None), (3, "Jan Novák | jan@a.cz")], "doc_id bigint, text string")
    got = {(r.email, r.name, r.role, r.department, r.phone, r.line_no) for r in records.best_contacts(records.contact_rows(df)).collect()}
    assert got == {("jan@a.cz", "Ing. Jan Novák", "vedoucí", "matrika", 602111222, 1), (None, "eva bílá", None, None, 603333444, 4), ("petr@a.cz", "Petr", None, None, None, 7)}


def test_headers_give_way_to_content(spark):
    def fitted(limit, content="c" * 32):
        df = spark.createDataFrame([("h" * 16 + "\n" + "i" * 16, "a" * 31, "b" * 31, "q" * 31, content)], "h string, a string, b string, q string, c string")
        r = df.select(documents.fitted_document(F.col("h"), [F.col("a"), F.lit(None).cast("string"), F.col("b")], F.col("q"), F.col("c"), limit).alias("r")).first().r
        return r.stage, r.document

    h, a, b, q, c = "h" * 16 + "\n" + "i" * 16, "a" * 31, "b" * 31, "q" * 31, "c" * 32
    assert fitted(100) == (0, f"{h}\n{a}\n{b}\n{q}\n\n{c}") and fitted(45) == (1, f"{h}\n{a}\n{q}\n\n{c}") == (1, fitted(41)[1])
    assert fitted(31) == (3, f"{h}\n{q}\n\n{c}") and fitted(21) == (4, f"{h}\n\n{c}")
    # the header's second line is cut off at its beginning
    assert fitted(18) == (5, f"{'h' * 16}\n---\n\n{c}") and fitted(10) == (6, c) and fitted(3) == (6, c)


def test_numbers_within_a_key(spark):
    df = spark.createDataFrame([("a", i * 7) for i in range(50)] + [("b", 3), (None, 1)], "k string, o int")
    rows = frontier.numbered(df, ["k"], "o", 30).collect()
    assert sorted((r.k, r.o, r.n) for r in rows) == [("a", i * 7, i + 1) for i in range(50)] + [("b", 3, 1)]


def test_versions(spark):
    df = spark.createDataFrame([("x",), ("x_V1",), ("x_v10",), ("x_V9",), ("y_V2",)], "n string")
    assert {r.n for r in tables.newest_versions(df, "n").where("keep").collect()} == {"x", "x_v10", "y_V2"}


def test_pairing(spark):
    rows = [("p", "t", 0, 1, "HUMAN", "q1"), ("p", "t", 0, 2, "HUMAN", "q2"), ("p", "t", 0, 3, "BOT", "a2"), ("p", "t", 0, 4, "BOT", "a3"), ("p", "s", 0, 1, "BOT", "a0")]
    df = spark.createDataFrame(rows, "project string, transcript_id string, pair_id int, seq int, role string, content string")
    assert [(r.question, r.answer) for r in transcripts.paired(df).collect()] == [("q2", "a2")]
    # a question and its answer in different stretches, with an empty one between
    far = spark.createDataFrame([("p", "t", 0, 10, "HUMAN", "q"), ("p", "t", 0, 2 * transcripts.STRETCH + 1, "BOT", "a"), ("p", "t", 0, 2 * transcripts.STRETCH + 2, "BOT", "b")], df.schema)
    assert [(r.question, r.answer) for r in transcripts.paired(far).collect()] == [("q", "a")]


def test_batches_across_stretches(spark):
    df = spark.createDataFrame([("k", i) for i in range(25)] + [("l", 7)], "k string, i bigint")
    got = {(r.k, r.i): r.batch for r in transcripts.batches(df, "k", "i", 10, 7).collect()}
    assert got == {("k", i): i // 10 for i in range(25)} | {("l", 7): 0}


def test_structure_and_budgets(spark):
    text = "# A\n- x\n- y\n1. z\n| a | b |\n"
    r = one(spark, documents.structure, text)
    assert (r.headings, r.bullets, r.numbered, r.tables, r.lines, r.dominant) == (1, 2, 1, 1, 5, "lines")
    b = one(spark, documents.budgets, 1500, "int")
    assert (b.page, b.file, b.overlap, b.question) == (300, 366, 250, 484)
    b = one(spark, documents.budgets, 100, "int")
    assert (b.page, b.file, b.overlap, b.question) == (50, 50, 50, 50)
    assert one(spark, documents.cleaned, " a&nbsp;&amp; b \n\n\n &#8203;c\t d") == "a & b\nc d"
    assert one(spark, lambda c: documents.first_sentences(c, 10), "Krátká věta. Druhá věta je o hodně delší než první.") == "Krátká věta."
    assert one(spark, lambda c: documents.first_sentences(c, 5), "Jediná dlouhá věta bez konce") == "Jediná dlouhá …"


def test_table_rows(spark):
    df = spark.createDataFrame([(1, "x\n| Den | Čas |\n|---|---|\n| po | 8:00 |\n| út | |\n\n| A |\n| 1 | 2 |"), (2, None), (3, "")], "id bigint, t string")
    assert [tuple(r) for r in documents.table_rows(df, "id", "t").orderBy("line_no").collect()] == [(1, 4, 2, "Den: po | Čas: 8:00"), (1, 5, 2, "Den: út"), (1, 8, 2, "A: 1 | : 2")]


def test_html():
    page = '<html><head><title>T</title><script>x()</script></head><body><nav id="m"><a href="/x">X</a></nav><h1>N&aacute;dpis</h1><p>a <b>b</b><br>c</p><ul><li>1<li>2</ul><img src="i.png" srcset="a 100w, b 300w" alt="z"><img src="s.gif" width="1" height="1"></body>'
    assert html.markdown(page, {"nav"}) == "# Nádpis\na **b**\nc\n- 1\n- 2\n![z](b)"
    assert html.read(page).links == [("/x", "X")] and html.read(page).title == "T"
    assert html.markdown("<nav>jen menu</nav>", {"nav"}) == "jen menu"
    assert html.best_source("a 1x, b 2x") == "b" and html.best_source(None) is None
    assert html.best_source("https://e.cz/w_100,h_50/a.jpg 100w, https://e.cz/w_300,h_50/a.jpg 300w,c 2x") == "https://e.cz/w_300,h_50/a.jpg"
    assert html.best_source("data:image/png;base64,xx 3x, b") == "b"


def test_chunks_keep_all_words_within_budget(spark):
    text = "\n".join(f"řádek {i} " + "slovo " * (i % 40) for i in range(200)) + "\n" + "x" * 900
    got = chunking.by_budget(text, 60)
    assert " ".join(c for c, _ in got).split() == text.split()
    # lines are rounded down one by one, so a chunk of them may have a token more
    assert all(n <= 61 or len(c.split()) == 1 for c, n in got)
    assert chunking.by_budget("", 60) == [] and chunking.by_budget(" \n ", 60) == []
    ship(spark)
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id bigint, t string")
    rows = pages.chunks(df, "id", "t", 400, 0, 0.5).collect()
    assert {r.id for r in rows} == {1} and [r.chunk_number for r in rows] == list(range(1, len(rows) + 1))


def test_chunk_goldens():
    assert chunking.by_budget("krátký text", 10) == [("krátký text", 3)]
    # 32 characters are ten tokens: two such lines don't fit with a third
    line = "a" * 32
    assert chunking.by_budget("\n".join([line] * 3), 21) == [(f"{line}\n{line}", 20), (line, 10)]
    # a line too wide is cut at blanks, its rest begins the next chunk
    assert chunking.by_budget("úvod\n" + "abcd " * 6 + "konec\nzávěr", 5) == [("úvod", 1), ("abcd abcd abcd abcd", 5), ("abcd abcd konec", 5), ("závěr", 1)]
    assert chunking.by_budget("x" * 40 + " y", 3) == [("x" * 40, 12), ("y", 1)]
    assert chunking.by_budget("\n\n\n" + "b" * 9, 2) == [("b" * 9, 4)]
    assert len(chunking.by_budget("\n".join([line] * 60), 11)) == 60
    assert chunking.split_line("aaa bbb", 1) == ["aaa", "bbb"] and chunking.split_line("   ", 1) == [""]


def test_chunks_lead_with_the_words_before(spark):
    ship(spark)
    words = [f"slovo{i}" for i in range(120)]
    df = spark.createDataFrame([(1, "\n".join(words), "Titul", "https://e.cz/a", " x ")], "id bigint, t string, title string, url string, source string")
    rows = pages.with_headers(pages.chunks(df, "id", "t", 400, 0, 0.5), df, "id").orderBy("chunk_number").collect()
    assert rows[0].document.startswith("# Titul\n## URL: https://e.cz/a\n## SOURCE: x\n\nslovo0") and rows[0].lookup_key == "https://e.cz/a#chunkA"
    lead = rows[1].document.split("## BEFORE: ")[1].split("\n")[0].split()
    assert len(lead) == 30 and words[words.index(lead[-1]) + 1] == rows[1].document.split("\n\n")[1].split()[0]


def test_sections_repeat_their_heading():
    text = "## A\n\n" + "\n\n".join("odstavec " * 20 for _ in range(5)) + "\n## B\nkrátký"
    got = chunking.by_headings(text, 400)
    assert got[-1] == "## B\nkrátký" and all(s.startswith("## A") for s in got[:-1]) and len(got) > 2


def test_links(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "https://www.a.cz", "https://www.a.cz/d/", '<a href="x#t">X</a><a href="mailto:a@b.cz">m</a><a href="https://a.cz/f.pdf">f</a><a href="https://b.cz/">b</a>'), (2, "https://a.cz", None, None)], "page_id bigint, base_url string, url string, content string")
    assert [(r.href, r.target) for r in pages.links(df).orderBy("ord").collect()] == [("x#t", "https://www.a.cz/d/x"), ("mailto:a@b.cz", None), ("https://a.cz/f.pdf", "https://a.cz/f.pdf"), ("https://b.cz/", "https://b.cz/")]
    assert [r.target for r in pages.inner_links(df).collect()] == ["https://www.a.cz/d/x"]


def test_sitemap_files_do_not_mix_up_dates(spark):
    rows = [(1, 0, "https://e.cz/a?x=1&y=<2>", None), (1, 1, "https://e.cz/b", "2024-01-01"), (1, 2, "https://e.cz/b", "2025-01-01"), (2, 3, None, "2024")]
    df = spark.createDataFrame(rows, "site int, ord bigint, url string, lastmod string")
    back = feeds.last_of_url(feeds.sitemap_rows(feeds.sitemap_files(df, "site", "ord", "url", "lastmod", 2)))
    assert {tuple(r) for r in back.collect()} == {(1, "https://e.cz/a?x=1&y=<2>", None), (1, "https://e.cz/b", "2025-01-01")}


def test_records(spark):
    assert [one(spark, records.phone_number, t) for t in ("+420 606 123 456", "00420606123456", "606/123456", "12", None)] == [606123456, 606123456, 606123456, None, None]
    n = one(spark, records.name_parts, "Ing. Mgr. Jan Karel  Novák, Ph.D.")
    assert (n.title, n.first_name, n.last_name) == ("Ing. Mgr. Ph.D.", "Jan Karel", "Novák")
    assert [one(spark, records.minutes_of, t) for t in ("14:30", "14.30", "od 18 h", "25:00", "", None)] == [870, 870, 1080, None, None, None]
    assert [one(spark, records.summary_verdict, t) for t in ("Krátké.", "„Toto je celá věta.“", "Toto je useknutá vět", None)] == ["short", "valid", "cut", "short"]
    text = "| Jan Novák | 606 123 456 | jan@e.cz |\n- J. Novák; JAN@e.cz; 1"
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string")
    assert [(r.email, r.name, r.phone) for r in records.best_contacts(records.contact_rows(df)).collect()] == [("jan@e.cz", "Jan Novák", 606123456)]
