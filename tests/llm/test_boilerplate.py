import numpy as np

from pagewright.llm import boilerplate

SCHEMA = "page_id bigint, base_url string, url string, title string, provider string, content string, pos int, body boolean"
WORDS = "most park silnice škola hřiště kaple rybník náves lávka vodovod knihovna cesta".split()


def text(i):
    return f"Zastupitelé schválili záměr {WORDS[i % 12]}{'abcdefghijklmnop'[i % 16]} a pověřili odbor další přípravou akce {'x' * (i + 1)}."


def plain(i):
    menu = ["Úřední deska", "Kontakty", "Sport a volný čas"]
    box = ["Mohlo by vás zajímat", f"Oprava {WORDS[i % 12]} {'y' * (i + 1)} v obci"]
    body = [f"Titulek stránky {'q' * (i + 1)}", text(i), "Sledujte nás také na kanálu Lhota v aplikaci obce.", text(i + 40)]
    foot = ["Provozovatel portálu Lhota", "Copyright Lhota 2024. Obsah lze šířit."]
    lines = menu + [""] + (box + [""] if i % 2 else []) + body[:2] + ([] if i % 2 else box) + body[2:] + [""] + foot
    gone = set(menu + box + foot)
    return "\n".join(lines), {n for n, x in enumerate(lines, 1) if x in gone}


def test_plain_pages_keep_notices_and_lose_boxes(spark):
    rows, wanted = [], set()
    for i in range(16):
        content, gone = plain(i)
        rows.append((i, "https://www.lhota.example", f"https://www.lhota.example/a/{i}", f"Titulek stránky {'q' * (i + 1)}", "playwright", content, 1, True))
        wanted |= {(i, n) for n in gone}
    rows += [(90, None, None, None, None, None, None, None), (91, "https://b.example", None, None, None, "", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r.page_id, r.line_no) for r in boilerplate.boilerplate_lines(df.union(df)).collect()}
    assert found == wanted
    kept = {r.page_id: r.content for r in boilerplate.main_content(df).collect()}
    assert kept[90] is None and kept[91] == "" and "Sledujte" in kept[3] and "Mohlo by" not in kept[3]


def test_html_containers_even_if_closed_by_others(spark):
    html = "<html>\n<body>\n<nav>\n<a href='/x'>Kontakty</a>\n</div>\n<main>\n<h1>Nadpis</h1>\n<p>Text zprávy.</p>\n<div class=\"side-box\">\n<p>Rychlé odkazy</p>\n</aside>\n<p>Konec.</p>\n</main>\n<footer>\n<p>Patička</p>\n</footer>\n</body>\n</html>"
    df = spark.createDataFrame([(1, "https://a.example", "u", "Nadpis", "raw_html", html, 0, True)], SCHEMA)
    assert {r.line_no for r in boilerplate.boilerplate_lines(df).collect()} == {4, 10, 15}


def test_no_heading_no_body_and_empty_table(spark):
    df = spark.createDataFrame([(1, "https://a.example", "https://a.example/x", "Jiný titulek", "jina", "Kontakty\n\nSport", 0, True)], SCHEMA)
    assert {r.line_no for r in boilerplate.boilerplate_lines(df).collect()} == {1, 3}
    assert boilerplate.boilerplate_lines(df.limit(0)).count() == 0


def page(i, lines):
    return (i, "https://www.lhota.example", f"https://www.lhota.example/a/{i}", None, "jina", "\n".join(lines), 0, True)


def test_runs_within_a_line_are_repeated(spark):
    foot = "Obecní úřad Horní Lhota provozuje tyto stránky pro občany a hosty od roku vzniku"
    df = spark.createDataFrame([page(i, [f"# Nadpis {WORDS[i % 12]} {'w' * (i + 1)}", text(i), f"{'kód' * (i + 1)} {foot}"]) for i in range(14)], SCHEMA)
    assert {(r.page_id, r.line_no) for r in boilerplate.boilerplate_lines(df).collect()} == {(i, 3) for i in range(14)}


def test_runs_cover_short_lines_across_line_ends(spark):
    top = ["Tato stránka ukládá soubory do vašeho prohlížeče, souhlasíte?", "Ano", "Ne"]
    df = spark.createDataFrame([page(i, [*top, f"# Nadpis {'w' * (i + 1)}", "Ano", f"{'z' * (i + 1)} začíná. {text(i)}"]) for i in range(14)], SCHEMA)
    found = boilerplate.classified(df).where("reason = 'repeated'").select("page_id", "pos").collect()
    assert {(r.page_id, r.pos) for r in found} == {(i, n) for i in range(14) for n in (1, 2, 3)}


def test_three_of_many_pages_are_no_repetition(spark):
    df = spark.createDataFrame([page(i, [f"# Nadpis {'w' * (i + 1)}", text(i), *(["Tři stránky tohoto webu mají stejnou dlouhou větu na konci textu"] if i < 3 else [])]) for i in range(200)], SCHEMA)
    assert boilerplate.boilerplate_lines(df).count() == 0


def test_parts_of_a_host_give_what_one_part_gives(spark, monkeypatch):
    rows = []
    for i in range(60):
        content, _ = plain(i % 16)
        rows.append(page(i, [*content.replace("Titulek", f"# Titulek {'m' * (i + 1)}").split("\n")]))
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {tuple(r) for r in boilerplate.classified(df).collect()}
    tokens = boilerplate.page_tokens(df)
    once = {tuple(r) for r in boilerplate.frequent_substrings(boilerplate.in_parts(tokens)).select("site", "name").collect()}
    monkeypatch.setattr(boilerplate, "PART_PAGES", 7)
    parted = boilerplate.in_parts(tokens)
    assert parted.select("part").distinct().count() > 4
    assert {tuple(r) for r in boilerplate.frequent_substrings(parted).select("site", "name").collect()} == once
    assert {tuple(r) for r in boilerplate.classified(df).collect()} == whole


def test_names_are_equal_for_equal_prefixes_only():
    rng = np.random.default_rng(7)
    tokens = rng.integers(1, 3, 400).astype(np.uint64)
    names = boilerplate.named_suffixes(tokens)
    n = boilerplate.DEPTH
    by_name, by_text = {}, {}
    for i in range(len(tokens) - n):
        by_name.setdefault(names[i], set()).add(i)
        by_text.setdefault(tuple(tokens[i : i + n]), set()).add(i)
    assert sorted(map(sorted, by_name.values())) == sorted(map(sorted, by_text.values()))


def test_selectors_mark_containers(spark):
    html = '<html>\n<body>\n<div id="main-nav">\n<p>Kontakty</p>\n</div>\n<div class="obsah">\n<h1>Nadpis</h1>\n<p>Text zprávy.</p>\n<div class="okno malé">\n<p>Anketa</p>\n</div>\n</div>\n</body>\n</html>'
    df = spark.createDataFrame([(1, "https://a.example", "u", "Nadpis", "raw_html", html, 0, True)], SCHEMA)
    config = spark.createDataFrame([("http://www.a.example/", "nav, #main-nav , .okno, div > p"), ("https://b.example", None)], "base_url string, remove_selectors string")
    found = lambda c: {r.line_no for r in boilerplate.boilerplate_lines(df, c).collect()}
    assert found(config) == {4, 10} and found(None) == set()
