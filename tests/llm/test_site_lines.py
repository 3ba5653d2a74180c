from pagewright.llm import site_lines

SCHEMA = "page_id bigint, url string, base_url string, content string, site string, line_no int"
BASES = ["https://www.a.example", "http://A.example/", "https://a.example", "https://WWW.a.example/"]
SHARE = "Sdílet článek na sociální síti"


def pages():
    rows = [(i, f"https://a.example/{i}", BASES[i % 4], f"Nadpis stránky číslo {'x' * i}\n\n{SHARE}\n* Přečteno 1{i}x,  tento týden!\n<div class='abcdefghijklm'>", "s", 1) for i in range(1, 13)]
    # on nine pages only, and once more on a page crawled twice
    rows += [(100 + i, f"https://b.example/{i}", "https://b.example", f"Jen devětkrát zde uvedeno\n{SHARE}", "s", 1) for i in range(9)]
    rows += [(120, "https://b.example/0", "https://b.example", "Jen devětkrát zde uvedeno", "s", 1), (130, None, None, None, None, None), (131, None, "https://a.example", "", None, None)]
    return rows


def test_lines_on_ten_urls(spark):
    df = spark.createDataFrame(pages(), SCHEMA)
    found = {(r.page_id, r.line_no) for r in site_lines.repeated_lines(df.union(df)).collect()}
    assert found == {(i, n) for i in range(1, 13) for n in (3, 4)}


def test_cut_pages_keep_their_other_lines(spark):
    df = spark.createDataFrame(pages(), SCHEMA)
    cut = site_lines.repeated_lines(df)
    out = {r.page_id: r for r in site_lines.without_lines(df, cut).collect()}
    assert out[1].content == "Nadpis stránky číslo x\n\n<div class='abcdefghijklm'>" and out[1].n_cut == 2
    assert out[100].n_cut == 0 and out[130].content is None and out[131].content == ""


def test_empty_table_and_long_line(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert site_lines.repeated_lines(df).count() == 0
    long = spark.createDataFrame([(i, str(i), "https://a.example", "slovo " * 30000, None, None) for i in range(10)], SCHEMA)
    assert site_lines.repeated_lines(long).count() == 10


def sites(width, n_lines):
    """Two sites of 12 pages; each of ``n_lines`` lines is on ``width`` pages of both, one more line on ten and nine."""
    content = {(s, p): ["Společná věta vydavatele obou webů"] * (p < (10 if s == "a" else 9)) for s in "ab" for p in range(12)}
    for s in "ab":
        for n in range(n_lines):
            for p in range(width):
                content[s, (n + p) % 12].append(f"Řádek {'xyz' * (n + 1)} obou webů")
    return [(i, f"https://{s}.example/{p}", f"https://{s}.example", "\n".join(lines), None, None) for i, ((s, p), lines) in enumerate(content.items())]


def test_the_test_rejects_what_is_usual_outside(spark):
    rare, usual = (spark.createDataFrame(sites(width, 40), SCHEMA) for width in (1, 8))
    assert site_lines.repeated_lines(rare).count() == 10
    assert site_lines.repeated_lines(usual).count() == 0
    assert {tuple(r) for r in site_lines.outcomes(usual).collect()} == {(True, False, 1), (False, False, 81)}


def test_a_site_of_its_own_repeats_less_often(spark):
    # twice on a site of ten pages, never on 2,000 pages outside
    rows = [(i, f"https://a.example/{i}", "https://a.example", "Úřední hodiny podatelny" if i < 4 else f"věta {'o' * (i + 12)}", None, None) for i in range(10)]
    rows += [(100 + i, f"https://b.example/{i}", "https://b.example", f"slova {'e' * 12}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", None, None) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r.page_id, r.line_no) for r in site_lines.repeated_lines(df, min_urls=3).collect()} == {(i, 1) for i in range(4)}


def test_salted_copies_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(pages(), SCHEMA)
    wanted = {tuple(r) for r in site_lines.repeated_lines(df).collect()}
    monkeypatch.setattr(site_lines, "ROWS_A_SALT", 3)
    assert {tuple(r) for r in site_lines.repeated_lines(df).collect()} == wanted
