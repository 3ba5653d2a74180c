import pytest
from pyspark.sql import functions as F

from pagewright.functions import payloads as p
from pagewright.operators import state


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).collect()[0].r


@pytest.mark.parametrize(
    ("raw", "wanted"),
    [
        ('Sure:\n```json\n{"a": [1, 2,], }\n```\nbye', '{"a": [1, 2] }'), ('{"a": 1}', '{"a": 1}'), ('text [1,\n] more', "[1\n]"), ("no json", None), ("", None), (None, None), ('{"a": "x\x01y"}', '{"a": "xy"}'),
    ],
)
def test_repaired_json(spark, raw, wanted):
    assert one(spark, p.repaired_json, raw) == wanted


def test_saved_url(spark):
    read = lambda t: (r := one(spark, p.saved_url, t)) and (r.form, r.url)
    assert read("# T\n## URL: https://e.cz/a**\ntext") == ("header", "https://e.cz/a") and read("**URL:** https://e.cz/b.") == ("bold", "https://e.cz/b")
    assert read("Source: https://e.cz/c") == ("source", "https://e.cz/c") and read("[x](https://e.cz/d)") == ("link", "https://e.cz/d") and read("viz https://e.cz/e;") == ("any", "https://e.cz/e")
    assert read("x" * 3000 + "https://e.cz/f") is None and read(None) is None


def test_titles_and_numbers(spark):
    r = one(spark, p.page_of_title, "Titul_PAGE12AB")
    assert (r.base, r.page, r.letters) == ("Titul", 12, "AB") and tuple(one(spark, p.page_of_title, "Titul")) == ("Titul", None, None)
    assert one(spark, p.clean_title, " „A“  \n 'b' " + "x" * 300) == "A b " + "x" * 196
    assert one(spark, lambda c: p.truncated(c, 2), "123456789") == "12345678..." and one(spark, lambda c: p.truncated(c, 2), "12345678") == "12345678"
    assert one(spark, p.first_day, "od 2024-01-02 do 2024-03-04") == "2024-01-02" and one(spark, p.first_day, "1. 2. 2024") is None
    assert [one(spark, lambda c: p.whole_number(c, F.lit(7)), t) for t in (" 12 ", "x", None)] == [12, 7, 7]
    assert [one(spark, p.fetchable, t) for t in ("HTTPS://e.cz", "ftp://e.cz", "http://", None)] == [True, False, False, False]
    assert {"https://www.e.cz", "https://e.cz/", "https://e.cz/index.php"} <= set(one(spark, p.base_forms, "https://WWW.e.cz//"))
    assert one(spark, p.untabled, "<p>a</p><table><tr><td>x</td></tr></table> b") == "a [TABLE DATA] b"


def test_state(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    known = spark.createDataFrame([("a",), (None,)], "k string")
    assert {r.n for r in state.unseen(rows, "k", known, known.limit(0)).collect()} == {2, 3}
    cache = spark.createDataFrame([("a", None), ("a", None), ("gone", "x")], "k string, t string")
    got = {r.n: (r.t, r.origin) for r in state.refreshed_cache(rows, cache, "k", ["t"], {"t": F.lit("new")}).collect()}
    assert got == {1: (None, "snapshot"), 2: ("new", "fetched"), 3: ("new", "fetched")}
    dumps = spark.createDataFrame([('x \\"A\\" \\"A\\" "A" A',), (None,), ('\\"B C\\"',)], "d string")
    names = spark.createDataFrame([("A",), ("B C",), ("D",), ("A",), (None,)], "c string")
    assert {tuple(r) for r in state.escaped_mentions(dumps, "d", names, "c").collect()} == {("A", 2), ("B C", 1), ("D", 0)}
    news = spark.createDataFrame([("s", 5), ("s", 9), ("t", 1), ("u", None)], "s string, at int")
    marks = spark.createDataFrame([("s", 5)], "s string, m int")
    assert {tuple(r) for r in state.newer_than_mark(news, "s", "at", marks, "m").collect()} == {("s", 1, 9), ("t", 1, 1)}
