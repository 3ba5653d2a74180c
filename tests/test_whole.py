"""Queries over rows in every written form, against brute force."""

import datetime as dt

import pytest

from pagewright.plans import documents, frontier, tables
from pagewright.session import ship

AT = dt.datetime(2026, 1, 5, tzinfo=dt.UTC)
URL = "https://www.a.example/"
#: id, site, page, listing, written, its moment by hand: site 1 in Prague, site 2 in Bucharest
SITEMAP = [
    (1, 1, "x", 1, "2024-01-01T10:00:00Z", "2024-01-01T10:00:00Z"), (2, 1, "x", 2, "2024-07-01T10:00:00+02:00", "2024-07-01T08:00:00Z"),
    (3, 1, "y", 3, "2024-03-01T00:30:00Z", "2024-03-01T00:30:00Z"), (4, 1, "y", 4, "1. 3. 2024 1:00", "2024-03-01T00:00:00Z"),
    (5, 2, "z", 1, "words", None), (6, 2, "z", 2, "2023-12-24", "2023-12-23T22:00:00Z"), (7, 2, "z", 3, None, None),
    (8, 2, "w", 4, "words", None), (9, 2, "w", 5, None, None), (10, 2, "v", 6, "2024-02-02 12:00:00", "2024-02-02T10:00:00Z"),
]
EVENTS = [(1, 1, "2023-12-31T23:30:00Z"), (2, 1, "31. prosince 2023"), (3, 2, "1. 1. 2024 0:10"), (4, 2, "2022-05-06"), (5, 1, "words"), (6, 1, None), (7, 1, "20240202")]
FILES = [(1, "a.json", None, '{"k": 1}'), (2, "b.json", "json", '{"k": 1, "m": 2}'), (3, "c.JSON", " ", '{"m": 1}'), (4, "d.py", None, '{"k": 1}'), (5, "e.json", None, "{broken")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    ship(spark)
    d = tmp_path_factory.mktemp("whole")
    save = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    save("sitemap", [(i, s, URL + p, o, w, AT) for i, s, p, o, w, _ in SITEMAP], "sitemap_id bigint, site_id int, url string, list_ord int, lastmod string, ingested_at timestamp")
    save("event_items", [(*e, AT) for e in EVENTS], "event_id bigint, site_id int, event_date string, crawled_at timestamp")
    save("site_config", [(1, "Europe/Prague"), (2, "Europe/Bucharest")], "site_id int, time_zone string")
    save("code_files", FILES, "file_id bigint, file_path string, file_lang string, body string")
    return str(d)


def test_newest_of_any_form(spark, folder):
    wanted = set()
    for page in {r[2] for r in SITEMAP}:
        rows = [r for r in SITEMAP if r[2] == page]
        newest = max((r[5] for r in rows if r[5]), default=None)
        best = min((r for r in rows if r[5] == newest), key=lambda r: r[3])
        wanted.add((URL + page, best[0], newest))
    assert {tuple(r) for r in frontier.frontier_keep_newest(spark, folder).collect()} == wanted
    assert (URL + "x", 2, "2024-07-01T08:00:00Z") in wanted and (URL + "w", 8, None) in wanted


def test_modified_since_reads_rows_without_a_zone(spark, folder):
    got = {(r.sitemap_id, r.moment, r.mark) for r in frontier.frontier_modified_since(spark, folder).collect()}
    assert got == {(10, "2024-02-02T10:00:00Z", "2023-12-23T22:00:00Z")}


def test_years_of_any_form(spark, folder):
    got = {tuple(r) for r in tables.event_years(spark, folder).collect()}
    assert got == {("2024", 3, 20240101, 20240202), ("2023", 1, 20231231, 20231231), ("2022", 1, 20220506, 20220506)}


def test_json_files_by_path(spark, folder):
    assert {tuple(r) for r in documents.json_keys(spark, folder).collect()} == {("k", 2), ("m", 2)}
