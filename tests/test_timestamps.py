from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.functions.timestamps import as_ntz, parse_moment, to_utc, utc_text
from pagewright.operators import zones

PRAGUE = [
    ("2024-10-11T15:28:37+02:00", "2024-10-11T13:28:37Z"),
    ("20240901", "2024-08-31T22:00:00Z"),
    ("2022-06-26 00:21:15", "2022-06-25T22:21:15Z"),
    ("2025/12/02", "2025-12-01T23:00:00Z"),
    ("2024-03-12T07:38Z", "2024-03-12T07:38:00Z"),
    ("2021-03-08T11:57:21.2706532+00:00", "2021-03-08T11:57:21Z"),
    ("Thu, 08 Feb 2024 18:42:32 GMT", "2024-02-08T18:42:32Z"),
    ("2023-02-05 11:59:19 CET", "2023-02-05T10:59:19Z"),
    ("20241020T190700Z", "2024-10-20T19:07:00Z"),
    ("Feb 28, 2024 12:10 AM", "2024-02-27T23:10:00Z"),
    ("Feb 28, 2024 12:10 PM", "2024-02-28T11:10:00Z"),
    ("22. 9. 2023 v 13:39", "2023-09-22T11:39:00Z"),
    ("31. března 2024, 1.18 hod.", "2024-03-31T00:18:00Z"),
    ("7. června 2022", "2022-06-06T22:00:00Z"),
    ("12. července 2022", "2022-07-11T22:00:00Z"),
    ("1624052520.590", "2021-06-18T21:42:00Z"),
    ("1753549476813", "2025-07-26T17:04:36Z"),
    ("  2025-04-09T14:49:03Z\n", "2025-04-09T14:49:03Z"),
    ("2024-03-30t05:27:00z", "2024-03-30T05:27:00Z"),
    ("2024-03-30 05:27 utc", "2024-03-30T05:27:00Z"),
    ("17.-18. 4. 2024", "2024-04-16T22:00:00Z"),
    ("30. 4. – 2. 5. 2024", "2024-04-29T22:00:00Z"),
    ("8.6.23", "2023-06-07T22:00:00Z"),
    # double and missing local times take the offset in force before the change
    ("2024-10-27 02:30:00", "2024-10-27T00:30:00Z"),
    ("2024-03-31 02:30:00", "2024-03-31T01:30:00Z"),
    ("31.4.2024", None), ("2024-13-01T08:00:00Z", None), ("včera v 8:00", None), ("n/a", None), ("", None), (None, None), ("not-a-date", None), ("99999999999999999999", None),
    ("x" * 100_000, None),
]


def test_forms(spark):
    df = parse_moment(spark.createDataFrame([(v,) for v, _ in PRAGUE], "v string"), "v")
    got = df.select("v", utc_text(to_utc(F.col("wall"), F.col("offset_min"), F.lit("Europe/Prague"))).alias("u")).collect()
    assert {r.v: r.u for r in got} == dict(PRAGUE)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.datetimes(datetime(2001, 1, 1), datetime(2037, 12, 31)), min_size=8, max_size=8), st.sampled_from(["Europe/Prague", "Europe/London", "America/New_York", "UTC"]))
def test_local_times_against_zoneinfo(spark, times, zone):
    texts = [t.strftime("%d.%m.%Y %H:%M:%S") for t in times]
    df = parse_moment(spark.createDataFrame(list(enumerate(texts)), "i int, v string"), "v")
    got = {r.i: r.u for r in df.select("i", utc_text(to_utc(F.col("wall"), F.col("offset_min"), F.lit(zone))).alias("u")).collect()}
    # fold 0 is the offset before the change, for double and for missing times
    wanted = {i: (t.replace(microsecond=0) - t.replace(tzinfo=ZoneInfo(zone), fold=0).utcoffset()).strftime("%Y-%m-%dT%H:%M:%SZ") for i, t in enumerate(times)}
    assert got == wanted


def _stamps(spark, zone):
    rows = []
    for i in range(60):
        utc = datetime(2023, 1, 1, tzinfo=timezone.utc) + timedelta(days=6 * i, hours=3)
        local = utc.astimezone(ZoneInfo(zone))
        rows.append((1, local.strftime("%Y-%m-%d %H:%M:%S"), utc + timedelta(minutes=2)))
        rows.append((1, local.isoformat(), utc + timedelta(minutes=2)))
    rows += [(1, None, None), (None, "2023-01-01", None), (2, "n/a", datetime(2023, 1, 1, tzinfo=timezone.utc))]
    df = spark.createDataFrame(rows, "site_id int, written string, arrived timestamp")
    return parse_moment(df, "written")


@pytest.mark.parametrize("zone", ["UTC", "Europe/London", "Europe/Prague", "Europe/Bucharest"])
def test_estimated_zone(spark, zone):
    stamps = _stamps(spark, zone)
    found = [(r.source, r.zone) for r in zones.estimate_zones(stamps, "site_id", "arrived").collect()]
    # a zone of the same history may stand for it
    assert len(found) == 1 and found[0][0] == 1
    at = [datetime(2023, m, d) for m in range(1, 13) for d in (1, 15)]
    assert [t.replace(tzinfo=ZoneInfo(found[0][1])).utcoffset() for t in at] == [t.replace(tzinfo=ZoneInfo(zone)).utcoffset() for t in at]
    declare = lambda z: spark.createDataFrame([(1, z), (3, "Asia/Tokyo"), (4, None)], "source int, declared string")
    # the right declaration gives its name, a wrong one is beaten, one without stamps stands
    assert {r.source: r.zone for r in zones.estimate_zones(stamps, "site_id", "arrived", declare(zone)).collect()} == {1: zone, 3: "Asia/Tokyo"}
    wrong = {r.source: r.zone for r in zones.estimate_zones(stamps, "site_id", "arrived", declare("America/New_York")).collect()}
    assert wrong[1] == found[0][1] and wrong[3] == "Asia/Tokyo"


def test_arrivals_alone_bound_the_offset(spark):
    utc = [datetime(2023, 1, 10, tzinfo=timezone.utc) + timedelta(days=i) for i in range(40)]
    rows = [(1, (t + timedelta(hours=9)).strftime("%Y-%m-%d %H:%M:%S"), t + timedelta(minutes=2)) for t in utc]
    stamps = parse_moment(spark.createDataFrame(rows, "site_id int, written string, arrived timestamp"), "written")
    zone = zones.estimate_zones(stamps, "site_id", "arrived").first()["zone"]
    assert datetime(2023, 1, 20, tzinfo=ZoneInfo(zone)).utcoffset() >= timedelta(hours=9)


def test_few_stray_stamps_do_not_beat_the_declaration(spark):
    rows = [(1, "2023-01-05T10:00:00+03:00", None)] * 2 + [(1, "2023-01-05T10:00:00+01:00", None)]
    stamps = parse_moment(spark.createDataFrame(rows, "site_id int, written string, arrived timestamp"), "written")
    declared = spark.createDataFrame([(1, "Europe/Prague")], "source int, declared string")
    assert zones.estimate_zones(stamps, "site_id", "arrived", declared).first()["zone"] == "Europe/Prague"


def test_moments_in_utc(spark):
    site = spark.createDataFrame([(1, "Europe/Prague"), (2, None), (3, "nowhere")], "site_id int, time_zone string")
    rows = [(1, 1, "2024-01-01", None), (1, 1, "2024-01-01", None), (2, 2, "2024-01-01", None), (3, 1, "2024-01-01T00:00:00Z", None), (4, None, "2024-01-01", None), (5, 1, None, None)]
    sitemap = spark.createDataFrame(rows, "sitemap_id bigint, site_id int, lastmod string, ingested_at timestamp").withColumn("wall", F.lit(1)).withColumn("utc", F.lit(2))
    events = spark.createDataFrame([(9, 1, "1. 1. 2024", None)], "event_id bigint, site_id int, event_date string, crawled_at timestamp")
    found = {tuple(r) for r in zones.moments_in_utc(sitemap, events, site).collect()}
    assert found == {("sitemap", 1, "2023-12-31T23:00:00Z"), ("sitemap", 2, "2024-01-01T00:00:00Z"), ("sitemap", 4, "2024-01-01T00:00:00Z"), ("event_items", 9, "2023-12-31T23:00:00Z")}
    assert zones.moments_in_utc(sitemap.limit(0), events.limit(0), site).count() == 0


def test_session_zone_has_no_influence(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp'2024-07-01 12:00:00 UTC' AS t").select(as_ntz(F.col("t")).cast("string").alias("n"))
        assert df.collect()[0].n == "2024-07-01 12:00:00"
        test_forms(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
