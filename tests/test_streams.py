import datetime as dt

from pagewright.plans import streams
from pagewright.session import ship


def test_arrivals_of_many_files(spark, tmp_path):
    ship(spark)
    first = dt.datetime(2026, 1, 5, 0, 30, tzinfo=dt.UTC)
    for i in range(12):
        # the first files hold the latest rows
        late = [(1, first + dt.timedelta(days=90)), (1, first), (2, None)] if i == 0 else [(1, first), (2, first + dt.timedelta(hours=i)), (None, first)]
        spark.createDataFrame(late, "site_id int, ingested_at timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "sitemap.parquet"))
    got = {(r.hour, r.site_id): r.n for r in streams.stream_arrivals(spark, str(tmp_path)).collect()}
    wanted = {("2026-04-05 00:00", 1): 1, ("2026-01-05 00:00", 1): 12, ("2026-01-05 00:00", None): 11} | {(f"2026-01-05 {i:02}:00", 2): 1 for i in range(1, 12)}
    assert got == wanted
