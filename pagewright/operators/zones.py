"""Timestamps of many sources brought to UTC, with missing zones estimated from the data."""

from __future__ import annotations

from bisect import bisect_right
from datetime import date, datetime, timedelta
from functools import reduce
from zoneinfo import ZoneInfo, available_timezones

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import as_ntz, is_canonical, parse_moment, shift_minutes, to_utc, utc_text
from ..session import checkpointed, spread

#: Clock difference between writer and collector that is no violation yet.
TOLERANCE_MINUTES = 5
#: Standard deviations, and stamps, by which a history must beat the declared one.
SIGMAS = 3
#: Least and greatest offsets that any place has, in minutes: arrivals beyond them speak for no history.
OFFSETS = (-12 * 60, 14 * 60)
#: Names of places; the last names of the zone database are aliases and fixed offsets.
PLACES = ("Europe/", "America/", "Asia/", "Africa/", "Australia/", "Pacific/", "Atlantic/", "Indian/", "Antarctica/")


def _offset(zone: ZoneInfo, at: datetime) -> int:
    return int(at.replace(tzinfo=zone).utcoffset().total_seconds() // 60)


def histories(days: list[date], first: tuple[str, ...] = ()) -> tuple[list[str], list[tuple[date, list[int | None]]], dict[str, int]]:
    """All offset histories of the zone database that differ on some of ``days``.

    Returns a name for each, that of ``first`` if it has one; for each day the histories' offsets in minutes, None
    on a day on which the offset changes; and the number of every zone's history. The size is that of the
    calendar times the database, whatever the number of stamps.
    """
    names = ["UTC", *sorted((z for z in available_timezones() if z.startswith(PLACES)), key=lambda z: ([z.startswith(x) for x in PLACES].index(True), z))]
    names.sort(key=lambda z: z not in first)
    # histories that agree on the first and the middle of all months are one
    months = sorted({(day.year, day.month) for day in days})
    after = {(y + m // 12, m % 12 + 1) for y, m in months}
    probes = sorted({datetime(y, m, d) for y, m in after.union(months) for d in (1, 15)})
    begins = [datetime(day.year, day.month, day.day) for day in days]
    last = [bisect_right(probes, t) - 1 for t in begins]
    by_history: dict[tuple, int] = {}
    number, kept, offsets = {}, [], []
    for name in names:
        zone = ZoneInfo(name)
        key = tuple(_offset(zone, at) for at in probes)
        if key not in by_history:
            by_history[key] = len(kept)
            kept.append(name)
            history = []
            for t, i in zip(begins, last):
                a = b = key[i]
                if key[i + 1] != a:
                    # a change lies between the probes
                    a, b = _offset(zone, t), _offset(zone, t + timedelta(hours=23, minutes=59))
                history.append(a if a == b else None)
            offsets.append(history)
        number[name] = by_history[key]
    return kept, [(day, [h[i] for h in offsets]) for i, day in enumerate(days)], number


def evidence(stamps: DataFrame, source: str, arrived: str) -> DataFrame:
    """``source, day, stated, least, n``: what the stamps of a day say about their source's offset, counted.

    ``stated`` is an offset written in a stamp. ``least`` is the offset that a stamp without one needs at least
    so as not to lie after its own arrival, in quarters of an hour. ``Z``, ``UTC`` and bare numbers are neutral, as
    machines write them anywhere; an offset of ``+00:00`` in the column ``written`` is not. One pass and one
    pre-aggregated shuffle. Rows without a source or moment don't count.
    """
    usable = stamps.where(F.col(source).isNotNull() & F.col("wall").isNotNull())
    stated = F.when((F.col("offset_min") != 0) | F.col("written").rlike(r"[+-]00:?00\s*$"), F.col("offset_min"))
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    lead = F.timestamp_diff("MINUTE", epoch, F.col("wall")) - F.timestamp_diff("MINUTE", epoch, as_ntz(F.col(arrived))) - TOLERANCE_MINUTES
    least = F.when(F.col("offset_min").isNull() & (lead > OFFSETS[0]) & (lead <= OFFSETS[1]), (F.ceil(lead / 15) * 15).cast("int"))
    rows = usable.select(F.col(source).alias("source"), F.to_date("wall").alias("day"), stated.cast("int").alias("stated"), least.alias("least"))
    return rows.where("stated IS NOT NULL OR least IS NOT NULL").groupBy("source", "day", "stated", "least").agg(F.count(F.lit(1)).alias("n"))


def zone_violations(stamps: DataFrame, source: str, arrived: str, first: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, int]]:
    """``source, history, zone, violations`` for every offset history, and the number of every zone's history."""
    spark = stamps.sparkSession
    seen = checkpointed(evidence(stamps, source, arrived))
    # at most one row a day of the calendar
    days = sorted(r["day"] for r in seen.select("day").distinct().collect())
    names, offsets, number = histories(days, first)
    table = spark.createDataFrame(offsets, "day date, offsets array<int>")
    zones = spark.createDataFrame(list(enumerate(names)), "history int, zone string")
    t = seen.join(table, "day").select("source", "stated", "least", "n", F.posexplode("offsets").alias("history", "offset"))
    against = F.when(F.col("offset").isNull(), 0).when(F.col("stated").isNotNull(), (F.col("offset") != F.col("stated")).cast("int")).otherwise((F.col("offset") < F.col("least")).cast("int"))
    summed = t.groupBy("source", "history").agg(F.sum(F.col("n") * against).alias("violations"))
    return checkpointed(summed.join(zones, "history").select("source", "history", "zone", "violations")), number


def estimate_zones(stamps: DataFrame, source: str, arrived: str, declared: DataFrame | None = None) -> DataFrame:
    """``source, zone, violations, estimated, least_violations``: the offset history with the fewest violations.

    Where ``declared`` (``source, declared``) names a zone, that breaks ties: it stands unless another history has
    significantly fewer violations. ``estimated`` is the history that is best without it. A source whose stamps
    say nothing has its declared zone; without one it gives no row.
    """
    spark = stamps.sparkSession
    known = [] if declared is None else sorted(r[0] for r in declared.where("declared IS NOT NULL").select("declared").distinct().collect())
    first = tuple(z for z in known if z in available_timezones())
    scored, number = zone_violations(stamps, source, arrived, first)
    best = scored.groupBy("source").agg(F.min(F.struct("violations", "history", "zone")).alias("b")).select("source", F.col("b.zone").alias("estimated"), F.col("b.violations").alias("least_violations"))
    if not first:
        return best.select("source", F.col("estimated").alias("zone"), F.col("least_violations").alias("violations"), "estimated", "least_violations")
    numbers = spark.createDataFrame([(z, number[z] if z in number else -1) for z in first], "declared string, history int")
    own = declared.join(numbers, "declared").select("source", "declared", "history")
    theirs = own.join(scored.select("source", "history", "violations"), ["source", "history"], "left").select("source", "declared", "violations")
    t = best.join(theirs, "source", "full_outer")
    beaten = F.col("least_violations") < F.col("violations") - SIGMAS * F.sqrt("violations") - SIGMAS
    stands = F.col("declared").isNotNull() & ~F.coalesce(beaten, F.lit(False))
    return t.select("source", F.when(stands, F.col("declared")).otherwise(F.col("estimated")).alias("zone"), F.when(stands, F.col("violations")).otherwise(F.col("least_violations")).alias("violations"), "estimated", "least_violations")


def normalise(stamps: DataFrame, zones: DataFrame, source: str) -> DataFrame:
    """Add ``utc`` (NTZ) and ``utc_text``; ``zones`` holds one ``source, zone`` row per source.

    A stamp with an offset of its own keeps it. A source without any zone is read as UTC.
    """
    z = zones.select(F.col("source").alias("__source"), F.col("zone").alias("__zone"))
    joined = stamps.join(z, F.col(source) == F.col("__source"), "left")
    utc = to_utc(F.col("wall"), F.col("offset_min"), F.coalesce("__zone", F.lit("UTC")))
    inlined = joined.select(*stamps.columns, F.inline(F.array(F.struct(utc.alias("utc")))))
    return inlined.withColumn("utc_text", utc_text(F.col("utc")))


def localise(stamps: DataFrame, zones: DataFrame, source: str) -> DataFrame:
    """Add ``local`` (NTZ), the wall clock at the source's place: as written without an offset, else brought into its zone."""
    z = zones.select(F.col("source").alias("__source"), F.col("zone").alias("__zone"))
    joined = stamps.join(z, F.col(source) == F.col("__source"), "left")
    own = F.convert_timezone(F.lit("UTC"), F.coalesce("__zone", F.lit("UTC")), shift_minutes(F.col("wall"), -F.col("offset_min")))
    return joined.withColumn("local", F.when(F.col("offset_min").isNull(), F.col("wall")).otherwise(own)).drop("__source", "__zone")


def project_stamps(sitemap: DataFrame, event_items: DataFrame) -> DataFrame:
    """Both tables' written moments in one shape: src_table, row_id, site_id, written, arrived, wall, offset_min."""
    parts = [
        sitemap.select(F.lit("sitemap").alias("src_table"), F.col("sitemap_id").alias("row_id"), "site_id", F.col("lastmod").alias("written"), F.col("ingested_at").alias("arrived")),
        event_items.select(F.lit("event_items").alias("src_table"), F.col("event_id").alias("row_id"), "site_id", F.col("event_date").alias("written"), F.col("crawled_at").alias("arrived")),
    ]
    return parse_moment(spread(reduce(DataFrame.unionByName, parts)), "written")


def site_zones(stamps: DataFrame, site_config: DataFrame) -> DataFrame:
    """``source, zone, violations, estimated, least_violations`` of each site, estimated from its stamps; its declared zone breaks ties."""
    declared = site_config.where("time_zone IS NOT NULL").groupBy(F.col("site_id").alias("source")).agg(F.min("time_zone").alias("declared"))
    return estimate_zones(stamps, "site_id", "arrived", declared)


def moments_in_utc(sitemap: DataFrame, event_items: DataFrame, site_config: DataFrame) -> DataFrame:
    """``src_table, row_id, utc_text`` of each value that denotes a moment and isn't in that form already.

    NULL, blank, wordy and impossible values give no row; repeated rows give one row per id; a row without
    a site is read as UTC. Extra columns are ignored.
    """
    stamps = project_stamps(sitemap, event_items)
    zones = site_zones(stamps, site_config)
    utc = normalise(stamps, zones, "site_id")
    return utc.where(F.col("utc_text").isNotNull() & ~is_canonical(F.col("written"))).select("src_table", "row_id", "utc_text").distinct()
