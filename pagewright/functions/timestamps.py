"""Free-form timestamps as Spark expressions: no Python worker takes part.

``parse_moment`` recognises a written moment and returns its wall-clock fields as TIMESTAMP_NTZ together
with the offset in minutes where the text names one. All results are NTZ, so the session time zone has
no influence.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names (first letters) in English, Czech, Slovak, German and Polish.
MONTHS = {
    1: "jan|led|sty",
    2: "feb|úno|uno|lut",
    3: "mar|bře|bre|mär|mrz",
    4: "apr|dub|kwi",
    5: "may|kvě|kve|máj|maj|mai",
    6: "jun|červn|cervn|červen$|cerven$|jún|cze",
    7: "jul|červenc|cervenc|júl|lip",
    8: "aug|srp|sie",
    9: "sep|zář|zar|wrz",
    10: "oct|říj|rij|okt|paź|paz",
    11: "nov|lis",
    12: "dec|pro|dez|gru",
}
# Zone abbreviations and their offsets in minutes.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "BST": 60, "WEST": 60, "CET": 60, "MEZ": 60, "SEČ": 60,
    "CEST": 120, "MESZ": 120, "SELČ": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}

ZONE = r"(Z|[A-ZČ]{2,4}|(?:UTC|GMT)? ?[+-]\d{1,2}:?(?:\d{2})?)?"
CLOCK = r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,]\d+)?)?"
WORD = r"(\p{L}{3,12})"
BETWEEN = r" ?[-–—] ?"

#: Shape, then the groups holding year, month, day, hour, minute, second, zone, half of day (0: none).
SHAPES = {
    "iso": (rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})(?:(?:T|,? ){CLOCK} ?{ZONE})?$", (1, 3, 4, 5, 6, 7, 8, 0)),
    "compact": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[T ](\d{{2}}):?(\d{{2}})(?::?(\d{{2}})(?:[.,]\d+)?)?{ZONE})?$", (1, 2, 3, 4, 5, 6, 7, 0)),
    "mail": (rf"^(?:\p{{L}}{{2,10}}\.?,? )?(\d{{1,2}})[ -]{WORD}\.?[ -](\d{{4}}|\d{{2}})(?: {CLOCK} ?{ZONE})?$", (3, 2, 1, 4, 5, 6, 7, 0)),
    "us": (rf"^{WORD}\.? (\d{{1,2}}),? (\d{{4}})(?:,? (?:at )?{CLOCK} ?([AaPp])?(?:\.?[Mm]\.?)? ?{ZONE})?$", (3, 1, 2, 4, 5, 6, 8, 7)),
    "numeric": (rf"^(\d{{1,2}})([./-]) ?(\d{{1,2}})\2 ?(\d{{4}}|\d{{2}})(?:,? (?:ve? |o |od |um )?{CLOCK}(?: ?(?:hod|h|Uhr)\.?)? ?{ZONE})?$", (4, 3, 1, 5, 6, 7, 8, 0)),
    "named": (rf"^(\d{{1,2}})\.? ?{WORD} (\d{{4}})(?:,? (?:ve? |o |od |um )?{CLOCK}(?: ?(?:hod|h|Uhr)\.?)? ?{ZONE})?$", (3, 2, 1, 4, 5, 6, 7, 0)),
    "days": (rf"^(\d{{1,2}})\.?{BETWEEN}\d{{1,2}}\. ?(\d{{1,2}})\. ?(\d{{4}}|\d{{2}})$", (3, 2, 1, 0, 0, 0, 0, 0)),
    "days_months": (rf"^(\d{{1,2}})\. ?(\d{{1,2}})\.{BETWEEN}\d{{1,2}}\. ?\d{{1,2}}\. ?(\d{{4}}|\d{{2}})$", (3, 2, 1, 0, 0, 0, 0, 0)),
    "days_years": (rf"^(\d{{1,2}})\. ?(\d{{1,2}})\. ?(\d{{4}}|\d{{2}}){BETWEEN}\d{{1,2}}\. ?\d{{1,2}}\. ?(?:\d{{4}}|\d{{2}})$", (3, 2, 1, 0, 0, 0, 0, 0)),
    "days_named": (rf"^(\d{{1,2}})\.?{BETWEEN}\d{{1,2}}\.? ?{WORD} (\d{{4}})$", (3, 2, 1, 0, 0, 0, 0, 0)),
    "days_two_named": (rf"^(\d{{1,2}})\.? ?{WORD}{BETWEEN}\d{{1,2}}\.? ?\p{{L}}{{3,12}} (\d{{4}})$", (3, 2, 1, 0, 0, 0, 0, 0)),
    "iso_days": (r"^(\d{4})-(\d{1,2})-(\d{1,2})(?: ?[–—/] ?| - )\d{4}-\d{1,2}-\d{1,2}$", (1, 2, 3, 0, 0, 0, 0, 0)),
}
WEEKDAY = r"^(?:pondělí|úterý|středa|čtvrtek|pátek|sobota|neděle|po|út|st|čt|pá|so|ne|v|ve|dne)\.?,? (?=\d)"
LOWER_SIGNS = r"^\d{4}-?\d{2}-?\d{2}t\d|\d ?(?:z|utc|gmt|cet|cest)$"
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
#: A number of so many digits or more counts milliseconds.
MILLISECOND_DIGITS = 12
EPOCH = r"^\d{10,}(?:[.,]\d+)?$"


def _fields(text: Column) -> Column:
    """``year|month|day|hour|minute|second|zone|half`` of whichever shape fits, NULL where none does."""
    cases = F
    for pattern, groups in SHAPES.values():
        cases = cases.when(text.rlike(pattern), F.regexp_replace(text, pattern, "|".join(f"${g}" if g else "" for g in groups)))
    return cases.when(text.rlike(EPOCH), F.concat(text, F.lit("|||||||")))


def _month(name: Column) -> Column:
    low = F.lower(name)
    by_name = reduce(lambda c, kv: c.when(low.rlike(rf"^(?:{kv[1]})"), F.lit(kv[0])), list(MONTHS.items())[1:], F.when(low.rlike(rf"^(?:{MONTHS[1]})"), F.lit(1)))
    return F.when(name.rlike(r"^\d+$"), name.try_cast("int")).otherwise(by_name)


def _offset(zone: Column) -> Column:
    sign = F.when(F.contains(zone, F.lit("-")), -1).otherwise(1)
    digits = F.regexp_replace(zone, r"[^0-9]", "")
    hours = F.when(F.length(digits) <= 2, digits).otherwise(F.substring(F.lpad(digits, 4, "0"), 1, 2)).try_cast("int")
    minutes = F.when(F.length(digits) <= 2, F.lit(0)).otherwise(F.right(digits, F.lit(2)).try_cast("int"))
    table = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    return F.when(zone.rlike(r"\d"), sign * (hours * 60 + minutes)).otherwise(F.try_element_at(table, zone))


def parse_moment(df: DataFrame, value: str, wall: str = "wall", offset: str = "offset_min") -> DataFrame:
    """Add ``wall`` (TIMESTAMP_NTZ) and ``offset`` (INT minutes) of the moment written in column ``value``.

    ``wall`` is NULL for text that denotes no moment: NULL, blanks, words, impossible dates, unknown zone
    names. ``offset`` is NULL where the text names no zone; bare numbers count from 1970 with offset 0.
    Dates alone mean midnight, ranges their first day; two-digit years are 20YY; days come before months
    unless the year comes first; fractions of seconds are dropped. Other columns stay as they are.
    """
    # each step is a projection of its own, so that no regular expression runs twice
    text = F.trim(F.regexp_replace(F.col(value), r"[\s\u00a0\u200b\ufeff]+", " "))
    t = df.withColumn("__t", F.regexp_replace(text, "(?iu)" + WEEKDAY, ""))
    # signs of ISO forms and zones in lower case
    t = t.withColumn("__t", F.when(F.col("__t").rlike(LOWER_SIGNS), F.upper("__t")).otherwise(F.col("__t")))
    t = t.withColumn("__f", F.split(_fields(F.col("__t")), r"\|", -1)).drop("__t")
    part = lambda i: F.nullif(F.get("__f", F.lit(i)), F.lit(""))
    names = ("__y", "__mo", "__d", "__h", "__mi", "__s", "__z", "__half")
    # inline() holds filters on the result back: pushed further down, they'd repeat the expressions above
    t = t.select("*", F.inline(F.array(F.struct(*[part(i).alias(n) for i, n in enumerate(names)])))).drop("__f")
    year, hour, half, zone = F.col("__y"), F.coalesce(F.col("__h").try_cast("int"), F.lit(0)), F.upper("__half"), F.col("__z")
    t = t.withColumns({
        "__o": _offset(zone),
        "__mo": _month(F.col("__mo")),
        "__h": F.when(half.isNotNull() & ((hour > 12) | (hour == 0)), F.lit(None)).when((half == "P") & (hour < 12), hour + 12).when((half == "A") & (hour == 12), 0).otherwise(hour),
        "__n": F.when(year.rlike(EPOCH), F.regexp_extract(year, r"^\d+", 0)),
    })
    t = t.withColumn("__y", F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).when(F.col("__n").isNull(), year).try_cast("int"))
    second = F.least(F.coalesce(F.col("__s").try_cast("int"), F.lit(0)), F.lit(59)).cast("decimal(16,6)")
    local = F.call_function("try_make_timestamp_ntz", F.col("__y"), F.col("__mo"), F.col("__d").try_cast("int"), F.col("__h"), F.coalesce(F.col("__mi").try_cast("int"), F.lit(0)), second)
    known = zone.isNull() | F.coalesce(F.abs("__o") <= 18 * 60, F.lit(False))
    number = F.col("__n").try_cast("decimal(20,0)")
    since = F.when(F.length("__n") >= MILLISECOND_DIGITS, F.floor(number / 1000)).otherwise(number).cast("bigint")
    # beyond the year 9999 a number denotes nothing
    days = F.when(since < 253_402_300_800, since)
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.call_function("make_dt_interval", F.lit(0), F.lit(0), F.lit(0), days.cast("decimal(18,6)"))
    bare = F.col("__n").isNotNull()
    found = F.struct(F.when(bare, epoch).when(known, local).alias(wall), F.when(bare, F.lit(0)).otherwise(F.col("__o")).alias(offset))
    return t.select(*df.columns, F.inline(F.array(found)))


def shift_minutes(wall: Column, minutes: Column) -> Column:
    return wall + F.call_function("make_dt_interval", F.lit(0), F.lit(0), minutes)


def to_utc(wall: Column, offset_min: Column, zone: Column) -> Column:
    """UTC wall clock (NTZ) of a local one: by its own offset, else by ``zone``.

    A local time that a clock change makes double or missing takes the offset in force before the change.
    """
    own = shift_minutes(wall, -offset_min)
    return F.when(offset_min.isNotNull(), own).otherwise(F.convert_timezone(zone, F.lit("UTC"), wall))


def utc_text(utc: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of a UTC wall clock."""
    s = utc.cast("string")
    return F.when(utc.isNotNull(), F.concat(F.left(s, F.lit(10)), F.lit("T"), F.substring(s, 12, 8), F.lit("Z")))


def as_ntz(instant: Column) -> Column:
    """UTC wall clock of a TIMESTAMP, whatever the session's zone, to the second."""
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.call_function("make_dt_interval", F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(instant).cast("decimal(18,6)"))


def is_canonical(value: Column) -> Column:
    return F.coalesce(value.rlike(CANONICAL + r"(?!\n)"), F.lit(False)) & (F.length(value) == 20)
