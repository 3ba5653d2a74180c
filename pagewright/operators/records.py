"""Typed records out of texts: contacts, names, times, page numbers, headings carried down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
# Titles before and after names.
TITLES_BEFORE = r"^(?:(?:Ing|Mgr|Bc|MUDr|JUDr|PhDr|RNDr|MVDr|PaedDr|ThDr|doc|prof|Dr|DiS)\.?\s+)+"
TITLES_AFTER = r"(?:,\s*(?:Ph\.?D|CSc|DrSc|MBA|DiS|LL\.?M|MPA)\.?)+$"


def phone_number(text: Column) -> Column:
    """Digits of a phone number as BIGINT, the country's prefix dropped; NULL where no nine digits are left."""
    digits = F.regexp_replace(F.regexp_replace(text, r"[^0-9+]", ""), r"^(?:\+|00)42[01]", "")
    return F.when(digits.rlike(r"^\d{9}$"), digits.try_cast("bigint"))


def name_parts(name: Column) -> Column:
    """Struct ``title, first_name, last_name``: titles on both sides apart, the last word as surname."""
    text = F.trim(F.regexp_replace(name, r"\s+", " "))
    before = F.regexp_extract(text, TITLES_BEFORE, 0)
    after = F.regexp_extract(text, TITLES_AFTER, 0)
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, TITLES_BEFORE, ""), TITLES_AFTER, ""))
    last = F.regexp_extract(bare, r"(\S+)$", 1)
    title = F.trim(F.concat(F.trim(before), F.lit(" "), F.regexp_replace(after, r"^,\s*", "")))
    return F.struct(title.alias("title"), F.trim(F.regexp_replace(bare, r"\S+$", "")).alias("first_name"), last.alias("last_name"))


PHONE_FIELD = r"^(?:(?i:tel|telefon|phone|mobil|fax)[a-z/. ]*:?\s*)?[+(]?[0-9][0-9 ()/.\-\u00a0]{7,}$"


def contact_rows(documents: DataFrame) -> DataFrame:
    """``doc_id, line_no, name, role, department, email, phone``: lines that list people between ``|`` or ``;``.

    A line has any number of fields, two at least, among them an address or a phone number. Those with
    letters that are neither are the name, the role and the department in this order. Rows without address and name are left out.
    """
    lines = documents.where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    listed = lines.where(F.col("line").rlike(r"[|;]") & F.col("line").rlike(r"\d{3}|@"))
    fields = F.filter(F.transform(F.split(F.regexp_replace("line", r"^[\s\-*•|]+|[\s|]+$", ""), r"\s*[|;]\s*"), lambda x: F.trim(x)), lambda x: x != "")
    is_mail, is_phone = (lambda x: x.rlike(f"^{MAIL}$")), (lambda x: x.rlike(PHONE_FIELD) & F.regexp_replace(x, r"[^0-9]", "").rlike(r"^\d{9,14}$"))
    t = listed.select("doc_id", (F.col("pos") + 1).alias("line_no"), F.inline(F.array(F.struct(fields.alias("f")))))
    first = lambda p: F.get(F.filter("f", p), F.lit(0))
    t = t.where(F.size("f") > 1).select("doc_id", "line_no", F.filter("f", lambda x: ~is_mail(x) & ~is_phone(x) & x.rlike(r"\p{L}")).alias("w"), first(is_mail).alias("email"), first(is_phone).alias("p"))
    word = lambda i: F.get("w", F.lit(i))
    rows = t.select("doc_id", "line_no", word(0).alias("name"), word(1).alias("role"), word(2).alias("department"), "email", phone_number(F.regexp_replace("p", r"^[^0-9+(]*", "")).alias("phone"))
    return rows.where("(email IS NOT NULL OR phone IS NOT NULL) AND (email IS NOT NULL OR name IS NOT NULL)")


def best_contacts(rows: DataFrame) -> DataFrame:
    """One row per address: that with the most filled fields, the later one of equals.

    Rows without an address are one per name, in any letter case, and phone number: the last. The fields that count are
    first name, last name, role, department and phone. Folded in each task before the shuffle.
    """
    parts = name_parts(F.coalesce("name", F.lit("")))
    t = rows.select("*", F.inline(F.array(F.struct(parts["first_name"].alias("__first"), parts["last_name"].alias("__last")))))
    there = lambda c: F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "", 1).otherwise(0)
    filled = there("__first") + there("__last") + there("role") + there("department") + there("phone")
    order = F.struct(F.when(F.col("email").isNull(), 0).otherwise(filled), "doc_id", "line_no")
    without = F.when(F.col("email").isNull(), F.struct(F.lower("name").alias("name"), F.col("phone").alias("phone")))
    row = F.struct("doc_id", "line_no", "name", "role", "department", "phone")
    return t.groupBy(F.lower("email").alias("email"), without.alias("__other")).agg(F.max_by(row, order).alias("r")).select("email", "r.*")


def minutes_of(time: Column) -> Column:
    """Minutes from midnight of ``14:30``, ``14.30``, ``od 18 h`` and the like; NULL for others."""
    hour = F.regexp_extract(time, r"(\d{1,2})", 1).try_cast("int")
    minute = F.coalesce(F.nullif(F.regexp_extract(time, r"\d{1,2}[:.](\d{2})", 1), F.lit("")).try_cast("int"), F.lit(0))
    return F.when((hour < 24) & (minute < 60), hour * 60 + minute)


def under_headings(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key, line_no, heading, item``: list lines with the last heading above them in their document."""
    lines = documents.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    heading = F.when(F.col("line").rlike(r"^#{1,6}\s+\S"), F.trim(F.regexp_replace("line", r"^#{1,6}\s+", "")))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = lines.withColumn("heading", F.last(heading, ignorenulls=True).over(w))
    item = F.col("line").rlike(r"^\s*[-*•]\s+\S")
    return t.where(item & F.col("heading").isNotNull()).select(key, (F.col("pos") + 1).alias("line_no"), "heading", F.trim(F.regexp_replace("line", r"^\s*[-*•]\s+", "")).alias("item"))


def capped(rows: DataFrame, key: str, most: int) -> DataFrame:
    """``key, n_kept, n_over``: how many rows a cap of ``most`` a key keeps and how many it counts as over it."""
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return n.select(key, F.least("n", F.lit(most)).alias("n_kept"), F.greatest(F.col("n") - most, F.lit(0)).alias("n_over"))


def without_language_walls(text: Column, names: tuple[str, ...], least: int = 2) -> Column:
    """``text`` without lines that hold nothing but names of languages, ``least`` of them at least."""
    one = "|".join(names)
    wall = rf"^\s*(?:(?:{one})[\s|,/·]*){{{least},}}$"
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(wall)), "\n")


def summary_verdict(text: Column, least: int = 15) -> Column:
    """``short``, ``cut`` or ``valid``: quotes apart, long enough and ended as a sentence."""
    bare = F.trim(F.regexp_replace(F.trim(text), r'^["„“]+|["“”]+$', ""))
    return F.when(F.length(F.coalesce(bare, F.lit(""))) < least, "short").when(~bare.rlike(r"[.!?…)]$"), "cut").otherwise("valid")
