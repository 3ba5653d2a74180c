"""XML sitemaps and feeds: built from rows and read back as rows, by Spark's own XML functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import frontier

#: Rows of one sitemap file; the protocol allows 50,000.
FILE_URLS = 1000
#: Characters that an event's description keeps in a feed row.
DESCRIPTION_CHARS = 500

SITEMAP = "url ARRAY<STRUCT<loc: STRING, lastmod: STRING>>"
RSS = "channel STRUCT<title: STRING, item: ARRAY<STRUCT<title: STRING, link: STRING, guid: STRING, pubDate: STRING, date: STRING, description: STRING>>>"


def escaped(text: Column) -> Column:
    """Text as XML content; characters that XML has no form for are left out."""
    t = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        t = F.replace(t, F.lit(char), F.lit(entity))
    return t


def element(name: str, text: Column) -> Column:
    """``<name>text</name>``, nothing for NULL and the empty text."""
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(F.concat(F.lit(f"<{name}>"), escaped(text), F.lit(f"</{name}>")))


def sitemap_files(rows: DataFrame, site: str, order: str, url: str, lastmod: str, file_urls: int = FILE_URLS) -> DataFrame:
    """``site, file_no, xml``: sitemap files of at most ``file_urls`` positions each, so that no file grows with a site."""
    entry = F.concat(F.lit("<url>"), element("loc", F.col(url)), element("lastmod", F.col(lastmod)), F.lit("</url>"))
    numbered = rows.where(F.col(url).isNotNull()).select(F.col(site).alias("site"), F.floor(F.col(order) / file_urls).alias("file_no"), F.struct(F.col(order).alias("o"), entry.alias("e")).alias("entry"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda x: x["e"]), "")
    return numbered.groupBy("site", "file_no").agg(F.concat(F.lit("<urlset>"), body, F.lit("</urlset>")).alias("xml"))


def sitemap_rows(files: DataFrame) -> DataFrame:
    """``site, file_no, pos, loc, lastmod``: each entry by itself, so a missing lastmod can't be paired with the next one's."""
    parsed = files.select("site", "file_no", F.from_xml("xml", SITEMAP).alias("x"))
    return parsed.select("site", "file_no", F.posexplode("x.url").alias("pos", "u")).select("site", "file_no", "pos", "u.loc", "u.lastmod")


def last_of_url(rows: DataFrame) -> DataFrame:
    """``site, loc, lastmod``: of a URL listed twice the later entry wins, as a map's later write does."""
    return rows.groupBy("site", "loc").agg(F.max_by("lastmod", F.struct("file_no", "pos")).alias("lastmod"))


def rss_files(rows: DataFrame, site: str, key: str, title: Column, link: Column, date: Column, description: Column, file_items: int = FILE_URLS) -> DataFrame:
    """``site, file_no, xml``: RSS 2.0 feeds of at most ``file_items`` keys each."""
    item = F.concat(F.lit("<item>"), element("title", title), element("link", link), element("pubDate", date), element("description", description), F.lit("</item>"))
    numbered = rows.select(F.col(site).alias("site"), F.floor(F.col(key) / file_items).alias("file_no"), F.struct(F.col(key).alias("o"), item.alias("e")).alias("item"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda x: x["e"]), "")
    return numbered.groupBy("site", "file_no").agg(F.concat(F.lit("<rss><channel><title>feed</title>"), body, F.lit("</channel></rss>")).alias("xml"))


def rss_rows(files: DataFrame) -> DataFrame:
    """``site, file_no, pos, title, link, published, description``: link from guid, date from the second field, where the first is missing."""
    parsed = files.select("site", "file_no", F.from_xml("xml", RSS).alias("x"))
    i = parsed.select("site", "file_no", F.posexplode("x.channel.item").alias("pos", "i"))
    guid = F.when(F.col("i.guid").rlike("^https?://"), F.col("i.guid"))
    text = F.col("i.description")
    short = F.when(F.length(text) > DESCRIPTION_CHARS, F.concat(F.left(text, F.lit(DESCRIPTION_CHARS)), F.lit("..."))).otherwise(text)
    return i.select("site", "file_no", "pos", "i.title", F.coalesce("i.link", guid).alias("link"), F.coalesce("i.pubDate", "i.date").alias("published"), short.alias("description"))


# Schemas of feeds by other writers, namespaces of elements left out.
ATOM = "entry ARRAY<STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, published: STRING, updated: STRING, date: STRING, created: STRING, modified: STRING, summary: STRING>>"
RSS_ITEM = "ARRAY<STRUCT<title: STRING, link: STRUCT<_VALUE: STRING, _href: STRING>, guid: STRUCT<_VALUE: STRING, _isPermaLink: STRING>, id: STRING, pubDate: STRING, date: STRING, created: STRING, modified: STRING, published: STRING, createdDate: STRING, description: STRING>>"
RSS_ANY = f"channel STRUCT<item: {RSS_ITEM}>, item {RSS_ITEM}"
EVENTS = (
    "event ARRAY<STRUCT<id: STRING, details: STRUCT<url: STRING>, name: STRING, description: STRING, dates: STRUCT<date: ARRAY<STRUCT<start_date: STRING, start_time: STRING>>>, "
    "organizer: STRUCT<name: STRING>, place: STRUCT<other: STRING>, types: STRUCT<type: ARRAY<STRING>>>>"
)
SITEMAP_INDEX = "sitemap ARRAY<STRUCT<loc: STRING, lastmod: STRING>>"
_LOOSE = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}


def feed_kind(xml: Column) -> Column:
    """``atom``, ``rss``, ``events``, ``response`` or ``generic``, by the elements that a feed has."""
    return (
        F.when(xml.rlike(r"<feed\b[^>]*http://www\.w3\.org/2005/Atom"), "atom")
        .when(xml.rlike(r"<(?:rss|channel)\b"), "rss")
        .when(xml.rlike(r"<events\b") & xml.rlike(r"<event\b"), "events")
        .when(xml.rlike(r"<response\b") & xml.rlike(r"<item\b"), "response")
        .otherwise("generic")
    )


def without_scripts(xml: Column) -> Column:
    """What browsers put into a feed is no part of it."""
    return F.regexp_replace(xml, r"(?is)<script\b[^>]*/>|<script\b.*?</script\s*>", "")


def _text(value: Column) -> Column:
    """Text without blanks around it, NULL for none."""
    return F.nullif(F.trim(F.regexp_replace(value, r"^\s+|\s+$", "")), F.lit(""))


def _moment(value: Column) -> Column:
    """The moment of a ``<time datetime="...">`` within a date, else the date itself."""
    inner = F.regexp_extract(value, r"<time\s+datetime=[\"']([^\"']+)", 1)
    return F.when(inner != "", inner).otherwise(_text(value))


def _atom(files: DataFrame) -> DataFrame:
    e = files.select("feed", "base", "kind", F.posexplode(F.from_xml("xml", ATOM, _LOOSE)["entry"]).alias("pos", "e"))
    link = F.coalesce(F.get(F.filter("e.link", lambda x: x["_rel"] == "alternate"), F.lit(0)), F.get("e.link", F.lit(0)))["_href"]
    published = F.coalesce(*[_text(F.col(f"e.{c}")) for c in ("published", "updated", "date", "created", "modified")])
    return e.select("feed", "base", "kind", "pos", _text(link).alias("link"), F.coalesce(_text(F.col("e.title")), F.lit("No title")).alias("title"), published.alias("published"), _text(F.col("e.summary")).alias("description"))


def _rss(files: DataFrame) -> DataFrame:
    x = files.select("feed", "base", "kind", F.from_xml("xml", RSS_ANY, _LOOSE).alias("x"))
    items = F.concat(F.coalesce("x.channel.item", F.array()), F.coalesce("x.item", F.array()))
    i = x.select("feed", "base", "kind", F.posexplode(items).alias("pos", "i"))
    http = lambda c: F.when(_text(c).startswith("http"), _text(c))
    link = F.coalesce(_text(F.col("i.link._VALUE")), _text(F.col("i.link._href")), http(F.col("i.guid._VALUE")), http(F.col("i.id")))
    published = F.coalesce(*[_moment(F.col(f"i.{c}")) for c in ("pubDate", "date", "created", "modified", "published", "createdDate")])
    return i.select("feed", "base", "kind", "pos", link.alias("link"), F.coalesce(_text(F.col("i.title")), F.lit("No title")).alias("title"), published.alias("published"), _text(F.col("i.description")).alias("description"))


def _events(files: DataFrame) -> DataFrame:
    e = files.select("feed", "base", "kind", F.posexplode(F.from_xml("xml", EVENTS, _LOOSE)["event"]).alias("pos", "e"))
    field = lambda c: _text(F.col(f"e.{c}"))
    first = F.get("e.dates.date", F.lit(0))
    day, time = _text(first["start_date"]), _text(first["start_time"])
    name = F.coalesce(field("name"), F.concat(F.lit("Event "), F.coalesce(field("id"), F.lit("Unknown"))))
    title = F.when(day.isNull(), name).otherwise(F.concat(name, F.lit(" ("), F.concat_ws(" ", day, time), F.lit(")")))
    text = F.when(F.length(field("description")) > DESCRIPTION_CHARS, F.concat(F.left(field("description"), F.lit(DESCRIPTION_CHARS)), F.lit("..."))).otherwise(field("description"))
    kind = _text(F.get("e.types.type", F.lit(0)))
    parts = [F.concat(F.lit(label), c) for label, c in (("Popis: ", text), ("Organizator: ", field("organizer.name")), ("Misto: ", field("place.other")), ("Typ: ", kind))]
    numbers = F.split(day, r"\.")
    iso = F.concat(_text(F.get(numbers, F.lit(2))), F.lit("-"), F.lpad(_text(F.get(numbers, F.lit(1))), 2, "0"), F.lit("-"), F.lpad(_text(F.get(numbers, F.lit(0))), 2, "0"), F.lit("T"), F.when(time.contains(":"), time).otherwise("00:00"), F.lit(":00"))
    published = F.when(F.size(numbers) == 3, iso).otherwise(day)
    return e.select("feed", "base", "kind", "pos", field("details.url").alias("link"), title.alias("title"), published.alias("published"), _text(F.concat_ws(" | ", *parts)).alias("description"))


def _response(files: DataFrame) -> DataFrame:
    """Items read from the raw text, as their links may stand in or after a void element."""
    items = files.select("feed", "base", "kind", F.posexplode(F.regexp_extract_all("xml", F.lit(r"(?s)<item\b.*?</item\s*>"), F.lit(0))).alias("pos", "i"))
    plain = lambda c: _text(F.regexp_replace(c, r"<!\[CDATA\[|\]\]>", ""))
    inner = lambda n: plain(F.regexp_extract("i", rf"(?s)<{n}\b[^>]*>(.*?)</{n}\s*>", 1))
    link = F.regexp_extract("i", r"(?s)<link\b[^>]*>\s*(?:<!\[CDATA\[)?\s*(http[^<\]\s]+)", 1)
    return items.select("feed", "base", "kind", "pos", _text(link).alias("link"), F.coalesce(inner("title"), F.lit("No title")).alias("title"), _moment(inner("published")).alias("published"), inner("description").alias("description"))


def _generic(files: DataFrame) -> DataFrame:
    """Whatever looks like a link of the site, each once."""
    hrefs = F.regexp_extract_all("xml", F.lit(r"href=[\"']([^\"']+)[\"']"), F.lit(1))
    written = F.regexp_extract_all("xml", F.lit(r"https?://[^\s<>\"']+"), F.lit(0))
    rows = files.select("feed", "base", "kind", F.posexplode(F.array_distinct(F.concat(hrefs, written))).alias("pos", "link"))
    none = F.lit(None).cast("string")
    return rows.select("feed", "base", "kind", "pos", "link", F.lit("No title").alias("title"), none.alias("published"), none.alias("description"))


def feed_rows(files: DataFrame) -> DataFrame:
    """``feed, kind, pos, url, title, published, description`` of feeds in any of five forms.

    ``files`` has ``feed``, ``base`` (the site's URL) and ``xml``. Links are made absolute and lose their fragments;
    items without a link are left out, as are a generic feed's links to other places. Broken and NULL texts
    give no rows.
    """
    known = files.where("xml IS NOT NULL").select("feed", "base", without_scripts(F.col("xml")).alias("xml")).withColumn("kind", feed_kind(F.col("xml")))
    readers = {"atom": _atom, "rss": _rss, "events": _events, "response": _response, "generic": _generic}
    rows = reduce(DataFrame.unionByName, [read(known.where(F.col("kind") == kind)) for kind, read in readers.items()])
    url = urls.without_fragment(urls.resolved(F.col("base"), F.col("link")))
    out = rows.where("link IS NOT NULL").select("feed", "kind", "pos", url.alias("url"), "title", "published", "description", "base")
    return out.where((F.col("kind") != "generic") | F.startswith("url", "base")).drop("base")


def sitemap_children(files: DataFrame) -> DataFrame:
    """``parent, loc``: the files that an index lists; other sitemaps list none."""
    return files.select(F.col("url").alias("parent"), F.explode(F.from_xml("xml", SITEMAP_INDEX, _LOOSE)["sitemap"]).alias("s")).select("parent", _text(F.col("s.loc")).alias("loc")).where("loc IS NOT NULL").distinct()


def sitemap_tree(files: DataFrame, roots: DataFrame, max_depth: int = 5) -> DataFrame:
    """``url, loc, lastmod``: entries of all sitemaps that the roots reach through indexes, the last of each URL.

    ``files`` has ``url`` and ``xml``, ``roots`` has ``url``. Indexes are followed level by level, each file once.
    """
    edges = sitemap_children(files).select(F.col("parent").alias("src"), F.col("loc").alias("dst"))
    reached = frontier.reachable(edges, roots.select(F.col("url").alias("node")), max_depth).select(F.col("node").alias("url"), "depth")
    entries = files.join(reached, "url").select("depth", "url", F.posexplode(F.from_xml("xml", SITEMAP, _LOOSE)["url"]).alias("pos", "u"))
    rows = entries.select("depth", "url", "pos", _text(F.col("u.loc")).alias("loc"), _text(F.col("u.lastmod")).alias("lastmod")).where("loc IS NOT NULL")
    return rows.groupBy("loc").agg(F.max_by(F.struct("url", "lastmod"), F.struct("depth", "url", "pos")).alias("r")).select("r.url", "loc", "r.lastmod")
