"""URL expressions. NULL gives NULL; text that is no URL passes through the same steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings of files, and of handlers that serve files by a query parameter.
FILE_ENDINGS = "pdf doc docx xls xlsx ppt pptx zip rar 7z tar gz tgz jpg jpeg png gif svg webp mp4 mp3 avi mov wmv csv xml json txt rtf ashx"
HANDLER_ENDINGS = "ashx aspx jsp php"
HANDLER_PARAMETERS = r"id_dokumenty|file|download"
# Names of the parameter that holds a page's number, in order of preference.
PAGE_PARAMETERS = ("stranka", "page", "p", "pg", "pagenum")


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def path_of(url: Column) -> Column:
    """Path from its slash on, without query and fragment; empty for a bare host."""
    return F.regexp_extract(without_fragment(url), r"^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)", 1)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def domain_key(url: Column) -> Column:
    return F.regexp_replace(host_of(url), r"^www\.", "")


def query_of(url: Column) -> Column:
    return F.regexp_extract(without_fragment(url), r"\?(.*)$", 1)


def _decoded(text: Column) -> Column:
    """Percent signs and plus read; a text with broken ones keeps them."""
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def _encoded(text: Column) -> Column:
    """Every sign but letters, digits, ``_.-~`` as percent signs, blanks as plus."""
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonical(url: Column) -> Column:
    """No fragment; query parameters decoded, sorted by name and then by their order of writing, encoded again; the slash at the end stays.

    So one parameter written in two encodings is the same, and repeated names stand together. Parameters without
    a value are dropped; a URL without a query is only freed of its fragment.
    """
    bare = without_fragment(url)
    parts = F.filter(F.split(query_of(url), "&"), lambda p: p.rlike("^[^=]+=."))
    keyed = F.transform(parts, lambda p, i: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("name"), i.alias("i"), _decoded(F.regexp_replace(p, "^[^=]*=", "")).alias("value")))
    ordered = F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat(_encoded(s["name"]), F.lit("="), _encoded(s["value"]))), "&")
    base = F.substring_index(bare, "?", 1)
    return F.when(~F.contains(bare, F.lit("?")), bare).otherwise(F.concat(base, F.when(ordered == "", "").otherwise(F.concat(F.lit("?"), ordered))))


def is_file(url: Column) -> Column:
    path = F.lower(path_of(url))
    by_ending = path.rlike(rf"\.(?:{FILE_ENDINGS.replace(' ', '|')})$")
    by_handler = path.rlike(rf"\.(?:{HANDLER_ENDINGS.replace(' ', '|')})$") & F.lower(query_of(url)).rlike(HANDLER_PARAMETERS)
    return by_ending | by_handler


def segments(url: Column) -> Column:
    return F.filter(F.split(path_of(url), "/"), lambda s: s != "")


def title_from_path(url: Column) -> Column:
    """The last path segment, or ``Homepage``."""
    parts = segments(url)
    return F.when(F.size(parts) == 0, F.lit("Homepage")).otherwise(F.element_at(parts, -1))


def breadcrumb(url: Column, root: str) -> Column:
    return F.array_join(F.concat(F.array(F.lit(root)), segments(url)), " > ")


def under_path(url: Column, prefix: Column) -> Column:
    """Whether the decoded path is ``prefix`` or lies below it, on whole segments."""
    path = F.rtrim(F.coalesce(F.try_url_decode(F.replace(path_of(url), F.lit("+"), F.lit("%2B"))), path_of(url)), F.lit("/"))
    p = F.rtrim(prefix, F.lit("/"))
    return (path == p) | F.startswith(path, F.concat(p, F.lit("/")))


def page_url(url: Column, n: Column) -> Column:
    """``url`` for page ``n``: the parameter that is there already, else the first name of the list."""
    query = query_of(url)
    names = F.array(*[F.when(F.concat(F.lit("&"), query).rlike(f"&{p}="), F.lit(p)) for p in PAGE_PARAMETERS])
    name = F.coalesce(F.get(F.array_compact(names), F.lit(0)), F.lit(PAGE_PARAMETERS[0]))
    others = F.filter(F.split(query, "&"), lambda p: (p != "") & (F.substring_index(p, "=", 1) != name))
    return F.concat(F.substring_index(without_fragment(url), "?", 1), F.lit("?"), F.array_join(F.concat(others, F.array(F.concat(name, F.lit("="), n.cast("string")))), "&"))


def resolved(base: Column, href: Column) -> Column:
    """``href`` seen from page ``base``: absolute, ``//host``, ``/path``, ``?query`` and relative forms."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][\w+.-]*):", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][\w+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.concat(root, F.coalesce(F.nullif(F.regexp_extract(path_of(base), r"^(.*/)", 1), F.lit("")), F.lit("/")))
    return (
        F.when(href.rlike(r"^[a-zA-Z][\w+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .when(F.startswith(href, F.lit("?")), F.concat(page, href))
        .when((href == "") | F.startswith(href, F.lit("#")), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(F.concat(folder, F.regexp_replace(href, r"^\./", "")))
    )


def chunk_postfix(n: Column) -> Column:
    """A to Z, then AA on, of a number from 0 to 701."""
    letter = lambda k: F.chr(F.lit(65) + k)
    return F.when(n < 26, letter(n % 26)).otherwise(F.concat(letter(F.floor(n / 26).cast("int") - 1), letter(n % 26)))


def safe_filename(name: Column, longest: int = 200) -> Column:
    """A file name: no accents, ``..`` and what file systems forbid as ``_``, blanks as ``_``, none at the ends."""
    from .text import unaccented

    t = F.replace(unaccented(name), F.lit(".."), F.lit("_"))
    t = F.regexp_replace(F.regexp_replace(t, r'[<>:"/\\|?*\s\x00-\x1f]+', "_"), "_+", "_")
    return F.left(F.regexp_replace(t, r"^[_.]+|[_.]+$", ""), F.lit(longest))
