"""Page boilerplate around and inside main content (problem 5).

The pages of a host are one token stream, in which a line's ends count as tokens too. The host's suffix array is
built in parts of a bounded number of pages: the suffixes of a part are named by prefix doubling and sorted, so
that those with an equal prefix of ``DEPTH`` tokens lie together, across line ends and within lines. A
substring on a share of the host's pages has that share in one of its parts at least, so the parts' frequent
prefixes are the only candidates; they are counted in all parts, and the tokens that frequent ones cover are
the repeated runs. A line mostly covered is repeated. Repeated lines hold notices of the article as well as
chrome, so votes decide which is which: the containers of pages that still have HTML, and the place of a run
before, among or after unique text. Unique lines are content; the page's heading, the containers and boxes
opened by repeated lines decide only about those among them that lie outside the article.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sites import site_key
from ..session import kept, spread

#: Tokens that a repeated substring has at least, line ends included: a power of two.
DEPTH = 8
#: Tokens that each end of a line counts for, so that a short line repeated as a whole is long enough.
ENDS = 3
#: Share of a host's pages from which on a substring is repeated, and the pages that make a repetition at all.
SHARE = 0.02
MIN_PAGES = 3
#: Share of a line's tokens that repeated runs cover in a repeated line.
COVERED = 0.5
#: Pages and tokens of one part of a host's array.
PART_PAGES = 4_000
PART_TOKENS = 4_000_000
#: Share of votes that a minority must have to count.
MINORITY = 0.02
#: A notice of the article has text after it this often; a run that never has is a footer once that would be so unlikely.
AMID, DOUBT = 0.45, 0.001
#: Tokens from which on a unique line counts as text of its own.
TEXT_TOKENS = 6

# HTML elements that hold blocks, and names of the block with the body.
CONTAINERS = "html|body|div|aside|nav|header|footer|section|main|article|form"
BODY_NAMES = re.compile(r"(?i)^<(?:main|article)\b|\b(?:id|class)\s*=\s*[\"'][^\"']*\b(?:content|article|main|obsah|post|entry|body-text|article-body|clanek)\b")
CHROME_NAMES = re.compile(r"(?i)^<(?:nav|aside|header|footer|form)\b|\b(?:id|class)\s*=\s*[\"'][^\"']*(?:menu|nav|side|cookie|consent|bread|footer|header|paticka|share|social|lang|search|banner|box|widget|comments)")
GENERIC_LABELS = {"www", "obec", "mesto", "mestys", "portal", "kraj", "web", "example", "cz", "sk", "com", "eu", "net", "org", "info"}

_ONLY_TAGS = re.compile(r"(?:\s*<[^<>]*>\s*)+")
_CONTAINER = re.compile(rf"(?i)</?(?:{CONTAINERS})\b[^<>]*>")
_LINK = re.compile(r"\]\([^()\s]*(?:\s+\"[^\"]*\")?\)|https?://\S+|<[^<>]*>")
_TOKEN = re.compile(r"[^\W_]+")
_HEADING = re.compile(r"^\s*(?:#\s+\S|<h1\b)", re.IGNORECASE)
_LINK_LINE = re.compile(r"^\s*(?:[-*+•]\s*)?(?:\[[^\]]*\]\([^)]*\)|<a\b.*</a>)\s*$")
_IS_HTML = re.compile(r"(?i)<(?:html|body|div|p|h1|main|article)\b")
_DIGITS = re.compile(r"\d+")
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff]+")
_SELECTOR = re.compile(r"^([a-z][\w-]*)?((?:[.#][\w-]+)*)$", re.IGNORECASE)

# a line's kind, its place by the heading, and what container it stands in
BLANK, TEXT, LINK, LABEL = range(4)
NONE, BEFORE, HEAD, AFTER = range(4)
NO_HTML, IN_BODY, IN_CHROME = range(3)
#: Why a line is no body.
REASONS = ("", "repeated", "box", "container", "before the heading", "no heading")

_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Place of a site's own name in a line, for the comparison of sites.
_PLACE = np.uint64(0x5EED)

PAGES = "page_id bigint, site bigint, url bigint, place bigint, n_tokens bigint, tokens binary, lines binary"
LINE = np.dtype([("pos", "<i4"), ("n", "<i4"), ("kind", "u1"), ("zone", "u1"), ("html", "u1")])
MARKED = np.dtype([("pos", "<i4"), ("n", "<i4"), ("kind", "u1"), ("zone", "u1"), ("html", "u1"), ("covered", "?"), ("whole", "?"), ("key", "<i8")])


def _fold(text: str) -> str:
    return _MARKS.sub("", unicodedata.normalize("NFKD", text.lower()))


def _tokens(line: str) -> list[str]:
    return _TOKEN.findall(_DIGITS.sub("0", _fold(_LINK.sub(" ", line))))


def _slug(text: str) -> str:
    return "-".join(_TOKEN.findall(_fold(_LINK.sub(" ", text))))


def _number(name: str) -> int:
    return xxhash.xxh64_intdigest(name) - (1 << 63)


_ids: dict[str, int] = {}


def _id(word: str) -> int:
    """A token's number, the same in every task; 0 is a line's end."""
    n = _ids.get(word)
    if n is None:
        if len(_ids) > 1_000_000:
            _ids.clear()
        n = _ids[word] = xxhash.xxh32_intdigest(word) or 1
    return n


def heading_of(lines: list[str], tokens: list[list[str]], title: str | None, url: str | None) -> int:
    """Index of the page's heading, -1 where it has none: a heading line, the title again, or the url's words."""
    for i, line in enumerate(lines):
        if _HEADING.match(line):
            return i
    wanted = _tokens(title) if title else []
    if wanted:
        for i, t in enumerate(tokens):
            if t == wanted:
                return i
    words = re.sub(r"-\d+$", "", re.sub(r"[?#].*$", "", url or "").rstrip("/").rsplit("/", 1)[-1])
    if len(words) >= 12:
        for i, line in enumerate(lines):
            slug = _slug(line)
            if slug and (slug == words or slug.startswith(words) and len(words) >= 20):
                return i
    return -1


def selectors_of(text: str | None) -> list[tuple[str, set[str], set[str]]]:
    """Element, ids and classes of each selector of a list; others than these simple ones select nothing here."""
    out = []
    for part in (text or "").split(","):
        m = _SELECTOR.match(part.strip())
        if m and part.strip():
            names = re.findall(r"[.#][\w-]+", m[2])
            out.append(((m[1] or "").lower(), {n[1:] for n in names if n[0] == "#"}, {n[1:] for n in names if n[0] == "."}))
    return out


def _selected(tag: str, selectors: list[tuple[str, set[str], set[str]]]) -> bool:
    if not selectors:
        return False
    name = re.match(r"<(\w+)", tag)[1].lower()
    value = lambda a: set((re.search(rf"(?i)\b{a}\s*=\s*[\"']([^\"']*)", tag) or ["", ""])[1].split())
    ids, classes = value("id"), value("class")
    return any((not e or e == name) and i <= ids and c <= classes for e, i, c in selectors)


def read_page(site: str, url: str | None, title: str | None, content: str, selectors: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the page's tokens, and its lines (``LINE``), blank ones included, lines of tags alone left out."""
    lines = content.split("\n")
    is_html = bool(_IS_HTML.search(content))
    plain = _fold(_LINK.sub(" ", content) if "\n" not in content else "\n".join(_LINK.sub(" ", x) if "](" in x or "<" in x or "http" in x else x for x in lines))
    words = [_TOKEN.findall(x) for x in _DIGITS.sub("0", plain).split("\n")]
    tags = [x.find("<") >= 0 and bool(_ONLY_TAGS.fullmatch(x)) for x in lines] if "<" in content else [False] * len(lines)
    tokens = [[] if tag else w for w, tag in zip(words, tags)]
    head = heading_of(lines, tokens, title, url)
    chosen = selectors_of(selectors) if is_html else []
    rows: list[tuple] = []
    ids: list[int] = []
    stack: list[tuple[str, int]] = []
    for i, (line, tag, t) in enumerate(zip(lines, tags, tokens)):
        if is_html and "<" in line:
            # containers are closed by any container's end: scraped pages mix them up
            for m in _CONTAINER.finditer(line):
                if m[0].startswith("</"):
                    if stack:
                        stack.pop()
                elif not m[0].endswith("/>"):
                    removed = _selected(m[0], chosen) or re.match(r"(?i)<(?:nav|aside|header|footer)\b", m[0])
                    own = IN_CHROME if removed else IN_BODY if BODY_NAMES.search(m[0]) else IN_CHROME if CHROME_NAMES.search(m[0]) else None
                    stack.append((m[0], stack[-1][1] if own is None and stack else IN_CHROME if own is None else own))
        if tag:
            continue
        html = NO_HTML if not is_html or not stack else stack[-1][1]
        zone = NONE if head < 0 else BEFORE if i < head else HEAD if i == head else AFTER
        bare = line.strip()
        text = bare.rstrip("*_ ")
        kind = BLANK if not bare else LINK if _LINK_LINE.match(line) else TEXT if text[-1:] in ".!?:;,)”“\"" or "\t" in text or not bare[:1].isupper() else LABEL
        rows.append((i + 1, len(t), kind, zone, html))
        ids.extend(map(_id, t))
    return np.array(ids, np.uint32), np.array(rows, LINE)


def page_tokens(pages: DataFrame, site_config: DataFrame | None = None) -> DataFrame:
    """A row of ``PAGES`` for each page with content, read once; ``remove_selectors`` of its site mark containers."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_id, site, url, title, content, selectors in batch.itertuples(index=False, name=None):
                ids, lines = read_page(site, url, title, content, selectors)
                place = max((p for p in re.split(r"[.\-]", site) if p not in GENERIC_LABELS), key=len, default="")
                rows.append((page_id, _number(site), _number(url if url else f"#{page_id}"), _id(place), len(ids) + 2 * ENDS * len(lines), ids.tobytes(), lines.tobytes()))
            yield pd.DataFrame(rows, columns=["page_id", "site", "url", "place", "n_tokens", "tokens", "lines"])

    p = spread(pages.where("content IS NOT NULL AND page_id IS NOT NULL").select("page_id", "base_url", "url", "title", "content"))
    p = p.withColumn("site", F.coalesce(site_key(F.col("base_url")), F.lit("")))
    if site_config is None:
        p = p.withColumn("selectors", F.lit(None).cast("string"))
    else:
        # one row a site; Spark broadcasts it where its size allows
        known = site_config.where("base_url IS NOT NULL").groupBy(site_key(F.col("base_url")).alias("site")).agg(F.max("remove_selectors").alias("selectors"))
        p = p.join(known, "site", "left")
    return p.select("page_id", "site", "url", "title", "content", "selectors").mapInPandas(read, PAGES)


def in_parts(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``n_site`` (distinct pages of the host), ``n_parts`` and ``part``.

    A host's pages are spread over its parts by their url, so that the crawls of a url meet in one part. Of a
    url crawled more than ``PART_PAGES`` times each ``PART_PAGES`` crawls count as a page of their own.
    """
    crawls = tokens.groupBy("site", "url").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"))
    split = F.ceil(F.col("n") / PART_PAGES)
    sites = crawls.groupBy("site").agg(F.sum(split).alias("n_site"), F.ceil(F.greatest(F.sum("n") / PART_PAGES, F.sum("t") / PART_TOKENS)).cast("int").alias("n_parts"))
    often = crawls.where(split > 1).select("site", "url", split.cast("int").alias("split"))
    t = tokens.join(sites, "site").join(often, ["site", "url"], "left")
    page = F.when(F.col("split").isNull(), F.col("url")).otherwise(F.xxhash64("url", F.pmod(F.hash("page_id"), "split")))
    return t.withColumn("url", page).drop("split").withColumn("part", F.pmod(F.xxhash64("url"), "n_parts").cast("int"))


def named_suffixes(tokens: np.ndarray) -> np.ndarray:
    """A name for the suffix at each place, equal for equal prefixes of ``DEPTH`` tokens, by prefix doubling.

    Names are hashes, so they are the same in every part. Where the stream ends sooner the prefix is its own.
    """
    names = (tokens.astype(np.uint64) + np.uint64(1)) * _MIX
    span = 1
    with np.errstate(over="ignore"):
        while span < DEPTH:
            next_half = np.zeros_like(names)
            next_half[:-span] = names[span:]
            names = (names ^ (names >> np.uint64(31))) * _MIX2 + next_half
            names = (names ^ (names >> np.uint64(29))) * _MIX
            span *= 2
    return names.view(np.int64)


class Part:
    """Pages of one part of a host as one stream, in order of their urls, with ends of lines and of pages in it."""

    def __init__(self, pages: pd.DataFrame):
        pages = pages.sort_values(["url", "page_id"], kind="stable")
        self.pages = pages
        lines = [np.frombuffer(x, LINE) for x in pages["lines"]]
        self.lines = np.concatenate(lines) if lines else np.zeros(0, LINE)
        self.page_lines = np.array([len(x) for x in lines], np.int64)
        self.line_page = np.repeat(np.arange(len(pages)), self.page_lines)
        words = np.concatenate([np.frombuffer(x, np.uint32) for x in pages["tokens"]]) if len(pages) else np.zeros(0, np.uint32)
        n = self.lines["n"].astype(np.int64)
        # lines without tokens (blank, rules, tags) have no place in the stream, so runs go on across them
        room = np.where(n > 0, n + ENDS, 0)
        first_of_page = np.zeros(len(n), bool)
        first_of_page[np.concatenate([[0], np.cumsum(self.page_lines)[:-1]])[self.page_lines > 0].astype(int)] = True
        # a page begins with an end that no page of another url has, in any part
        lead = np.where(first_of_page, 1 + ENDS, 0)
        stop = np.cumsum(room + lead)
        self.start = stop - room
        self.n = n
        size = int(stop[-1]) if len(stop) else 0
        # the last place ends the stream, also by the last page's url
        stream = np.zeros(size + 1, np.uint64)
        numbers = pages["url"].to_numpy(np.int64).view(np.uint64)
        stream[size] = (numbers[-1] if len(numbers) else np.uint64(0)) | (np.uint64(1) << np.uint64(41))
        within = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
        self.at = np.repeat(self.start, n) + within
        stream[self.at] = words
        borders = (stop - room - lead)[first_of_page]
        stream[borders] = numbers[self.page_lines > 0] | (np.uint64(1) << np.uint64(40))
        self.words = words
        self.names = named_suffixes(stream)
        urls = pd.factorize(pages["url"])[0]
        self.url = np.append(np.repeat(urls[self.line_page], room + lead), urls[-1:] if len(urls) else [0])
        self.n_urls = len(set(urls))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Names in order and the number of distinct urls of each: the suffix array's groups."""
        order = np.argsort(self.names, kind="stable")
        names, urls = self.names[order], self.url[order]
        new = np.ones(len(names), bool)
        new[1:] = names[1:] != names[:-1]
        # urls rise along the stream and the sort is stable, so equal ones are neighbours
        other = new.copy()
        other[1:] |= urls[1:] != urls[:-1]
        starts = np.flatnonzero(new)
        return names[starts], np.add.reduceat(other.astype(np.int64), starts) if len(starts) else starts

    def covered(self, frequent: np.ndarray) -> np.ndarray:
        """Whether each token lies in a frequent substring."""
        at = np.flatnonzero(np.isin(self.names, frequent))
        steps = np.zeros(len(self.names) + DEPTH + 1, np.int64)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + DEPTH, -1)
        return (np.cumsum(steps)[: len(self.names)] > 0)[self.at]


def _least(n_pages: int | float) -> float:
    """Pages that make a substring repeated on a host, or in a part, of ``n_pages``."""
    return SHARE * n_pages


def frequent_substrings(parted: DataFrame) -> DataFrame:
    """``site, n_parts, name``: substrings of ``DEPTH`` tokens on at least ``SHARE`` of their host's pages.

    Each part gives the substrings that are frequent in itself; a page has as many as tokens, so these are at
    most the tokens of an average page divided by ``SHARE``. For a host of one part they are the result. For
    the others each part counts the candidates of all parts, and the sums decide.
    """
    schema = "site bigint, n_parts int, name bigint, n bigint, n_site bigint"

    def candidates(pages: pd.DataFrame) -> pd.DataFrame:
        part = Part(pages)
        names, n = part.counts()
        use = n >= max(_least(part.n_urls), 1 if pages["n_parts"].iloc[0] > 1 else MIN_PAGES)
        return pd.DataFrame({"site": pages["site"].iloc[0], "n_parts": pages["n_parts"].iloc[0], "name": names[use], "n": n[use], "n_site": pages["n_site"].iloc[0]})

    found = kept(parted.groupBy("site", "part").applyInPandas(candidates, schema))
    several = found.where("n_parts > 1").select("site", "n_parts", "name").distinct()
    if several.isEmpty():
        return found.select("site", "n_parts", "name")
    asked = _to_parts(several)

    def recount(pages: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        if not len(pages):
            return pd.DataFrame({"site": [], "n_parts": [], "name": [], "n": [], "n_site": []}, dtype="int64")
        known, n = Part(pages).counts()
        use = np.isin(known, names["name"].to_numpy(np.int64))
        return pd.DataFrame({"site": pages["site"].iloc[0], "n_parts": pages["n_parts"].iloc[0], "name": known[use], "n": n[use], "n_site": pages["n_site"].iloc[0]})

    counted = parted.where("n_parts > 1").groupBy("site", "part").cogroup(asked.groupBy("host", "nth")).applyInPandas(recount, schema)
    summed = counted.groupBy("site", "n_parts", "name").agg(F.sum("n").alias("n"), F.max("n_site").alias("n_site"))
    sure = summed.where(F.col("n") >= F.greatest(F.col("n_site") * SHARE, F.lit(MIN_PAGES))).select("site", "n_parts", "name")
    return found.where("n_parts = 1").select("site", "n_parts", "name").unionByName(sure)


def _to_parts(rows: DataFrame) -> DataFrame:
    """A copy of each host's rows for each of its parts, as ``host`` and ``nth`` for the side that meets pages."""
    others = [c for c in rows.columns if c not in ("site", "n_parts")]
    return rows.select(F.col("site").alias("host"), F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("nth"), *others)


def _sums(part: Part, weights: np.ndarray) -> np.ndarray:
    """Sum of the tokens' weights in each line."""
    running = np.concatenate([np.zeros(1, weights.dtype), np.cumsum(weights, dtype=weights.dtype)])
    ends = np.cumsum(part.n)
    return running[ends] - running[ends - part.n]


VOTES = ("n", "html_chrome", "html_body", "before", "amid", "n_chrome_place", "leads")
_VOTE_COLUMNS = ", ".join(f"{v} bigint" for v in VOTES)


def _later(flag: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Whether a later line of the same page has the flag."""
    at = np.where(flag, np.arange(len(flag)), -1)
    last = np.full(int(page[-1]) + 1 if len(page) else 0, -1)
    np.maximum.at(last, page, at)
    return last[page] > np.arange(len(flag))


def marked_lines(parted: DataFrame, frequent: DataFrame) -> DataFrame:
    """Pages with their lines as ``MARKED`` (``key`` is the hash of a line's covered tokens), and rows of votes.

    A row has a ``page_id`` and ``lines``, or the votes of one ``key`` summed over the part; ``shared`` is the key
    with the site's own name left out, under which sites of one publishing system meet.
    """
    schema = f"site bigint, n_parts int, part int, page_id bigint, lines binary, key bigint, shared bigint, {_VOTE_COLUMNS}"

    def mark(pages: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        if not len(pages):
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        part = Part(pages)
        lines, n, page = part.lines, part.n, part.line_page
        token = part.covered(names["name"].to_numpy(np.int64))
        n_covered = _sums(part, token.astype(np.int64))
        covered = (n > 0) & (n_covered >= COVERED * n)
        # a key is the sum of its covered tokens' hashes by their places among them
        nth = np.cumsum(token) - token
        first = np.concatenate([[0], np.cumsum(token)])[np.cumsum(n) - n] if len(n) else n
        place = pages["place"].iloc[0]
        with np.errstate(over="ignore"):
            order = (nth - np.repeat(first, n) + 1).astype(np.uint64) * _MIX
            hashed = lambda w: _sums(part, np.where(token, (w ^ (order >> np.uint64(17))) * _MIX2 ^ order, np.uint64(0))).view(np.int64)
            words = part.words.astype(np.uint64) * _MIX
            key = hashed(words)
            shared = hashed(np.where(part.words == np.uint32(place), _PLACE, words))
        rows = np.zeros(len(lines), MARKED)
        for field in LINE.names:
            rows[field] = lines[field]
        rows["covered"], rows["whole"], rows["key"] = covered, (n > 0) & (n_covered == n), key
        kind, zone, html = lines["kind"], lines["zone"], lines["html"]
        follows = _later(~covered & (n >= TEXT_TOKENS) & (zone == AFTER) & (kind == TEXT), page)
        unique_next = np.zeros(len(n), bool)
        unique_next[:-1] = (page[1:] == page[:-1]) & (kind[1:] != BLANK) & ~covered[1:]
        outside = html == NO_HTML
        place_chrome = (zone == BEFORE) | (html == IN_CHROME)
        votes = pd.DataFrame({"key": key, "shared": shared, "n": 1, "html_chrome": html == IN_CHROME, "html_body": html == IN_BODY, "before": outside & (zone == BEFORE), "amid": outside & (zone == AFTER) & follows, "n_chrome_place": place_chrome, "leads": place_chrome & unique_next})[covered]
        # nullable integers from here on, as pages have no key: others would pass through floating point
        votes = votes.astype("int64").groupby(["key", "shared"], as_index=False).sum().astype("Int64")
        ends = np.cumsum(part.page_lines)
        pieces = [rows[e - k : e].tobytes() for e, k in zip(ends, part.page_lines)]
        out = pd.concat([pd.DataFrame({"page_id": part.pages["page_id"].astype("Int64").array, "lines": pieces}), votes], ignore_index=True)
        out["site"], out["n_parts"], out["part"] = pages["site"].iloc[0], pages["n_parts"].iloc[0], pages["part"].iloc[0]
        return out[[c.split()[0] for c in schema.split(", ")]]

    return parted.groupBy("site", "part").cogroup(_to_parts(frequent).groupBy("host", "nth")).applyInPandas(mark, schema)


def _verdict(v: Column) -> Column:
    """``chrome``, ``body`` or NULL where there is no vote, from the sums of ``VOTES`` in struct ``v``."""
    html = v["html_chrome"] + v["html_body"]
    outside = v["n"] - html
    footer = F.pow(F.lit(1 - AMID), outside) <= DOUBT
    by_place = F.when(v["before"] > outside * MINORITY, "chrome").when(v["amid"] > outside * MINORITY, "body").when(footer, "chrome").otherwise("body")
    return F.when(html > 0, F.when(v["html_chrome"] >= v["html_body"], "chrome").otherwise("body")).when(outside > 0, by_place)


def verdicts(marked: DataFrame) -> DataFrame:
    """``site, n_parts, key, chrome, opens``: what repeated lines are, by the votes of all sites that share them."""
    votes = marked.where("key IS NOT NULL").groupBy("site", "n_parts", "key", "shared").agg(*[F.sum(v).alias(v) for v in VOTES])
    together = votes.groupBy("shared").agg(*[F.sum(v).alias(v) for v in VOTES]).select("shared", F.struct(*VOTES).alias("all"))
    return votes.join(together, "shared").select("site", "n_parts", "key", (_verdict(F.col("all")) == "chrome").alias("chrome"), (F.col("all.leads") * 2 > F.col("all.n_chrome_place")).alias("opens"))


def classified(pages: DataFrame, site_config: DataFrame | None = None) -> DataFrame:
    """``page_id, pos, reason``: each non-blank line of a page, and why it is no body (``REASONS``, blank for body)."""
    parted = in_parts(kept(page_tokens(pages, site_config)))
    marked = kept(marked_lines(parted, frequent_substrings(parted)))
    known = _to_parts(verdicts(marked))

    def judge(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"page_id": pd.Series(dtype="int64"), "pos": pd.Series(dtype="int32"), "reason": pd.Series(dtype=object)})
        parts = [np.frombuffer(x, MARKED) for x in rows["lines"]]
        lines = np.concatenate(parts)
        page = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        keys = known["key"].to_numpy(np.int64)
        order = np.argsort(keys)
        at = np.minimum(np.searchsorted(keys[order], lines["key"]), max(len(keys) - 1, 0))
        covered = lines["covered"]
        there = covered & (keys[order][at] == lines["key"]) if len(keys) else np.zeros(len(lines), bool)
        chrome, opens = (there & known[c].to_numpy(bool)[order][at] if len(keys) else there for c in ("chrome", "opens"))
        kind, zone, html = lines["kind"], lines["zone"], lines["html"]
        # a title or link with words of its own, though phrases in it may be common
        teaser = ~lines["whole"] & ~chrome & np.isin(kind, (LINK, LABEL)) & (zone == AFTER)
        # the last line before that is no teaser itself, on the same page
        index = np.arange(len(lines))
        starts = np.concatenate([[True], page[1:] != page[:-1]]) if len(page) else np.zeros(0, bool)
        solid = np.maximum.accumulate(np.where(~teaser, index, -1))
        begin = np.maximum.accumulate(np.where(starts, index, -1))
        in_box = teaser & (solid >= begin) & (chrome & opens)[solid]
        in_head = zone == HEAD
        reason = np.select(
            [chrome & ~in_head, in_box, (html == IN_CHROME), (zone == NONE), (zone == BEFORE) & (html != IN_BODY)],
            [1, 2, 3, 5, 4],
            0,
        )
        use = kind != BLANK
        return pd.DataFrame({"page_id": rows["page_id"].to_numpy("int64")[page[use]], "pos": lines["pos"][use], "reason": np.array(REASONS, object)[reason[use]]})

    lines = marked.where("page_id IS NOT NULL").select("site", "part", "page_id", "lines")
    return lines.groupBy("site", "part").cogroup(known.groupBy("host", "nth")).applyInPandas(judge, "page_id bigint, pos int, reason string")


def boilerplate_lines(pages: DataFrame, site_config: DataFrame | None = None) -> DataFrame:
    """Distinct ``page_id, line_no`` of the non-blank lines outside the body, lines counted from 1 over all.

    NULL and blank contents have no lines, a page without an id none that could be named; a page without heading has no body; equal rows count once; an
    empty table gives no rows. Lines of tags alone are left out. Further columns are ignored.
    """
    return classified(pages, site_config).where("reason <> ''").select("page_id", F.col("pos").alias("line_no")).distinct()


def reasons(pages: DataFrame, site_config: DataFrame | None = None) -> DataFrame:
    """``reason, n_lines, n_pages``: how many lines go because they are repeated, and how many by a tie-break."""
    per_page = classified(pages, site_config).groupBy("reason", "page_id").agg(F.countDistinct("pos").alias("n"))
    return per_page.groupBy("reason").agg(F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_pages"))


def main_content(pages: DataFrame, site_config: DataFrame | None = None) -> DataFrame:
    """``page_id, content, n_cut``: each page's body lines in their order, tags within them kept."""
    cut = boilerplate_lines(pages, site_config).groupBy("page_id").agg(F.collect_set("line_no").alias("gone"))
    parts = F.split("content", "\n", -1)
    only_tags = lambda x: F.contains(x, F.lit("<")) & (F.trim(F.regexp_replace(x, r"<[^<>]*>", "")) == "")
    kept = F.filter(parts, lambda x, i: ~F.array_contains(F.col("gone"), (i + 1).cast("int")) & ~only_tags(x))
    joined = pages.select("page_id", "content").join(cut, "page_id", "left")
    return joined.select("page_id", F.when(F.col("gone").isNull(), F.col("content")).otherwise(F.array_join(kept, "\n")).alias("content"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_cut"))
