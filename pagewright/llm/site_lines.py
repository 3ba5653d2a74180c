"""Lines repeated across one site's documents (problem 4).

A line's frequency within its site is compared by a log-likelihood ratio with two frequencies outside: that of the
same line on other sites, and that of any line there which isn't repeated. The first finds what a site has for
itself; lines that one publishing system prints on many sites have no excess over it, but one over the second.
The larger ratio counts, under false-discovery control over all lines of all sites. ``p4_found`` takes of the
significant lines those on enough distinct urls, as its definition asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sites import site_key
from ..session import kept, spread

#: Distinct urls of a site from which on a line is repeated too much.
MIN_URLS = 10
#: Share of wrong discoveries among the significant lines.
FALSE_DISCOVERIES = 0.01
#: Letters that a line must hold after normalising.
MIN_LETTERS = 12
#: Lines written once that other sites' rate of a line starts from, so that a few lines don't set it.
LINES_ONCE = 100
#: Rows of one line that one task joins back to their pages.
ROWS_A_SALT = 100_000


def folded_lines(content: Column) -> Column:
    """Lines of a text in lower case, digit runs as ``0``, blanks within a line as single ones: whole texts at once."""
    return F.split(F.regexp_replace(F.regexp_replace(F.lower(content), r"\p{Nd}+", "0"), r"(?U)[\s&&[^\n]]+", " "), "\n", -1)


def normalised(line: Column) -> Column:
    """A folded line from its first letter or digit to its last."""
    return F.regexp_extract(line, r"(?s)[\p{L}\p{N}](?:.*[\p{L}\p{N}])?", 0)


def lines_of(pages: DataFrame, page_id: str = "page_id", url: str = "url", base_url: str = "base_url", content: str = "content") -> DataFrame:
    """``page_id, line_no, site, url, key``: the lines that can be repeated, numbered from 1 over all lines.

    ``site``, ``url`` and ``key``, the normalised line, are hashes. Lines of HTML tags alone and lines of less than
    ``MIN_LETTERS`` letters are left out; a NULL content has no lines, a NULL url counts as one page.
    """
    used = spread(pages.where(F.col(content).isNotNull()).select(page_id, base_url, url, content))
    split = used.select(F.col(page_id).alias("page_id"), F.xxhash64(site_key(F.col(base_url))).alias("site"), F.xxhash64(F.coalesce(F.col(url), F.lit(""))).alias("url"), F.posexplode(folded_lines(F.col(content))).alias("pos", "line"))
    only_tags = F.contains("line", F.lit("<")) & (F.trim(F.regexp_replace("line", r"<[^<>]*+>", "")) == "")
    # enough letters are looked for from the left and no further
    long = (F.length("line") >= MIN_LETTERS) & F.col("line").rlike(rf"^(?:\P{{L}}*+\p{{L}}){{{MIN_LETTERS}}}") & ~only_tags
    return split.where(long).select("page_id", (F.col("pos") + 1).alias("line_no"), "site", "url", F.xxhash64(normalised(F.col("line"))).alias("key"))


def _g2(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Log-likelihood ratio of ``k1`` of ``n1`` against ``k2`` of ``n2``, 0 where the first share isn't the larger."""
    p = (k1 + k2) / (n1 + n2)
    part = lambda k, n: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0) + F.when(n > k, (n - k) * F.log((n - k) / (n * (1 - p)))).otherwise(0.0)
    return F.when((k1 / n1 > k2 / F.greatest(n2, F.lit(1.0))) & (p < 1), 2 * (part(k1, n1) + part(k2, n2))).otherwise(0.0)


def _g2_rate(k: Column, rate: Column) -> Column:
    """The same ratio of a count against a known rate."""
    return F.when(k > rate, 2 * (k * F.log(k / rate) - (k - rate))).otherwise(0.0)


def site_sizes(pages: DataFrame, url: str = "url", base_url: str = "base_url") -> DataFrame:
    """``site, n_site``: distinct urls of each site."""
    urls = pages.select(F.xxhash64(site_key(F.col(base_url))).alias("site"), F.xxhash64(F.coalesce(F.col(url), F.lit(""))).alias("url")).distinct()
    return urls.groupBy("site").agg(F.count(F.lit(1)).cast("double").alias("n_site"))


def line_statistics(lines: DataFrame, sites: DataFrame, min_urls: int = MIN_URLS) -> DataFrame:
    """Per site and line: ``n_urls``, ``n_outside`` and the larger log-likelihood ratio ``g2``.

    Distinct urls are folded in each task before they are shuffled, so a line on every page of a site with a
    third of all rows is one partial count a task, never a group in one place. Site totals are a table of
    one row a site. A line on one url of its site is no repetition: its ratio is 0, and only its rest counts.
    The rate of other sites' lines is their mean number of urls, those on ``min_urls`` and more left out, with
    ``LINES_ONCE`` lines of one url added.
    """
    within = kept(lines.groupBy("site", "key", "url").agg(F.count(F.lit(1)).alias("n")).groupBy("site", "key").agg(F.count(F.lit(1)).cast("double").alias("n_urls")))
    again = within.where("n_urls > 1")
    # only lines that some site repeats are asked for outside
    everywhere = within.join(again.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.sum("n_urls").alias("n_all"))
    usual = within.where(F.col("n_urls") < min_urls).groupBy("site").agg(F.sum("n_urls").alias("o"), F.count(F.lit(1)).alias("l"))
    sums = usual.agg(F.sum("o").alias("o_all"), F.sum("l").alias("l_all"))
    whole = sites.agg(F.sum("n_site").alias("n_total"))
    # the totals are single rows
    known = sites.join(usual, "site", "left").na.fill(0, ["o", "l"]).join(F.broadcast(whole), how="cross").join(F.broadcast(sums), how="cross")
    rate = (F.coalesce("o_all", F.lit(0)) - F.col("o") + LINES_ONCE) / (F.coalesce("l_all", F.lit(0)) - F.col("l") + LINES_ONCE)
    t = again.join(everywhere, "key").join(known.select("site", "n_site", "n_total", rate.alias("rate")), "site")
    outside, rest = F.col("n_all") - F.col("n_urls"), F.col("n_total") - F.col("n_site")
    against_same = F.when(rest > 0, _g2(F.col("n_urls"), F.col("n_site"), outside, rest)).otherwise(0.0)
    ratio = F.greatest(against_same, _g2_rate(F.col("n_urls"), F.col("rate")))
    repeated = t.select("site", "key", F.col("n_urls").cast("bigint").alias("n_urls"), outside.cast("bigint").alias("n_outside"), ratio.alias("g2"))
    once = within.where("n_urls = 1").select("site", "key", F.lit(1).cast("bigint").alias("n_urls"), F.lit(None).cast("bigint").alias("n_outside"), F.lit(0.0).alias("g2"))
    return repeated.unionByName(once)


#: Steps of the grid on which the false-discovery threshold is looked for.
GRID = 0.05


def significant(stats: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """Lines of ``stats`` that stay significant with at most ``rate`` wrong ones expected among them.

    Benjamini and Hochberg's rule needs the rank of each p-value. The ranks are read off a histogram of
    ``g2`` with steps of ``GRID`` (some thousand rows at any size), so nothing is sorted in one place. The
    p-value is one-sided, bounded from above by the normal tail's ``exp(-g2/2) / sqrt(2 pi g2)``, so the rate holds.
    """
    step = F.least(F.floor(F.col("g2") / GRID), F.lit(40_000))
    histogram = stats.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    # the histogram's size is bounded by its 40,001 steps
    steps = histogram.agg(F.sort_array(F.collect_list(F.struct("step", "n")), asc=False).alias("s"), F.sum("n").alias("m"))
    tail = lambda g2: F.when(g2 > 1, F.exp(-g2 / 2) / F.sqrt(2 * F.pi() * g2)).otherwise(1.0)
    ranked = F.aggregate("s", F.struct(F.lit(0).cast("bigint").alias("rank"), F.lit(float("inf")).alias("least")), lambda a, x: F.struct((a["rank"] + x["n"]).alias("rank"), F.when(tail(x["step"] * F.lit(GRID)) <= rate * (a["rank"] + x["n"]) / F.col("m"), x["step"] * F.lit(GRID)).otherwise(a["least"]).alias("least")))
    threshold = steps.select(ranked["least"].alias("least"))
    return stats.join(F.broadcast(threshold), F.col("g2") >= F.col("least")).drop("least")


def repeated_lines(pages: DataFrame, min_urls: int = MIN_URLS, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """Distinct ``page_id, line_no`` of the significant lines on at least ``min_urls`` distinct urls of a site.

    A line has a copy for each ``ROWS_A_SALT`` of its urls, and its occurrences are spread over the copies: a line
    on each page of a huge site isn't one reducer's work.
    """
    lines = kept(lines_of(pages))
    found = significant(kept(line_statistics(lines, site_sizes(pages))), rate).where(F.col("n_urls") >= min_urls)
    n_salts = F.ceil(F.col("n_urls") / ROWS_A_SALT).cast("int")
    copies = found.select("site", "key", n_salts.alias("n_salts"))
    most = copies.agg(F.coalesce(F.max("n_salts"), F.lit(1)).alias("n")).first()["n"]
    if most == 1:
        hit = lines.join(copies, ["site", "key"], "left_semi")
    else:
        salted = copies.select("site", "key", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("salt"))
        hit = lines.withColumn("salt", F.pmod(F.hash("page_id"), F.lit(most))).join(salted, ["site", "key", "salt"], "left_semi")
    return hit.select("page_id", "line_no").distinct()


def outcomes(pages: DataFrame, min_urls: int = MIN_URLS, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``often, significant, n_lines``: repeated lines of all sites by the test's and the count's outcome."""
    stats = kept(line_statistics(lines_of(pages), site_sizes(pages)))
    marked = stats.where("n_urls > 1").join(significant(stats, rate).select("site", "key", F.lit(True).alias("significant")), ["site", "key"], "left")
    return marked.groupBy((F.col("n_urls") >= min_urls).alias("often"), F.coalesce("significant", F.lit(False)).alias("significant")).agg(F.count(F.lit(1)).alias("n_lines"))


def without_lines(pages: DataFrame, cut: DataFrame) -> DataFrame:
    """``page_id, content, n_cut``: each page put together again by position without the lines of ``cut``.

    Only pages that lose lines meet their line numbers; a page keeps its other lines and their order.
    """
    gone = cut.groupBy("page_id").agg(F.collect_set("line_no").alias("gone"))
    parts = F.split("content", "\n", -1)
    kept = F.filter(parts, lambda _, i: ~F.array_contains(F.col("gone"), (i + 1).cast("int")))
    joined = pages.select("page_id", "content").join(gone, "page_id", "left")
    whole = F.when(F.col("gone").isNull() | F.col("content").isNull(), F.col("content")).otherwise(F.array_join(kept, "\n"))
    return joined.select("page_id", whole.alias("content"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_cut"))
