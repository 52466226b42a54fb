"""URL filters: allow and block rules, and a logistic regression for the urls no rule fits.

Everything here is SQL on columns. A url is judged in its own row: no join and no shuffle.

Cases: a null url, or one without ``://``, has an empty host and path; no rule fits it and the
classifier judges it by its intercept. Repeated rows are judged alike. Columns other than the
key and the url are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
GRAMS = (3, 4, 5)
STEPS = 300
RATE = 0.01
THRESHOLD = 0.75  # a url is blocked from this probability on; over one half, to spare clean hosts
MAX_LABELLED = 2000  # rows of the labelled table: it is held in one row while it is fitted

# The labelled urls the classifier is trained on (1: block).
LABELLED = (
    ("adult-films.test", "/watch/1", 1),
    ("m.adult-x-clips.test", "/en/77", 1),
    ("adult-x.test", "/de/812.html", 1),
    ("blog.spam-farm.test", "/en/5?ref=x", 1),
    ("spam-farm-links.test", "/seo/backlinks/", 1),
    ("www.link-spam.test", "/fr/401", 1),
    ("cheap-pills.test", "/buy/now", 1),
    ("www.cheap-pills-online.test", "/es/12", 1),
    ("discount-pills.test", "/en/311.html", 1),
    ("ads-track.test", "/click/9", 1),
    ("m.ads-tracker.test", "/pixel/1", 1),
    ("cdn.ads-track-net.test", "/en/48", 1),
    ("casino-win.test", "/slots/", 1),
    ("www.win-casino.test", "/en/2", 1),
    ("blog.casino-bonus.test", "/fr/650/", 1),
    ("free-bets.test", "/odds/today", 1),
    ("m.free-bets-live.test", "/en/31", 1),
    ("best-bets.test", "/de/7", 1),
    ("news.test", "/en/2001/05/report", 0),
    ("www.daily-herald.test", "/world/article-12.html", 0),
    ("blog.gardening.test", "/de/45", 0),
    ("library.test", "/catalog/77", 0),
    ("www.university.test", "/en/courses/", 0),
    ("m.weather.test", "/fr/paris", 0),
    ("recipes.test", "/es/tortilla.html", 0),
    ("blog.mountain-hikes.test", "/en/91/", 0),
    ("docs.software.test", "/en/manual?page=2", 0),
    ("www.museum.test", "/fr/collection/8", 0),
    ("history.test", "/en/1815", 0),
    ("m.cityguide.test", "/de/berlin/", 0),
    ("science.test", "/en/physics/123.html", 0),
    ("www.bookshop.test", "/es/novela/9", 0),
    ("blog.thenation.test", "/en/31", 0),
    ("theother.test", "/en/512.html", 0),
    ("www.thinking.test", "/fr/88", 0),
    ("station.test", "/de/1450?ref=x", 0),
    ("m.orientation.test", "/en/2", 0),
    ("theatre.test", "/es/640", 0),
    ("www.motion.test", "/en/7700/", 0),
    ("blog.tradition.test", "/fr/310", 0),
)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return _ascii_lower(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (size, rule, verdict); null where none fits.

    ``rules`` are (``host/path``, ``allow`` or ``block``). A rule fits its host and all subdomains
    when the path starts with the rule's path. Of two of one length the longer host wins.
    """
    if not rules:
        return F.lit(None).cast("struct<size:int,in_host:int,rule:string,verdict:string>")
    listed = []
    for rule, verdict in rules:
        at = rule.index("/")
        fits = (host == rule[:at]) | F.endswith(host, F.lit("." + rule[:at]))
        fits = fits & F.startswith(path, F.lit(rule[at:]))
        found = F.struct(
            F.lit(len(rule)).alias("size"), F.lit(at).alias("in_host"), F.lit(rule).alias("rule"),
            F.lit(verdict).alias("verdict"),
        )
        listed.append(F.when(fits, found))
    return F.array_max(F.array(*listed))


def gram_buckets(host: Column, path: Column, buckets: int = BUCKETS, grams: Sequence[int] = GRAMS) -> Column:
    """Distinct hashed character n-grams of host and path; each field has marks at both ends."""
    parts = []
    for kind, text in (("h", host), ("p", path)):
        for n in grams:
            marked = F.concat(F.lit("^"), text, F.lit("$"))
            last = F.length(marked) - (n - 1)
            starts = F.when((last >= 1) & (F.length(text) > 0), F.sequence(F.lit(1), last))
            starts = F.coalesce(starts, F.array().cast("array<int>"))
            parts.append(F.transform(starts, _hashed(marked, f"{kind}{n}:", n, buckets)))
    return F.array_distinct(F.concat(*parts))


def _hashed(text: Column, prefix: str, n: int, buckets: int) -> Callable[[Column], Column]:
    def bucket(start: Column) -> Column:
        gram = F.concat(F.lit(prefix), F.substr(text, start, F.lit(n)))
        return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")

    return bucket


def fit(
    labelled: DataFrame, *, buckets: int = BUCKETS, grams: Sequence[int] = GRAMS, steps: int = STEPS, rate: float = RATE
) -> tuple[float, list[float]]:
    """Logistic regression by gradient descent: (intercept, weight per bucket).

    ``labelled`` has host, path, label and at most ``MAX_LABELLED`` rows. Each step moves the
    weights along the sum of the rows' features times their errors, so the weights always are
    such a sum. The descent therefore runs on the one number per row that multiplies its
    features, over the table of shared buckets of each two labelled rows.
    """
    if (n := labelled.count()) > MAX_LABELLED:
        raise ValueError(f"{n} labelled urls; at most {MAX_LABELLED} are fitted")
    if n == 0:
        return 0.0, [0.0] * buckets
    rows = labelled.select(
        F.col("label").cast("double").alias("y"), gram_buckets(F.col("host"), F.col("path"), buckets, grams).alias("f")
    )
    held = rows.agg(F.array_sort(F.collect_list(F.struct("y", "f"))).alias("rows"))
    held = held.withColumn(
        "shared", F.expr("transform(rows, r -> struct(r.y as y, transform(rows, s -> 1D + size(array_intersect(r.f, s.f))) as k))")
    ).repartition(1)  # one row; the exchange keeps the table from being computed again in each step
    step = (
        "zip_with(a, shared, (x, g) -> x + {rate}D * (g.y - 1 / (1 + exp(-aggregate(zip_with(a, g.k, (u, v) -> u * v), "
        "0D, (s, z) -> s + z)))))"
    ).format(rate=rate)
    held = held.withColumn(
        "a", F.expr(f"aggregate(sequence(1, {steps}), transform(rows, r -> 0D), (a, i) -> {step})")
    ).repartition(1)
    pairs = held.select(F.explode(F.arrays_zip("rows", "a")).alias("z"))
    pairs = pairs.select(F.explode("z.rows.f").alias("b"), F.col("z.a").alias("a"))
    weights = [0.0] * buckets
    for b, w in pairs.groupBy("b").agg(F.sum("a")).collect():  # one row per bucket at most
        weights[b] = w
    return held.select(F.expr("aggregate(a, 0D, (s, x) -> s + x)")).first()[0], weights


def probability(host: Column, path: Column, model: tuple[float, Sequence[float]], grams: Sequence[int] = GRAMS) -> Column:
    """How likely a url is to be blocked."""
    intercept, weights = model
    held = F.lit(np.array(weights, dtype="float64"))  # one array literal
    margin = F.aggregate(
        gram_buckets(host, path, len(weights), grams), F.lit(float(intercept)), lambda s, b: s + F.get(held, b)
    )
    return 1 / (1 + F.exp(-margin))


def labelled_urls(spark: SparkSession, rows: Sequence[tuple[str, str, int]] = LABELLED) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', {y})" for h, p, y in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, label)")


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], model: tuple[float, Sequence[float]],
    *, key: str = "page_id", url: str = "url", threshold: float = THRESHOLD,
) -> DataFrame:
    """A row per page: key, host, path, rule, verdict, and the classifier's p_block."""
    split = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    judged = split.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "p_block", probability(F.col("host"), F.col("path"), model)
    )
    own = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return judged.select(
        key, "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "p_block",
    )
