"""Line deduplication by content-defined chunks of lines, in SQL on columns.

A rolling hash over the hashes of the last two lines decides where a chunk ends, so an inserted
or missing line moves the borders next to it only. Chunks of several lines that occur more than
once anywhere are compared byte by byte; the first occurrence (smallest key, then place) stays,
the others are removed from their documents.

Chunks are counted by hash before any text moves, and bodies are joined to the repeated hashes
alone; equal bodies are aggregated to their first occurrence. No group of equal chunks is ever
collected: a join row is either first or not. What is collected is a document's own lines.

Chunks whose borders fall badly are missed. ``passage_words`` asks for whole passages besides: single
lines of more words, and runs of lines of more words together in which every two neighbouring lines
stand side by side earlier too, wherever they begin or end. These are compared by SHA-256. The first
occurrence of every line stays, as a line is removed only where an earlier one equals it.

Cases: a null text is one empty line and is returned as an empty text. Chunks of one line, or of
blank lines only, are never removed. Of rows equal in key and text each counts as first. Rows
equal in key alone are told apart by their text. A null key comes before all others. Columns
besides key and text are not looked at, and kept where the caller asks for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

MIN_LINES = 2
MEAN_LINES = 4  # a chunk ends after one of so many lines
PASSAGE_WORDS = 50  # of a passage, from which on it counts, where passages are asked for
FACTOR, MODULUS = 131, 1_000_003


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, also where lambdas read it for each element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(body).alias("_print"), body.alias("_text"))
    return _held(rows, "_lines", F.split("_text", "\n", -1)).drop("_text")


def chunks(docs: DataFrame, key: str, text: str, mean_lines: int = MEAN_LINES) -> DataFrame:
    """_key, _print, place, first_line, n_lines and body of every chunk."""
    line_hash = F.transform("_lines", lambda s: F.conv(F.substring(F.md5(s), 1, 7), 16, 10).cast("long"))
    rows = _held(_lines(docs, key, text), "_hashes", line_hash)
    n = F.size("_lines")

    def starts_here(i: Column) -> Column:
        before = F.coalesce(F.get("_hashes", i - 3), F.lit(0))
        rolled = (before * FACTOR + F.get("_hashes", i - 2)) % MODULUS
        return rolled % mean_lines == 0

    inner = F.when(n >= 2, F.filter(F.sequence(F.lit(2), n), starts_here))
    rows = _held(rows, "_starts", F.concat(F.array(F.lit(1)), F.coalesce(inner, F.array().cast("array<int>"))))

    def chunk(start: Column, place: Column) -> Column:
        size = F.coalesce(F.get("_starts", place + 1), n + 1) - start
        return F.struct(
            place.alias("place"), start.alias("first_line"), size.alias("n_lines"),
            F.array_join(F.slice("_lines", start, size), "\n").alias("body"),
        )

    return rows.select("_key", "_print", F.explode(F.transform("_starts", chunk)).alias("c")).select("_key", "_print", "c.*")


def _words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def units(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """_key, _print, place, n_lines and digest (as body) of every two neighbouring lines and of every line over ``words``."""
    rows = _lines(docs, key, text)

    def unit(i: Column, n_lines: int) -> Column:
        lines = F.array_join(F.slice("_lines", i, n_lines), "\n")
        return F.struct(i.alias("place"), F.lit(n_lines).alias("n_lines"), F.unhex(F.sha2(lines, 256)).alias("body"))

    n = F.size("_lines")
    single = F.filter(F.sequence(F.lit(1), n), lambda i: _words(F.get("_lines", i - 1)) > words)
    double = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    each = F.concat(F.transform(single, lambda i: unit(i, 1)), F.transform(double, lambda i: unit(i, 2)))
    return rows.select("_key", "_print", F.explode(each).alias("u")).select("_key", "_print", "u.*")


def _later(found: DataFrame, name: str) -> DataFrame:
    """The rows of ``found`` whose body occurs at an earlier place."""
    hashed = found.withColumn("_hash", F.xxhash64("body"))
    # Stored, so that both sides of the join are plain exchanges, whose large keys Spark can split.
    counts = hashed.groupBy("_hash").agg(F.count("*").alias("_n"))
    repeated = stored(counts.filter("_n > 1").select("_hash"), f"{name}-hashes")
    candidates = stored(hashed.join(repeated, "_hash"), f"{name}-chunks")  # read twice, shuffled once
    at = F.struct("_key", "_print", "place")
    first = candidates.groupBy("_hash", "body").agg(F.min(at).alias("_first"), F.count("*").alias("_n"))
    # Equal hashes with other bytes fall apart here: the bodies themselves are joined.
    first = stored(first.filter("_n > 1").select("_hash", "body", "_first"), f"{name}-firsts")
    return candidates.join(first, ["_hash", "body"]).filter(at > F.col("_first"))


def repeated_lines(
    docs: DataFrame, key: str, text: str, *, min_lines: int = MIN_LINES, mean_lines: int = MEAN_LINES
) -> DataFrame:
    """_key, _print and the array of line numbers to remove, for documents that lose lines."""
    found = chunks(docs, key, text, mean_lines).filter((F.col("n_lines") >= min_lines) & F.col("body").rlike(r"[^ \n]"))
    lines = F.sequence("first_line", F.col("first_line") + F.col("n_lines") - 1)
    return _later(found, "line").groupBy("_key", "_print").agg(F.flatten(F.collect_set(lines)).alias("_removed"))


def repeated_passages(docs: DataFrame, key: str, text: str, words: int = PASSAGE_WORDS) -> DataFrame:
    """_key, _print and the array of line numbers to remove, for documents that hold passages of over ``words`` again."""
    later = _later(units(docs, key, text, words), "passage")
    places = [F.sort_array(F.collect_set(F.when(F.col("n_lines") == n, F.col("place")))).alias(c) for n, c in ((1, "_singles"), (2, "_pairs"))]
    found = later.groupBy("_key", "_print").agg(*places)
    rows = _lines(docs, key, text).alias("d").join(
        found.alias("f"), F.col("d._key").eqNullSafe(F.col("f._key")) & (F.col("d._print") == F.col("f._print"))
    ).select("d.*", "f._singles", "f._pairs").dropDuplicates(["_key", "_print"])
    rows = _held(rows, "_counts", F.transform("_lines", _words))

    def ends(step: int) -> Column:
        return F.filter("_pairs", lambda p, i: ~F.coalesce(F.get("_pairs", i + step) == p + step, F.lit(False)))

    runs = F.zip_with(ends(-1), ends(1), lambda a, b: F.sequence(a, b + 1))

    def long(run: Column) -> Column:
        counts = F.slice("_counts", F.get(run, F.lit(0)), F.size(run))
        return F.aggregate(counts, F.lit(0), lambda total, w: total + w) > words

    removed = F.array_distinct(F.concat("_singles", F.flatten(F.filter(runs, long))))
    return rows.select("_key", "_print", removed.alias("_removed")).filter(F.size("_removed") > 0)


def dedup_lines(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, mean_lines: int = MEAN_LINES,
    passage_words: int | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """key, n_lines, n_removed, and the kept lines as ``text``; plus the columns named in ``keep``."""
    removed = repeated_lines(docs, key, text, min_lines=min_lines, mean_lines=mean_lines)
    if passage_words is not None:
        both = removed.unionByName(repeated_passages(docs, key, text, passage_words))
        removed = both.groupBy("_key", "_print").agg(F.array_distinct(F.flatten(F.collect_list("_removed"))).alias("_removed"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(body).alias("_print"), body.alias("_text"), *keep)
    joined = rows.alias("d").join(
        removed.alias("r"), F.col("d._key").eqNullSafe(F.col("r._key")) & (F.col("d._print") == F.col("r._print")), "left"
    ).select("d._key", "d._text", "r._removed", *[F.col(f"d.{c}") for c in keep])
    lines = F.split("_text", "\n", -1)
    split = _held(joined, "_lines", F.when(F.col("_removed").isNotNull(), lines))
    left = F.array_except(F.sequence(F.lit(1), F.size("_lines")), "_removed")
    kept = F.array_join(F.transform(left, lambda i: F.get("_lines", i - 1)), "\n")
    n_lines = F.length("_text") - F.length(F.translate("_text", "\n", "")) + 1
    return split.select(
        F.col("_key").alias(key), n_lines.alias("n_lines"),
        F.coalesce(F.size("_removed"), F.lit(0)).alias("n_removed"),
        F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(kept).alias("text"), *keep,
    )
