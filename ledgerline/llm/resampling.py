"""Quality selection by importance resampling with hashed n-gram models and Gumbel top-k.

Two bags of hashed words and word pairs are counted: one over target texts (labelled good), one
over all raw texts. A text's log weight adds up the log ratios of their smoothed probabilities over its
n-grams, brought to one length for all texts (``LENGTH`` n-grams, with ``PRIOR`` neutral n-grams
added to each text): else length alone would outweigh quality. A Gumbel draw is added to each
weight; the k largest sums are a sample without replacement in proportion to the weights.

How many to keep is set by the target itself: half of its rows, by a hash of the key, fit the
target model; all rows are kept whose sum reaches the one that the share ``KEEP`` of the other
half reach. (Rows that fit the model look better to it than unseen rows of their kind.)

Cases: a null text is an empty one, which has weight 0. Rows of one key share one draw, so
repeated rows are kept or rejected together; rows that tie with the last one kept are kept as
well. Without target rows nothing can be told apart and every row is kept. Null keys never match
a label. Columns besides those named are passed through where documents are returned, and are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import words
from ledgerline.llm.common import pieces, stored, text_bytes

BUCKETS = 10_000  # for words, and as many for word pairs
MAX_TARGET = 100_000  # labelled rows the target model is fitted on; their keys are broadcast
LENGTH = 200
PRIOR = 60
SMOOTHING = 5.0  # added to each bucket's target count, and to the count expected from the raw text
KEEP = 0.999  # share of the target rows that must be kept
SEED = 20_251
RUN_BYTES = 1 << 20
EXACT_ROWS = 100_000  # rows sorted at the border of a top-k


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words and of all pairs of neighbours, and the first word of each text."""
    data, bounds = text_bytes(texts)
    starts, ends, first = words.word_spans(data, bounds)
    hashes = words.word_hashes(data, starts, ends)
    single = (hashes % np.uint64(buckets)).astype("int64")
    pairs = (words.shingle_hashes(hashes, 2) % np.uint64(buckets)).astype("int64") + buckets
    return single, pairs, first


def _inner_pairs(n_pairs: int, first: np.ndarray) -> np.ndarray:
    """Which pairs lie inside one text."""
    inside = np.ones(n_pairs, bool)
    cut = first[1:-1] - 1
    inside[cut[(cut >= 0) & (cut < n_pairs)]] = False
    return inside


def target_keys(labels: DataFrame, good: Column | str, key: str, most: int = MAX_TARGET) -> DataFrame:
    """Keys of labelled target rows, ``most`` at most, picked by a hash; whether each fits the model."""
    keys = labels.filter(good).select(F.col(key).alias("key")).dropna().distinct()
    picked = keys.orderBy(F.xxhash64("key"), "key").limit(most)
    return picked.withColumn("fits", F.pmod(F.xxhash64(F.lit("fold"), "key"), F.lit(2)) == 0)


def log_ratios(docs: DataFrame, target: DataFrame, *, key: str, text: str, buckets: int = BUCKETS) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw), smoothed.

    Each task sends one row per bucket at most; the driver holds one number per bucket.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(2 * buckets, "int64"), np.zeros(2 * buckets, "int64")
        for batch in pieces(batches, "text", RUN_BYTES):
            single, pairs, first = features(batch.column("text"), buckets)
            inside = _inner_pairs(len(pairs), first)
            raw += np.bincount(single, minlength=2 * buckets) + np.bincount(pairs[inside], minlength=2 * buckets)
            flags = np.repeat(np.asarray(batch.column("good").to_pylist(), bool), np.diff(first))
            good += np.bincount(single[flags], minlength=2 * buckets)
            good += np.bincount(pairs[inside & flags[: len(pairs)]], minlength=2 * buckets)
        held = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(raw[held]), pa.array(good[held])], ["bucket", "raw", "good"])

    marked = docs.select(F.col(key).alias("key"), _text(text)).join(
        F.broadcast(target.filter("fits").withColumn("good", F.lit(True))), "key", "left"  # MAX_TARGET rows at most
    )
    counts = (
        marked.select("text", F.coalesce("good", F.lit(False)).alias("good"))
        .mapInArrow(count, "bucket long, raw long, good long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    )
    raw, good = np.zeros(2 * buckets), np.zeros(2 * buckets)
    for b, r, g in counts.collect():
        raw[b] += r
        good[b] += g
    expected = raw * (good.sum() / max(raw.sum(), 1.0))
    return np.log(good + SMOOTHING) - np.log(expected + SMOOTHING)


def _text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")


def gumbel(seed: int, key: Column) -> Column:
    """A standard Gumbel draw that depends on the key and the seed alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key.cast("string")), 11)
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def with_weights(docs: DataFrame, ratios: np.ndarray, *, key: str, text: str, seed: int = SEED) -> DataFrame:
    """``docs`` with log_weight, n_features and sample_key (log_weight plus its draw). No shuffle."""
    buckets = len(ratios) // 2
    held = docs.sparkSession.sparkContext.broadcast(ratios)  # two numbers per bucket
    at = docs.columns.index(text)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = held.value
        for batch in pieces(batches, text, RUN_BYTES):
            values = batch.column(at)
            single, pairs, first = features(values, buckets)
            by_word = ratios[single]
            inner = _inner_pairs(len(pairs), first)
            by_word[: len(pairs)] += np.where(inner, ratios[pairs], 0.0)
            sizes = np.diff(first)
            # Summed text by text, so that a text's weight does not depend on its neighbours.
            sums = np.array([by_word[a:b].sum() for a, b in zip(first[:-1].tolist(), first[1:].tolist())])
            n = np.maximum(2 * sizes - 1, 0)
            weights = LENGTH * sums / (n + PRIOR)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(weights, pa.float64()), pa.array(n, pa.int64())],
                [*batch.schema.names, "log_weight", "n_features"],
            )

    extra = [T.StructField("log_weight", T.DoubleType()), T.StructField("n_features", T.LongType())]
    schema = T.StructType([*docs.schema.fields, *extra])
    scored = docs.mapInArrow(score, schema)
    return scored.withColumn("sample_key", F.col("log_weight") + gumbel(seed, F.col(key)))


def keep_border(keys: DataFrame, target: DataFrame, key: str, keep: float = KEEP) -> float:
    """The sample key that the share ``keep`` of the target rows left aside reach; -inf without any."""
    aside = F.broadcast(target.filter("NOT fits"))
    of_target = keys.select(F.col(key).alias("key"), "sample_key").join(aside, "key", "left_semi")
    found = of_target.agg(F.percentile("sample_key", F.lit(1.0 - keep))).first()[0]
    return float("-inf") if found is None else found


def top_k(keys: DataFrame, k: int, *, score: str = "sample_key", tie: str = "doc_id", bins: int = 1000) -> DataFrame:
    """The k rows of the largest scores, equal scores by the smaller key.

    The border is narrowed by counting rows per bin of its range until few rows are left in it;
    only those are sorted. NaN and null scores are never taken.
    """
    keys = keys.filter(F.col(score).isNotNull() & ~F.isnan(score))
    low, high, n = keys.agg(F.min(score), F.max(score), F.count("*")).first()
    if k >= n:
        return keys
    if k <= 0:
        return keys.limit(0)
    above, inside = 0, n  # rows over the range, and in it
    while inside > EXACT_ROWS and low < high:
        width = (high - low) / bins
        if width == 0 or low + width == low:
            break
        bin_of = F.least(F.floor((F.col(score) - low) / width), F.lit(bins - 1)).cast("int")
        counts = dict(keys.filter(F.col(score).between(low, high)).groupBy(bin_of.alias("b")).count().collect())
        b = bins - 1
        while above + counts.get(b, 0) < k:
            above += counts.get(b, 0)
            b -= 1
        edges = keys.filter(F.col(score).between(low, high) & (bin_of == b)).agg(F.min(score), F.max(score)).first()
        if (low, high) == tuple(edges):
            break
        (low, high), inside = edges, counts[b]
    border = keys.filter(F.col(score).between(low, high)).orderBy(F.desc(score), tie).limit(k - above)
    return keys.filter(F.col(score) > high).unionByName(border)


def resample(
    docs: DataFrame, labels: DataFrame, good: Column | str, *, key: str = "doc_id", text: str = "text",
    buckets: int = BUCKETS, most: int = MAX_TARGET, keep: float = KEEP, seed: int = SEED,
) -> DataFrame:
    """The documents kept: all columns of ``docs`` with log_weight, n_features and sample_key."""
    target = stored(target_keys(labels, good, key, most), "resampling-target")
    ratios = log_ratios(docs, target, key=key, text=text, buckets=buckets)
    # The texts are scored twice rather than shuffled or stored: once for the border, once for the result.
    keys = stored(with_weights(docs.select(key, text), ratios, key=key, text=text, seed=seed).select(key, "sample_key"), "resampling-keys")
    border = keep_border(keys, target, key, keep)
    scored = with_weights(docs, ratios, key=key, text=text, seed=seed)
    return scored.filter(F.col("sample_key") >= border)
