"""Bottom-k sketches of word shingles: fingerprints that can be merged and compared.

The fingerprint of a text is the k smallest distinct hashes of its shingles of five words (a text
of fewer words is one shingle, one without words has none). Sketches of parts merge into the
sketch of the whole, up to the shingles that run across the cut. From sketches alone follow the
likeness of two texts, how far one is contained in the other, and the number of shingles.

Cases: a null text is an empty text, and two texts without words have likeness 1. Equal texts
have equal fingerprints. Long texts are sketched whole. Columns besides key and text are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.llm.common import pieces, text_bytes

K = 128
SHINGLE = 5
BITS = 48  # a kept hash has 12 hexadecimal digits
RUN_BYTES = 1 << 20
BLOCKS_PER_PARTITION = 4


def sketches_of(texts: pa.Array, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The k smallest distinct shingle hashes of each text, ascending."""
    data, bounds = text_bytes(texts)
    starts, ends, first = words.word_spans(data, bounds)
    hashes = words.word_hashes(data, starts, ends)
    runs = words.shingle_hashes(hashes, shingle) >> np.uint64(64 - BITS)
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin >= shingle:
            out.append(np.unique(runs[begin : end - shingle + 1])[:k])
        elif end > begin:
            out.append(words.shingle_hashes(hashes[begin:end], end - begin)[:1] >> np.uint64(64 - BITS))
        else:
            out.append(np.zeros(0, "uint64"))
    return out


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Resemblance of the sketched sets: the share of the k smallest of both that are in each."""
    if not len(a) and not len(b):
        return 1.0
    values, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    return float((counts[:k] == 2).sum() / min(k, len(values)))


def hex_of(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").view("uint8").reshape(-1, 8)[:, (64 - BITS) // 8 :].tobytes().hex()


def sketch(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """key and its sketch as an ascending array of longs. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", RUN_BYTES):
            found = [s.astype("int64") for s in sketches_of(batch.column("text"), k, shingle)]
            values = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), values], ["key", "sketch"])

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, sketch array<long>").withColumnRenamed("key", key)


def merge(sketches: DataFrame, group: str, *, column: str = "sketch", k: int = K) -> DataFrame:
    """Sketches of parts to one sketch per group; each task sends at most k values of a group."""
    values = sketches.select(group, F.explode_outer(column).alias("_value")).distinct()
    ranked = values.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(F.asc_nulls_last("_value"))))
    kept = ranked.filter(F.col("_rank") <= k)
    return kept.groupBy(group).agg(F.array_sort(F.collect_list("_value")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of two sketched sets."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (F.element_at(a, -1) / float(1 << BITS)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second has too."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    first = F.size(F.array_intersect(union, a))
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(a) == 0, 1.0).when(first == 0, 0.0).otherwise(both / first)


def _long_array(values: list) -> Column:
    return F.lit(np.array(values, dtype="int64")) if values else F.array().cast("array<long>")


def _count_up_to(value: Column, borders: list) -> Column:
    """How many of the ascending borders are at most ``value``: first in steps, then inside one."""
    step = max(1, int(len(borders) ** 0.5))
    coarse = F.size(F.filter(_long_array(borders[::step]), lambda b: b <= value))
    fine = F.slice(_long_array(borders), (coarse - 1) * step + 1, F.lit(step))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + F.size(F.filter(fine, lambda b: b <= value)))


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows in blocks, each block sorted by descending key and closed by the row that follows it.

    Columns block, ahead, key, text. The keys are cut into blocks at approximate quantiles; the
    first key of each block goes to the block before it too (from the first block to the last).
    What the driver holds are the block borders. Nulls come last; equal keys by their text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    n = BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    borders = sorted(set(rows.select("key").approxQuantile("key", [i / n for i in range(1, n)], 0.1 / n)))
    # Block 0 holds the largest keys; nulls share the last block with the smallest.
    below = _count_up_to(F.col("key"), borders)
    rows = rows.withColumn("block", F.when(F.col("key").isNull(), len(borders)).otherwise(len(borders) - below).cast("int"))
    heads = {r["block"]: r["head"] for r in rows.groupBy("block").agg(F.max("key").alias("head")).collect()}
    filled = sorted(heads)
    here = F.struct(F.col("block").alias("block"), F.lit(False).alias("ahead"))
    places = F.array(here)
    if filled:
        before = {b: filled[i - 1] for i, b in enumerate(filled)}
        target = F.get(_long_array([before.get(b, -1) for b in range(len(borders) + 1)]), F.col("block")).cast("int")
        head = F.get(_long_array([-1 if heads.get(b) is None else heads[b] for b in range(len(borders) + 1)]), F.col("block"))
        nulls = [b for b in filled if heads[b] is None]  # a block of null keys alone
        is_head = F.col("key").eqNullSafe(F.when(F.col("block").isin(nulls), F.lit(None)).otherwise(head))
        places = F.when(is_head, F.array(here, F.struct(target.alias("block"), F.lit(True).alias("ahead")))).otherwise(places)
    placed = rows.select(F.explode(places).alias("p"), "key", "text").select("p.block", "p.ahead", "key", "text")
    return placed.repartition("block").sortWithinPartitions("block", "ahead", F.desc_nulls_last("key"), "text")


def edit_likeness(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Fingerprint each text, and its edit whose last third comes from the start of the next text.

    Next is by descending key, from the last to the first again. The texts move in one shuffle.
    """
    schema = (
        f"{key} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in pieces(batches, "text", RUN_BYTES):
            rows = list(zip(batch.column("ahead").to_pylist(), batch.column("key").to_pylist(), batch.column("text").to_pylist()))
            rows = rows if held is None else [held, *rows]
            held = rows[-1]
            if len(rows) < 2:
                continue
            edited = []
            for (_, _, own), (_, _, following) in zip(rows, rows[1:]):
                m = len(own) // 3
                edited.append(own[: len(own) - m] + following[:m])
            plain = sketches_of(pa.array([r[2] for r in rows], pa.large_string()), k)
            other = sketches_of(pa.array(edited, pa.large_string()), k)
            out = [
                (
                    doc, len(own), hashlib.sha256(new.encode("utf-8")).hexdigest(), hex_of(plain[i]), hex_of(other[i]),
                    likeness(plain[i], other[i], k), likeness(plain[i], plain[i + 1], k),
                )
                for i, ((ahead, doc, own), new) in enumerate(zip(rows, edited))
                if not ahead
            ]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [c.split()[0] for c in schema.split(", ")])

    return with_next(docs, key, text).mapInArrow(run, schema)
