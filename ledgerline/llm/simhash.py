"""SimHash near-duplicates: fingerprints of word shingles, linked at few differing bits.

Two fingerprints that differ in three bits or fewer differ in one bit at most in one of two
halves. So each fingerprint is indexed under the 64 variants of its halves with one bit left
out; equal variants are candidates and are verified on all 64 bits. Variants of half a
fingerprint that too many fingerprints share are refined in the same way, by the two quarters of
the other half.

Rows with one fingerprint are one node. Inside a group of equal variants the links are searched
block by block and only a spanning forest of them is returned, so a group of n near copies gives
n - 1 links, not all its pairs, and no connection is lost.

Cases: a null text has no words; texts without words have fingerprint zero, which is linked like
any other. A text of fewer words than a shingle is one shingle. Rows with a null key get a
component like others, but never name one, unless all rows of it have null keys. Columns besides
key and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import pieces, stored
from ledgerline.llm.components import components

SHINGLE = 3
HASH_SEED = 42
DISTANCE = 3  # the scheme of halves and quarters holds for up to three bits
GROUP = 20_000  # fingerprints under one variant of a half, from which it is refined
SMALL_GROUP = 8
RUN_BYTES = 1 << 20
MAX_BROADCAST = 100_000

_ONES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, n: int = SHINGLE) -> list[int]:
    """XXH64 of every run of n words, A-Z lower-cased and joined by single spaces."""
    found = text.lower().split()
    joined, h = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) < n:
        return [h(joined, HASH_SEED)] if found else []
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate([[0], ends[:-1]])
    return [h(joined[a:b], HASH_SEED) for a, b in zip(starts[: len(found) - n + 1].tolist(), (ends[n - 1 :] - 1).tolist())]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For consecutive runs of ``sizes`` hashes, the bits set in over half of each; 0 for empty runs.

    Bits are counted eight at a time, as the bytes of sums over at most 255 hashes.
    """
    out = np.zeros(len(sizes), "uint64")
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    size = sizes[full]
    blocks = -(-size // 255)
    first_block = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    within = np.arange(blocks.sum()) - np.repeat(first_block, blocks)
    at = np.repeat(starts, blocks) + 255 * within
    bits = np.zeros(len(full), "uint64")
    for b in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(b)) & _ONES, at)
        by_byte = np.add.reduceat(sums.view("uint8").reshape(-1, 8).astype("int64"), first_block, axis=0)
        for byte in range(8):
            bits |= (2 * by_byte[:, byte] > size).astype("uint64") << np.uint64(8 * byte + b)
    out[full] = bits
    return out


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """key, a hash of the text, and the fingerprint as a long. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", RUN_BYTES):
            each = [shingle_hashes(t, shingle) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            sizes = np.array([len(x) for x in each], "int64")
            flat = np.fromiter((h for x in each for h in x), "uint64", count=int(sizes.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("print"), pa.array(majority_bits(flat, sizes).view("int64"))],
                ["key", "print", "fp"],
            )

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("key"), _print(text).alias("print"), body.alias("text"))
    return rows.mapInArrow(run, "key long, print long, fp long").withColumnRenamed("key", key)


def _print(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _half(fp: Column, high: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if high else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _variants(part: Column, bits: int, tag: int) -> list[Column]:
    """The part with each of its bits left out, marked by which bit of which part that is."""
    whole = (1 << bits) - 1
    return [part.bitwiseAND(F.lit(whole & ~(1 << i))) + F.lit((tag + i) << bits) for i in range(bits)]


def variants(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """(variant, half, fp): equal variants are candidates; ``half`` is -1 for refined ones."""
    halves = [F.struct(F.lit(h).alias("half"), v.alias("variant")) for h in (0, 1) for v in _variants(_half(F.col("fp"), h), 32, 32 * h)]
    rows = fps.select("fp", F.explode(F.array(*halves)).alias("k")).select("k.variant", "k.half", "fp")
    # A variant joins two values of its half; it can be large only if one of them is frequent.
    values = fps.select(F.explode(F.array(*[F.struct(F.lit(h).alias("half"), _half(F.col("fp"), h).alias("value")) for h in (0, 1)])).alias("v"))
    often = values.groupBy("v.half", "v.value").count().filter(F.col("count") > group // 2)
    hot = stored(
        often.select(F.explode(F.when(F.col("half") == 0, F.array(*_variants(F.col("value"), 32, 0)))
                               .otherwise(F.array(*_variants(F.col("value"), 32, 32)))).alias("variant")).distinct(),
        "simhash-hot",
    )
    n = hot.count()
    if n == 0:
        return rows
    mark = hot.withColumn("hot", F.lit(True))
    marked = rows.join(F.broadcast(mark) if n <= MAX_BROADCAST else mark, "variant", "left")
    quarters = []
    for other in (0, 1):
        for q in (0, 1):
            part = F.shiftrightunsigned(_half(F.col("fp"), other), 16 * q).bitwiseAND(F.lit(0xFFFF))
            quarters.append((other, _variants(part, 16, 16 * q)))
    refined = F.when(F.col("half") == 0, F.array(*[v for o, vs in quarters if o == 1 for v in vs])).otherwise(
        F.array(*[v for o, vs in quarters if o == 0 for v in vs])
    )
    split = marked.filter("hot").select("variant", "fp", F.explode(refined).alias("q"))
    return marked.filter("hot IS NULL").select("variant", "half", "fp").unionByName(
        split.select(F.xxhash64("variant", "q").alias("variant"), F.lit(-1).alias("half"), "fp")
    )


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The one variant, of all that two fingerprints share, under which their link is returned."""
    x = a ^ b
    low, high = x & np.uint64(0xFFFFFFFF), x >> np.uint64(32)
    use_low = np.bitwise_count(low) <= 1
    part = np.where(use_low, low, high)
    bit = np.bitwise_count(np.where(part == 0, 1, part).astype("uint64") - np.uint64(1)).astype("uint64")
    value = np.where(use_low, a & np.uint64(0xFFFFFFFF), a >> np.uint64(32))
    kept = value & ~(np.uint64(1) << bit)
    return kept + ((bit + np.where(use_low, 0, 32).astype("uint64")) << np.uint64(32))


def forest(members: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints."""
    left, links = members, []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop(0)
            near = np.bitwise_count(left ^ node) <= distance
            found, left = left[near], left[~near]
            links += [(int(f), int(node)) for f in found]
            queue += list(found)
    return links


def links(fps: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """(u, v): links between distinct fingerprints that keep their components connected."""
    if not 0 <= distance <= 3:
        raise ValueError("halves with one bit left out find up to three differing bits")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0, "uint64"))

        def found(key: np.ndarray, half: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.diff(key)) + 1
            starts, sizes = np.concatenate([[0], cut]), np.diff(np.concatenate([[0], cut, [len(key)]]))
            u, v = [], []
            small = np.repeat((sizes <= SMALL_GROUP) & (sizes > 1), sizes)
            k, h, f = key[small], half[small], fp[small]
            for step in range(1, SMALL_GROUP):
                if len(k) <= step:
                    break
                same = np.flatnonzero(k[step:] == k[:-step])
                a, b = f[same], f[same + step]
                near = (a != b) & (np.bitwise_count(a ^ b) <= distance)
                a, b, at = a[near], b[near], same[near]
                once = (h[at] < 0) | (_first_shared(a, b) == k[at].astype("uint64"))
                u.append(a[once].view("int64"))
                v.append(b[once].view("int64"))
            for i in np.flatnonzero(sizes > SMALL_GROUP).tolist():
                edges = forest(np.unique(fp[starts[i] : starts[i] + sizes[i]]), distance)
                if edges:
                    pair = np.array(edges, "uint64").view("int64").reshape(-1, 2)
                    u.append(pair[:, 0])
                    v.append(pair[:, 1])
            none = np.zeros(0, "int64")
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *x])) for x in (u, v)], ["u", "v"])

        for batch in batches:
            new = (
                batch.column("variant").to_numpy(), batch.column("half").to_numpy().astype("int64"),
                batch.column("fp").to_numpy().view("uint64"),
            )
            key, half, fp = (np.concatenate(x) for x in zip(held, new))
            if not len(key):
                continue
            last = np.searchsorted(key, key[-1])  # the last group may go on in the next batch
            held = key[last:], half[last:], fp[last:]
            if last:
                yield found(key[:last], half[:last], fp[:last])
        if len(held[0]):
            yield found(*held)

    keyed = variants(fps, group).repartition("variant").sortWithinPartitions("variant")
    return keyed.mapInArrow(search, "u long, v long").filter("u <> v")


def _linked(docs: DataFrame, key: str, text: str, shingle: int, distance: int, group: int) -> tuple[DataFrame, DataFrame]:
    """The stored rows (key, print, fp), and (fp, root) of every fingerprint."""
    rows = stored(fingerprints(docs, key=key, text=text, shingle=shingle), "simhash-rows")
    nodes = stored(rows.select("fp").distinct(), "simhash-nodes")
    roots = components(links(nodes, distance, group), "simhash-components")
    placed = nodes.join(roots.withColumnRenamed("u", "fp"), "fp", "left")
    return rows, placed.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE,
    group: int = GROUP,
) -> DataFrame:
    """key, fingerprint (16 hexadecimal digits) and component_id, the smallest key linked to it."""
    rows, roots = _linked(docs, key, text, shingle, distance, group)
    placed = rows.groupBy("fp").agg(F.min(key).alias("least")).join(roots, "fp")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = roots.join(least, "root").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(of_fp, "fp").select(key, hexed.alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE,
    group: int = GROUP,
) -> DataFrame:
    """The documents that stay when of each component only the smallest key does; all columns.

    A row without a key stays only when no row of its component has one. Rows of one key are told
    apart by a hash of their text; of rows that repeat key and text one stays.
    """
    rows, roots = _linked(docs, key, text, shingle, distance, group)
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("print"))
    each = rows.groupBy("fp", key, "print").agg(F.count("*").alias("n"))
    first = each.groupBy("fp").agg(F.min(F.struct(place.alias("place"), "n")).alias("first")).join(roots, "fp")
    stay = first.groupBy("root").agg(F.min("first").alias("f"))
    stay = stored(stay.select(F.col("f.place.key").alias("_key"), F.col("f.place.print").alias("_print"), F.col("f.n").alias("_n")), "simhash-stay")
    printed = docs.withColumn("_print", _print(text))
    same = F.col(f"d.{key}").cast("long").eqNullSafe(F.col("s._key")) & (F.col("d._print") == F.col("s._print"))
    kept = printed.alias("d").join(stay.alias("s"), same).select("d.*", "s._n")
    if stay.filter("_n > 1").limit(1).count():
        kept = kept.filter("_n = 1").unionByName(kept.filter("_n > 1").dropDuplicates([key, "_print"]))
    return kept.select(*docs.columns)
