"""Benchmark decontamination by the q-gram lemma, diagonal bands and banded alignment.

Texts and items are compared in lower case with white space runs as one space, on UTF-8 bytes. An
item of m bytes may differ in e = floor(RATE * m) edits. An occurrence with so many edits shares
at least m + 1 - Q * (e + 1) of the item's q-grams with the text, all on diagonals (place in the
text less place in the item) that lie within e of each other. Shared q-grams are counted in bands
of diagonals, each overlapping the next by half, so that some band holds them all. Bands that
reach the bound are aligned, inside the band, to find the fewest edits of the whole item.

The items are the stated query set. They are read in blocks of about ``BLOCK_BYTES``; each block
is indexed, broadcast, and held against every text. Nothing is shuffled.

Cases: null or blank texts hold no item. Items of fewer than Q bytes after normalising are not
looked for, items too short for one edit must occur exactly. Items with a null id or text are left
out. Repeated rows are each reported; of several places of an item in one text the one with the
fewest edits, then the first, is. Long texts are searched whole. Columns besides key and text are
not looked at, or passed through by ``without_items``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import pieces

Q = 8  # bytes of a q-gram: it is read as one 64-bit number
RATE = 0.1
BLOCK_BYTES = 4 << 20
RUN_BYTES = 1 << 20
TABLE_BITS = 22
ALIGNED = 256  # candidates aligned at a time

_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - TABLE_BITS)


def normal(text: str) -> bytes:
    return " ".join(text.lower().split()).encode("utf-8")


def codes(data: bytes, offset: int) -> np.ndarray:
    """The q-grams at places offset, offset + Q, ... as numbers."""
    count = (len(data) - offset) // Q
    return np.frombuffer(data, "<u8", count=max(count, 0), offset=offset if count > 0 else 0)


@dataclass
class Index:
    """The q-grams of a block of items."""

    ids: list
    texts: list[bytes]
    size: np.ndarray
    edits: np.ndarray
    bound: np.ndarray
    grams: np.ndarray  # distinct, ascending
    first: np.ndarray  # where each one's places start
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray  # which hashes of q-grams occur


def index_of(items: Sequence[tuple[object, str]], rate: float = RATE) -> Index:
    kept = [(i, t) for i, t in ((i, normal(t)) for i, t in items) if len(t) >= Q]
    size = np.array([len(t) for _, t in kept], "int64")
    edits = np.minimum((rate * size).astype("int64"), np.maximum(size // Q - 1, 0))
    grams, item, place = [np.zeros(0, "uint64")], [np.zeros(0, "int64")], [np.zeros(0, "int64")]
    for n, (_, text) in enumerate(kept):
        for offset in range(min(Q, len(text) - Q + 1)):
            found = codes(text, offset)
            grams.append(found)
            item.append(np.full(len(found), n))
            place.append(offset + Q * np.arange(len(found)))
    gram = np.concatenate(grams)
    order = np.argsort(gram, kind="stable")
    distinct, first = np.unique(gram[order], return_index=True)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[(distinct * _SPREAD) >> _SHIFT] = True
    return Index(
        [i for i, _ in kept], [t for _, t in kept], size, edits, size + 1 - Q * (edits + 1), distinct,
        np.append(first, len(gram)), np.concatenate(item)[order], np.concatenate(place)[order], table,
    )


def shared_grams(data: bytes, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Item and diagonal of every q-gram that the data shares with an item."""
    at, which = [], []
    for offset in range(Q):
        gram = codes(data, offset)
        near = np.flatnonzero(index.table[(gram * _SPREAD) >> _SHIFT])
        slot = np.searchsorted(index.grams, gram[near])
        slot[slot == len(index.grams)] = 0
        same = index.grams[slot] == gram[near] if len(index.grams) else np.zeros(0, bool)
        at.append(near[same] * Q + offset)
        which.append(slot[same])
    at, which = np.concatenate(at), np.concatenate(which)
    n = index.first[which + 1] - index.first[which]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    posting = np.repeat(index.first[which], n) + within
    return index.item[posting], np.repeat(at, n) - index.place[posting]


def bands(item: np.ndarray, diagonal: np.ndarray, index: Index, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, first diagonal and count of each band that reaches its item's bound.

    Band b of an item with e edits covers diagonals from b * (e + 1) on, 2 * (e + 1) of them.
    """
    step = index.edits[item] + 1
    band = diagonal // step
    lowest = -int(index.size.max(initial=0)) - 2
    span = length - lowest + 2
    key = np.concatenate([item * span + band - lowest, item * span + band - 1 - lowest])
    key, count = np.unique(key, return_counts=True)
    item, band = key // span, key % span + lowest
    keep = count >= index.bound[item]
    return item[keep], band[keep] * (index.edits[item[keep]] + 1), count[keep]


def align(texts: list[bytes], item: np.ndarray, start: np.ndarray, width: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits between each whole item and the data, on the diagonals of its band; and the end.

    All candidates are aligned at once, a byte of the items at a time. No alignment takes a byte
    10, which stands between two texts and outside the data.
    """
    sizes = np.array([len(texts[i]) for i in item])
    most, wide = int(sizes.max()), int(width.max())
    pattern = np.zeros((len(item), most), "uint8")
    for row, i in enumerate(item):
        pattern[row, : sizes[row]] = np.frombuffer(texts[i], "uint8")
    offsets = np.arange(wide)
    outside = offsets[None, :] >= width[:, None]
    far = 1 << 30
    cost = np.where(outside, far, 0)
    best, end = np.full(len(item), far), np.zeros(len(item), "int64")
    for i in range(most):
        place = start[:, None] + i + offsets[None, :]
        inside = (place >= 0) & (place < len(data))
        letter = np.where(inside, data[np.where(inside, place, 0)], 10)
        border = letter == 10
        step = np.where(border, far, cost + (letter != pattern[:, i : i + 1]))
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)  # a byte of the item left out
        # Bytes of the text put in: the least cost so far on the same side of a border.
        side = offsets + 4 * far * np.cumsum(border, axis=1) if border.any() else offsets
        step = np.minimum.accumulate(step - side, axis=1) + side
        cost = np.where(outside, far, np.minimum(step, far))
        done = np.flatnonzero(sizes == i + 1)
        if len(done):
            at = cost[done].argmin(axis=1)
            best[done], end[done] = cost[done, at], start[done] + i + 1 + at
    return best, end


def search(texts: Sequence[str | None], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, end in the normalised text, shared q-grams) of the items found."""
    if not index.ids:
        return []
    whole = [normal(t or "") for t in texts]
    bounds = np.cumsum([0] + [len(t) + 1 for t in whole])
    data = b"\n".join(whole) + b"\n"
    array = np.frombuffer(data, "uint8")
    item, start, count = bands(*shared_grams(data, index), index, len(data))
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for a in range(0, len(item), ALIGNED):
        part, first, n = item[a : a + ALIGNED], start[a : a + ALIGNED], count[a : a + ALIGNED]
        edits, end = align(index.texts, part, first, 2 * (index.edits[part] + 1), array)
        for i, e, stop, shared in zip(part.tolist(), edits.tolist(), end.tolist(), n.tolist()):
            if e <= index.edits[i]:
                text = int(np.searchsorted(bounds, stop - 1, "right")) - 1
                key, value = (text, i), (e, int(stop - bounds[text]), shared)
                if value[:2] < found.get(key, (1 << 30,))[:2]:
                    found[key] = value
    return [(t, i, *v) for (t, i), v in sorted(found.items())]


def item_blocks(items: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items, one block of about ``block_bytes`` at a time."""
    rows = items.select(F.col(key).alias("i"), F.col(text).cast("string").alias("t")).dropna().distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).orderBy("i", "t").collect()]


def find_items(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", rate: float = RATE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row per document and item it holds: key, item, n_edits, match_end, shared_grams."""
    kinds = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    spark, out = docs.sparkSession, None
    for block in item_blocks(items, item_key, item_text, block_bytes):
        held = spark.sparkContext.broadcast(index_of(block, rate))

        def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text", RUN_BYTES):
                hits = search(batch.column("text").to_pylist(), held.value)
                if hits:
                    at, item, *rest = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("key").take(pa.array(at)), pa.array([held.value.ids[i] for i in item]), *map(pa.array, rest)],
                        ["key", "item", "n_edits", "match_end", "shared_grams"],
                    )

        part = rows.mapInArrow(run, f"key {kinds[0]}, item {kinds[1]}, n_edits long, match_end long, shared_grams long")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("key", key).withColumnRenamed("item", item_key)


def without_items(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    rate: float = RATE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents that hold no item, with all their columns. No shuffle."""
    for block in item_blocks(items, item_key, item_text, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(index_of(block, rate))

        def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, text, RUN_BYTES):
                bad = {h[0] for h in search(batch.column(text).to_pylist(), held.value)}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
