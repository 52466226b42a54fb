"""Hard negatives by rotated one-bit codes with residual intervals.

Every component x of a vector becomes floor(256 x); a row's score is its integer inner product with
the anchor. A vector v is rotated, and of the rotated vector only the signs are kept, as a unit
vector c, with the alignment a = <v, c> and the length of what is left, r = v - a c. For an anchor q

    <v, q> = a <c, q> + <r, q>,    |<r, q>| <= |r| sqrt(|q|^2 - <c, q>^2)

since r is orthogonal to c. <c, q> comes from popcounts of the code with the bit planes of the
anchor, rounded to a few bits; what rounding left out widens the interval by its own length. The
interval is therefore certain, not probable: a row whose interval ends below the worst row still
wanted, or outside the range of scores asked for, is dropped; all others are scored in integers.

Rows are packed in blocks once and stored. The anchors are split in groups, the blocks in ranges,
and each task holds one group and one range; a task hands on its best few rows of each anchor, which
are then ranked. Groups and ranges follow a row's number, so no label or id is a hot key.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part. A
shorter vector counts as one with zeros at its end, an empty one as zeros. Scaled components beyond
+-2**26 are taken as that. Repeated rows are rows of their own, also for the anchor of the same id;
equal scores go by id, nulls last. A null id is never an anchor. An anchor without positives, or
without rows in its range of scores, gives no rows. Columns besides id, vector and label are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.llm.common import offsets, stored

SCALE = 256
LARGEST = 1 << 26
PLANE_BITS = 4  # an anchor's rotated components are rounded to so many bits
GROUP = 512  # anchors of a task, about
RANGE = 1 << 15  # rows of a task, about
CHUNK = 2048  # rows compared with a task's anchors at a time
SCORED = 1 << 16  # pairs scored at a time
NO_ID = (1 << 63) - 1

BLOCK = "block long, id binary, row binary, label binary, vector binary, code binary, align binary, rest binary"


def rotated(vectors: np.ndarray, width: int) -> np.ndarray:
    """The rows, padded to ``width`` (a power of two), under a fixed orthogonal map.

    Three rounds of sign changes and a Hadamard transform; the same on every machine.
    """
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    for turn in range(1, 4):
        out *= 1.0 - 2.0 * (words.mix(np.arange(width, dtype="uint64") + words.U(turn << 32)) & words.U(1)).astype("float64")
        half = 1
        while half < width:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), width)
            half *= 2
        out /= np.sqrt(width)
    return out


def packed_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view("uint64")


def width_of(dimension: int) -> int:
    width = 64
    while width < dimension:
        width *= 2
    return width


@dataclass
class Codes:
    """Rows with their one-bit codes."""

    id: np.ndarray
    row: np.ndarray
    label: np.ndarray
    vector: np.ndarray  # integers, one row each
    code: np.ndarray
    align: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Codes:
        width = width_of(vectors.shape[1])
        turned = rotated(vectors, width)
        align = np.abs(turned).sum(1) / np.sqrt(width)
        rest = np.sqrt(np.maximum((vectors.astype("float64") ** 2).sum(1) - align**2, 0))
        return cls(ids, rows, labels, vectors, packed_bits(turned > 0), align, rest)

    @classmethod
    def read(cls, batch: pa.Table, dimension: int) -> Codes:
        """The rows of packed blocks, end to end."""
        def values(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind)

        ids = values("id", "int64")
        return cls(
            ids, values("row", "int64"), values("label", "int64"), values("vector", "int32").reshape(len(ids), dimension),
            values("code", "uint64").reshape(len(ids), -1), values("align", "float64"), values("rest", "float64"),
        )

    def cut(self, start: int, end: int) -> Codes:
        return Codes(*(getattr(self, name)[start:end] for name in self.__dataclass_fields__))

    def packed(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name)).tobytes() for name in self.__dataclass_fields__}


class Queries:
    """Anchors, their bit planes, and intervals for the scores of rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.id, self.row, self.label, self.vector = ids, rows, labels, vectors
        self.width = width_of(vectors.shape[1])
        turned = rotated(vectors, self.width)
        self.square = (vectors.astype("float64") ** 2).sum(1)
        self.least = turned.min(1, initial=0)
        self.step = np.maximum((turned.max(1, initial=0) - self.least) / ((1 << PLANE_BITS) - 1), 1e-300)
        level = np.rint((turned - self.least[:, None]) / self.step[:, None]).clip(0, (1 << PLANE_BITS) - 1).astype("uint8")
        self.error = np.sqrt(((turned - self.least[:, None] - level * self.step[:, None]) ** 2).sum(1))
        self.planes = [packed_bits((level >> b) & 1 == 1) for b in range(PLANE_BITS)]
        self.total = level.sum(1, dtype="int64")

    def intervals(self, rows: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score that every row can have with every anchor."""
        above = np.zeros((len(self.id), len(rows.id)), "int64")  # sum of levels where the code has a one
        for bit, plane in enumerate(self.planes):
            for word in range(plane.shape[1]):
                above += np.bitwise_count(plane[:, word, None] & rows.code[None, :, word]).astype("int64") << bit
        ones = np.bitwise_count(rows.code).sum(1, dtype="int64")
        shared = self.step[:, None] * (2 * above - self.total[:, None]) + self.least[:, None] * (2 * ones - self.width)[None, :]
        shared /= np.sqrt(self.width)
        sure = np.maximum(np.abs(shared) - self.error[:, None], 0)
        wide = rows.rest[None, :] * np.sqrt(np.maximum(self.square[:, None] - sure**2, 0)) + rows.align[None, :] * self.error[:, None]
        length = np.sqrt(rows.align**2 + rows.rest**2)
        wide += 1e-6 + 1e-9 * np.sqrt(self.square)[:, None] * length[None, :]  # rounding of floats
        middle = rows.align[None, :] * shared
        return middle - wide, middle + wide

    def scores(self, anchor: np.ndarray, rows: Codes, row: np.ndarray) -> np.ndarray:
        """Integer inner products of pairs."""
        out = np.zeros(len(anchor), "int64")
        for i in range(0, len(anchor), SCORED):
            a, b = self.vector[anchor[i : i + SCORED]].astype("int64"), rows.vector[row[i : i + SCORED]].astype("int64")
            out[i : i + SCORED] = np.einsum("ij,ij->i", a, b)
        return out


class Best:
    """The first ``k`` rows of every target so far: higher scores first, then lower ids, then rows."""

    def __init__(self, targets: int, k: int):
        self.k, self.floor = k, np.full(targets, -np.inf)
        self.target, self.score, self.id, self.row = (np.zeros(0, "int64") for _ in range(4))

    def add(self, target: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        held = [np.concatenate(p) for p in ((self.target, target), (self.score, score), (self.id, ids), (self.row, rows))]
        order = np.lexsort((held[3], held[2], -held[1], held[0]))
        target = held[0][order]
        first = np.searchsorted(target, target)
        keep = order[np.arange(len(order)) - first < self.k]
        self.target, self.score, self.id, self.row = (h[keep] for h in held)
        count = np.bincount(self.target, minlength=len(self.floor))
        full = np.flatnonzero(count >= self.k)
        self.floor[full] = self.score[np.cumsum(count)[full] - 1]


def nearest(queries: Queries, rows: Codes, k: int) -> Best:
    """The first ``k`` other rows of each anchor's label."""
    best = Best(len(queries.id), k)
    for start in range(0, len(rows.id), CHUNK):
        part = rows.cut(start, start + CHUNK)
        low, high = queries.intervals(part)
        other = (queries.label[:, None] != part.label[None, :]) | (queries.row[:, None] == part.row[None, :])
        low[other] = high[other] = -np.inf
        floor = best.floor
        if len(part.id) > k:
            floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])  # k rows reach this for certain
        anchor, row = np.nonzero((high >= floor[:, None]) & ~other)
        best.add(anchor, queries.scores(anchor, part, row), part.id[row], part.row[row])
    return best


def window(positive: np.ndarray, lower: int, upper: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last score s with lower * p <= 100 * s <= upper * p."""
    return -((-lower * positive) // 100), (upper * positive) // 100


def in_windows(queries: Queries, rows: Codes, anchor: np.ndarray, positive: np.ndarray, k: int, shares: tuple[int, int]) -> Best:
    """The first ``k`` rows of other labels for each target: an anchor's place and a positive's score."""
    best, (first, last) = Best(len(anchor), k), window(positive, *shares)
    order = np.argsort(anchor, kind="stable")
    turn = np.zeros(len(anchor), "int64")  # which of its anchor's targets a target is
    turn[order] = np.arange(len(order)) - np.searchsorted(anchor[order], anchor[order])
    for start in range(0, len(rows.id), CHUNK):
        part = rows.cut(start, start + CHUNK)
        low, high = queries.intervals(part)
        wanted = np.zeros(low.shape, bool)
        for t in range(int(turn.max(initial=-1)) + 1):
            of = np.flatnonzero(turn == t)
            wanted[anchor[of]] |= (high[anchor[of]] >= np.maximum(first[of], best.floor[of])[:, None]) & (low[anchor[of]] <= last[of][:, None])
        wanted &= queries.label[:, None] != part.label[None, :]
        left, row = np.nonzero(wanted)
        score = queries.scores(left, part, row)
        for t in range(int(turn.max(initial=-1)) + 1):
            target = np.full(len(queries.id), -1)
            target[anchor[turn == t]] = np.flatnonzero(turn == t)
            mine = target[left]
            fits = (mine >= 0) & (score >= first[mine]) & (score <= last[mine])
            best.add(mine[fits], score[fits], part.id[row[fits]], part.row[row[fits]])
    return best


def part_in(rows: DataFrame) -> DataFrame:
    """Rows that take part, numbered and stored: (row, id, label, vector)."""
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter("label IS NOT NULL AND vector IS NOT NULL").filter(~odd)
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "vector"), "negatives-rows")


def integers(lists: pa.Array, dimension: int) -> np.ndarray:
    """Vectors scaled and cut to whole numbers, short ones padded with zeros."""
    sizes = np.diff(offsets_of(lists))
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype("float64")).clip(-LARGEST, LARGEST)
    out = np.zeros((len(lists), dimension), "int32")
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(lists)), sizes), at] = flat
    return out


def offsets_of(lists: pa.Array) -> np.ndarray:
    return lists.offsets.to_numpy().astype("int64")


def packed(rows: DataFrame, dimension: int) -> DataFrame:
    """Stored blocks of rows with their codes; a block is one Arrow batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
                codes = Codes.of(batch.column("id").fill_null(NO_ID).to_numpy(), row, label, integers(batch.column("vector"), dimension))
                yield pa.RecordBatch.from_pylist([{"block": int(row[0]), **codes.packed()}], schema=kind)

    fields = [("block", pa.int64())] + [(name, pa.binary()) for name in Codes.__dataclass_fields__]
    kind = pa.schema(fields)
    return stored(rows.select("row", "id", F.col("label").cast("long").alias("label"), "vector").mapInArrow(run, BLOCK), "negatives-blocks")


def _spread(df: DataFrame, by: str, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
    """Each row in its group or range, once for every range or group."""
    return df.withColumn(own, F.pmod(F.xxhash64(by), F.lit(own_n))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_n - 1).cast("long"))))


def _first(df: DataFrame, by: list[str], score: str, ids: str, row: str, k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(ids), F.asc(row))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def mine(
    rows: DataFrame, anchors: str, *, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 10, shares: tuple[int, int] = (30, 90), group: int = GROUP, range_rows: int = RANGE,
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels whose score is ``shares`` per cent of the positive's.

    ``anchors`` is a SQL condition on the column ``id``; ``label`` a column or a SQL expression.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    valid = part_in(rows.select(F.col(id).cast("long").alias("id"), F.expr(label).alias("label"), F.col(vector).alias("vector")))
    is_anchor = F.coalesce(F.expr(anchors), F.lit(False))
    chosen = valid.filter(is_anchor)
    size = valid.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0)), F.count_if(is_anchor)).first()
    n_rows, dimension, n_anchors = size[0], max(size[1], 1), size[2]
    n_ranges, n_groups = -(-max(n_rows, 1) // range_rows), -(-max(n_anchors, 1) // group)
    blocks = _spread(packed(valid, dimension), "block", "range", n_ranges, "group", n_groups)

    def compared(left: DataFrame, run, schema: str) -> DataFrame:
        spread = _spread(left, "row", "group", n_groups, "range", n_ranges)
        return spread.groupBy("group", "range").cogroup(blocks.groupBy("group", "range")).applyInArrow(run, schema)

    def queries(table: pa.Table) -> Queries:
        table = table.combine_chunks()
        lists = table.column("vector").chunk(0)
        return Queries(*(table.column(c).to_numpy().astype("int64") for c in ("id", "row", "label")), integers(lists, dimension))

    def same(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.Table.from_pylist([], near)
        asked = queries(left)
        best = nearest(asked, Codes.read(right, dimension), positives)
        return pa.table([asked.row[best.target], best.id, best.row, best.score], near)

    def other(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.Table.from_pylist([], far)
        asked, lists = queries(left), left.combine_chunks().column("positives").chunk(0)
        anchor = np.repeat(np.arange(left.num_rows), np.diff(offsets_of(lists)))
        flat = lists.flatten()
        score, place = flat.field("positive_score").to_numpy(), flat.field("place").to_numpy().astype("int64")
        best = in_windows(asked, Codes.read(right, dimension), anchor, score, negatives, shares)
        return pa.table([asked.row[anchor[best.target]], place[best.target], best.id, best.row, best.score], far)

    near = pa.schema([(c, pa.int64()) for c in ("anchor", "positive_id", "positive", "positive_score")])
    found = compared(chosen, same, "anchor long, positive_id long, positive long, positive_score long")
    found = stored(_first(found, ["anchor"], "positive_score", "positive_id", "positive", positives, "place"), "negatives-positives")
    lists = found.groupBy("anchor").agg(F.collect_list(F.struct("place", "positive_score")).alias("positives"))
    far = pa.schema([(c, pa.int64()) for c in ("anchor", "place", "negative_id", "negative", "negative_score")])
    asked = chosen.join(lists, chosen["row"] == lists["anchor"]).select("row", "id", "label", "vector", "positives")
    mined = compared(asked, other, "anchor long, place long, negative_id long, negative long, negative_score long")
    ranked = _first(mined, ["anchor", "place"], "negative_score", "negative_id", "negative", negatives, "rank")
    known = found.join(chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")

    def named(column: str) -> Column:
        return F.when(F.col(column) != NO_ID, F.col(column)).alias(column)

    return ranked.join(known, ["anchor", "place"]).select(
        "anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score"
    )
