"""Repeated windows in a corpus: what suffix buckets and prefix trees have in common.

A window is L consecutive units (bytes or words) of one document. Of the runs of q units inside a
window, the one with the smallest hash is its anchor, so equal windows have equal anchors at equal
places. Windows of one document that share an anchor place lie next to each other; together they
cover the anchor's context. Far fewer anchors than windows move through the shuffle:

1. anchors are counted by the hash of their run; only runs that occur twice matter;
2. those anchors are grouped by run and context: windows in equal contexts all repeat;
3. where a run stands in several contexts, one copy of each context is fetched, and the operator
   compares their windows group by group, a group being the contexts of one run.

A group of more than ``group`` contexts is not put in one task: its windows are aggregated by two
64-bit hashes instead. Counts are aggregated before the shuffle and joined back; the adaptive join
splits runs that very many documents share.

A document is named by its key and a 64-bit hash of its text, so that rows of one key with other
texts stay apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.llm.common import pieces, stored, text_bytes

GROUP = 50_000  # contexts of one run that are compared in one task
RUN_BYTES = 1 << 20
CHUNK = 3000  # contexts compared at a time, or one larger group
PLACE_BITS = 31
U = np.uint64

ROW = "h long, c long, doc long, pack long, mark long"
CONTENT = "h long, n long, n_contexts long, doc long, pack long, mark long, content binary"
SPAN = "doc long, mark long, first int, last int"


@dataclass(frozen=True)
class Scheme:
    """What a window is made of, its length L and the length q of an anchor's run."""

    units: str  # bytes or words
    length: int
    run: int

    def values(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A number per unit, and where each text's units start (one more at the end)."""
        data, bounds = text_bytes(texts)
        if self.units == "bytes":
            return words.byte_values(data), bounds
        starts, ends, first = words.word_spans(data, bounds)
        return words.word_hashes(data, starts, ends), first


@dataclass
class Anchors:
    text: np.ndarray
    place: np.ndarray  # of the run, in the data
    low: np.ndarray  # first and last start of its windows, in the data
    high: np.ndarray
    run: np.ndarray
    context: np.ndarray


def anchors(values: np.ndarray, bounds: np.ndarray, scheme: Scheme) -> Anchors:
    """The anchors of all windows of all texts."""
    n, length, q = len(values), scheme.length, scheme.run
    sums = words.prefix_sums(values)
    none = np.zeros(0, "int64")
    if n < length:
        return Anchors(none, none, none, none, none.view("uint64"), none.view("uint64"))
    at = np.arange(n - q + 1)
    runs = words.run_hashes(sums, at, at + q)
    # The place in the low bits settles ties by the leftmost run, in equal windows alike.
    least = (runs & ~U((1 << PLACE_BITS) - 1)) | at.astype("uint64")
    span, wide = 1, length - q + 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
    anchor = (least & U((1 << PLACE_BITS) - 1)).astype("int64")
    sizes = np.diff(bounds)
    long = sizes >= length
    change = np.zeros(len(anchor) + 1, "int8")
    np.add.at(change, bounds[:-1][long], 1)
    np.add.at(change, bounds[:-1][long] + sizes[long] - length + 1, -1)
    valid = np.cumsum(change[:-1], dtype="int8") > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    end = valid.copy()
    end[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    low, high = np.flatnonzero(new), np.flatnonzero(end)
    place = anchor[low]
    text = np.searchsorted(bounds, low, "right") - 1
    shape = ((place - low) * 256 + (place - high)).astype("uint64") * U(0xD6E8FEB86659FD93)
    context = words.mix(words.run_hashes(sums, low, high + length) + shape)
    return Anchors(text, place, low, high, runs[place], context)


def pack_of(place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Place of a run in its text, and how far its windows' starts lie before it."""
    return (place << 32) | (left << 8) | right


def unpack(pack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start in the text."""
    place = pack >> 32
    return place - ((pack >> 8) & 0xFF), place - (pack & 0xFF)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(body).alias("mark"), body.alias("text"))


def anchor_rows(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """(h, c, doc, pack, mark): run, context, document, and place with the extents of the context."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", RUN_BYTES):
            values, bounds = scheme.values(batch.column("text"))
            found = anchors(values, bounds, scheme)
            pack = pack_of(found.place - bounds[found.text], found.place - found.low, found.place - found.high)
            of = pa.array(found.text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.run.view("int64")), pa.array(found.context.view("int64")),
                 batch.column("doc").take(of), pa.array(pack), batch.column("mark").take(of)],
                ["h", "c", "doc", "pack", "mark"],
            )

    return rows.mapInArrow(run, ROW)


def _spans(df: DataFrame) -> DataFrame:
    """The window starts of whole contexts: doc, mark, first, last."""
    place = F.shiftright("pack", 32)
    return df.select(
        "doc",
        "mark",
        (place - F.shiftright("pack", 8).bitwiseAND(F.lit(0xFF))).cast("int").alias("first"),
        (place - F.col("pack").bitwiseAND(F.lit(0xFF))).cast("int").alias("last"),
    )


def _packed_texts(rows: DataFrame) -> DataFrame:
    """(doc, mark, z): texts compressed before they are shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in pieces(batches, "text", RUN_BYTES):
            z = [press.compress(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), pa.array(z, pa.binary())], ["doc", "mark", "z"])

    return rows.mapInArrow(run, "doc long, mark long, z binary")


def opened(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Packed rows with their texts, in runs of about ``RUN_BYTES`` of text, however well they pack.

    A single longer text makes a run of its own.
    """
    open_ = zstandard.ZstdDecompressor()
    for batch in batches:
        packed, start, total = batch.column("z").to_pylist(), 0, 0
        for row, z in enumerate([*packed, None]):
            size = zstandard.frame_content_size(z) if z is not None else RUN_BYTES + 1
            if row > start and total + size > RUN_BYTES:
                yield batch.slice(start, row - start), [open_.decompress(p) for p in packed[start:row]]
                start, total = row, 0
            total += size


def _join_texts(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    t, r = texts.alias("t"), lists.alias("r")
    same = F.col("t.doc").eqNullSafe(F.col("r.doc")) & (F.col("t.mark") == F.col("r.mark"))
    return t.join(r, same, how).select("t.*", *[f"r.{c}" for c in lists.columns if c not in ("doc", "mark")])


def contents(rows: DataFrame, wanted: DataFrame, scheme: Scheme) -> DataFrame:
    """The units of each wanted context (h, n, n_contexts, doc, pack, mark): bytes, or 8 bytes per word.

    Of rows equal in key and text one is read.
    """
    lists = wanted.groupBy("doc", "mark").agg(F.collect_list(F.struct("h", "n", "n_contexts", "pack")).alias("wanted"))
    once = _join_texts(_packed_texts(rows), lists, "inner").dropDuplicates(["doc", "mark"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in opened(batches):
            texts = pa.array(texts, pa.large_binary())
            lists = batch.column("wanted")
            flat = lists.flatten()
            text = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            h, n, n_contexts, pack = (flat.field(i) for i in range(4))
            first, last = unpack(pack.to_numpy())
            if scheme.units == "bytes":
                data, bounds = text_bytes(texts)
                whole, unit = data.tobytes(), 1
            else:
                values, bounds = scheme.values(texts)
                whole, unit = values.tobytes(), 8
            a, b = (bounds[text] + first) * unit, (bounds[text] + last + scheme.length) * unit
            cut = [whole[i:j] for i, j in zip(a.tolist(), b.tolist())]
            yield pa.RecordBatch.from_arrays(
                [h, n, n_contexts, batch.column("doc").take(pa.array(text)), pack, batch.column("mark").take(pa.array(text)), pa.array(cut, pa.binary())],
                ["h", "n", "n_contexts", "doc", "pack", "mark", "content"],
            )

    return once.mapInArrow(run, CONTENT)


@dataclass
class Contexts:
    """Contexts of whole groups, end to end: the windows of context i start at base[i] + 0, 1, ..."""

    h: np.ndarray
    n: np.ndarray
    doc: np.ndarray
    mark: np.ndarray
    first: np.ndarray  # first window start in the document
    windows: np.ndarray  # how many windows
    base: np.ndarray
    values: np.ndarray  # bytes, or word hashes

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """Context and place in ``values`` of every window."""
        which = np.repeat(np.arange(len(self.h)), self.windows)
        within = np.arange(len(which)) - np.repeat(np.cumsum(self.windows) - self.windows, self.windows)
        return which, self.base[which] + within


def contexts_of(batch: pa.RecordBatch, scheme: Scheme) -> Contexts:
    data, bounds = text_bytes(batch.column("content"))
    unit = 1 if scheme.units == "bytes" else 8
    first, last = unpack(batch.column("pack").to_numpy())
    values = data if unit == 1 else np.frombuffer(data.tobytes(), "uint64")
    doc, mark = batch.column("doc").fill_null(-(1 << 63)).to_numpy(), batch.column("mark").to_numpy()
    return Contexts(
        batch.column("h").to_numpy(), batch.column("n").to_numpy(), doc, mark, first, last - first + 1, bounds[:-1] // unit, values
    )


Resolver = Callable[[Contexts], np.ndarray]
"""Which of the windows of ``Contexts.starts`` repeat, as the operator judges it."""


def _runs_of(found: Contexts, which: np.ndarray, place: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Repeated windows as spans of consecutive window starts."""
    start = found.first[which] + place - found.base[which]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(which))[: len(a)] - 1
    return pa.RecordBatch.from_arrays(
        [batch.column("doc").take(pa.array(which[a])), pa.array(found.mark[which[a]]),
         pa.array(start[a].astype("int32")), pa.array(start[b].astype("int32"))],
        ["doc", "mark", "first", "last"],
    )


def grouped_spans(content: DataFrame, scheme: Scheme, resolve: Resolver) -> DataFrame:
    """Spans of repeated windows, comparing the contexts of one run in one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column("h").to_numpy()
            last = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0
            if not last and held and held[-1].column("h")[-1].as_py() != h[0]:
                yield from solved(held)
                held = []
            if last:
                yield from solved([*held, batch.slice(0, last)])
                held = []
            held.append(batch.slice(last))
        yield from solved(held)

    def solved(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        cuts = [*(np.flatnonzero(np.diff(batch.column("h").to_numpy())) + 1).tolist(), batch.num_rows]
        start = 0
        for this, following in zip(cuts, [*cuts[1:], None]):
            if following is None or following - start > CHUNK:
                part = batch.slice(start, this - start)
                found = contexts_of(part, scheme)
                which, place = found.starts()
                keep = resolve(found)
                yield _runs_of(found, which[keep], place[keep], part)
                start = this

    return content.repartition("h").sortWithinPartitions("h").mapInArrow(run, SPAN)


WINDOW = "w1 long, w2 long, n long, doc long, mark long, start int"


def window_rows(content: DataFrame, scheme: Scheme) -> DataFrame:
    """Every window of oversized groups by two hashes of its units."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "content", RUN_BYTES // 4):
            found = contexts_of(batch, scheme)
            which, place = found.starts()
            units = found.values.astype("uint64") + U(1)
            pair = []
            for salt in (0x51ED270B, 0x2C9277B5):
                sums = words.prefix_sums(words.mix(units * U(2 * salt + 1)))
                pair.append(pa.array(words.run_hashes(sums, place, place + scheme.length).view("int64")))
            start = found.first[which] + place - found.base[which]
            yield pa.RecordBatch.from_arrays(
                [*pair, pa.array(found.n[which]), batch.column("doc").take(pa.array(which)),
                 pa.array(found.mark[which]), pa.array(start.astype("int32"))],
                ["w1", "w2", "n", "doc", "mark", "start"],
            )

    return content.mapInArrow(run, WINDOW)


def repeated_anchors(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """The stored anchors whose run occurs more than once."""
    every = anchor_rows(rows, scheme)
    # Stored, so that both sides of the join are plain exchanges, whose large keys Spark can split.
    twice = stored(every.groupBy("h").agg(F.count("*").alias("_n")).filter("_n > 1").select("h"), "repeats-runs")
    return stored(every.join(twice, "h"), "repeats-anchors")


def per_document(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, mark, z, spans): every document with the spans of its repeated windows, or null."""
    lists = spans.groupBy("doc", "mark").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    return _join_texts(_packed_texts(rows), lists, "left")


def covered(spans: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Units in repeated windows as maximal runs [start, end)."""
    runs: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans or ()):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + length)
        else:
            runs.append([first, last + length])
    return [tuple(r) for r in runs]
