"""Substring deduplication by suffix buckets refined with the buckets of later offsets.

A byte is removed when it lies in a string of ``LENGTH`` bytes that starts anywhere else as well,
in the same or another document. The suffixes that can start such a string are first bucketed by
a q-gram, the hash of their anchor's run (see ``repeats``), and buckets of one suffix are finished.
The strings of the others are compared bucket by bucket: suffixes are bucketed by their first
q-gram, then each bucket is refined by sorting on the bucket of the suffix that starts where the
compared part ends. The refined numbers replace the old ones, so the next round sorts on buckets
that already compare twice as many bytes, until all ``LENGTH`` are compared.

Cases: a null text is an empty one; texts shorter than ``LENGTH`` lose nothing. Rows equal in key
and text are copies of each other and lose all that one string covers. A null key is a key of its
own. Texts are read as UTF-8 bytes, whole. Columns besides key and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import repeats, words

LENGTH = 200
RUN = 64  # bytes of an anchor's run
GRAM = 50  # bytes of the first buckets inside a group


def refined_buckets(found: repeats.Contexts, length: int, gram: int = GRAM) -> np.ndarray:
    """Which windows share all their bytes with another one of the same group."""
    values, n = found.values, len(found.values)
    which, place = found.starts()
    if n < length:
        return np.zeros(len(which), bool)
    gram = min(gram, length)
    sizes = found.windows + length - 1
    context = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(n - gram + 1)
    at = at[context[at] == context[at + gram - 1]]  # q-grams inside one context
    sums = words.prefix_sums(words.byte_values(values))
    salt = words.mix(found.h.view("uint64"))[context[at]]
    bucket = np.full(n, -1)
    bucket[at] = _buckets(words.mix(words.run_hashes(sums, at, at + gram) + salt))
    depth = gram
    while depth < length:
        step = min(depth, length - depth)
        at = at[at + step < n]
        at = at[(bucket[at] >= 0) & (bucket[at + step] >= 0) & (context[at] == context[at + step])]
        key = bucket[at] * (n + 1) + bucket[at + step]
        bucket[:] = -1
        bucket[at] = _buckets(key)
        depth += step
    return bucket[place] >= 0


def _buckets(key: np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers; a key that stands alone gets -1 and is finished."""
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    return np.where(count[number] > 1, number, -1)


def spans(rows: DataFrame, scheme: repeats.Scheme, group: int = repeats.GROUP) -> DataFrame:
    """(doc, mark, first, last): starts of repeated windows."""
    anchors = repeats.repeated_anchors(rows, scheme)
    contexts = repeats.stored(
        anchors.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc", "pack", "mark")).alias("at")), "substring-contexts"
    )
    runs = contexts.groupBy("h").agg(F.count("*").alias("n_contexts"), F.min("n").alias("_least"))
    copies = repeats._spans(anchors.join(contexts.filter("n > 1").select("h", "c"), ["h", "c"]))
    # A context that stands alone is compared with the others of its run.
    open_runs = runs.filter("n_contexts > 1 AND _least = 1").select("h", "n_contexts")
    wanted = contexts.join(open_runs, "h").select("h", "n", "n_contexts", "at.doc", "at.pack", "at.mark")
    content = repeats.stored(repeats.contents(rows, wanted, scheme), "substring-contents")

    def resolve(found: repeats.Contexts) -> np.ndarray:
        which, _ = found.starts()
        return refined_buckets(found, scheme.length) & (found.n[which] == 1)

    out = copies.unionByName(repeats.grouped_spans(content.filter(F.col("n_contexts") <= group), scheme, resolve))
    large = content.filter(F.col("n_contexts") > group)
    if large.limit(1).count():
        window = repeats.window_rows(large, scheme)
        twice = window.groupBy("w1", "w2").agg(F.count("*").alias("_n")).filter("_n > 1").select("w1", "w2")
        alone = window.filter("n = 1").join(twice, ["w1", "w2"])
        out = out.unionByName(alone.select("doc", "mark", F.col("start").alias("first"), F.col("start").alias("last")))
    return repeats.stored(out, "substring-spans")


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, run: int = RUN,
    group: int = repeats.GROUP, digest: bool = False,
) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, and the remaining bytes as ``kept``, or their SHA-256."""
    scheme = repeats.Scheme("bytes", length, run)
    rows = repeats._rows(docs, key, text)
    last = "kept_sha256" if digest else "kept"

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in repeats.opened(batches):
            sizes, removed, n, kept = [], [], [], []
            for data, spans in zip(texts, batch.column("spans").to_pylist()):
                cover, at, parts = repeats.covered(spans, length), 0, []
                for a, b in cover:
                    parts.append(data[at:a])
                    at = b
                left = b"".join([*parts, data[at:]])
                sizes.append(len(data))
                removed.append(len(data) - len(left))
                n.append(len(cover))
                kept.append(hashlib.sha256(left).hexdigest() if digest else left)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string() if digest else pa.binary())
            columns = [pa.array(x, t) for x, t in zip((sizes, removed, n, kept), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], ["doc", "n_bytes", "n_removed", "n_spans", last])

    joined = repeats.per_document(rows, spans(rows, scheme, group))
    schema = f"doc long, n_bytes long, n_removed long, n_spans long, {last} {'string' if digest else 'binary'}"
    return joined.mapInArrow(keep, schema).withColumnRenamed("doc", key)
