"""Substring deduplication over words by suffix trees of prefix groups.

A word is removed when it lies in a window of ``LENGTH`` words whose words also start earlier: in a
document of smaller key, or earlier in the same one. The prefix of a suffix is its words up to the
end of its anchor's run (see ``repeats``), so prefixes vary in length; all suffixes whose prefixes
end in one run are a group that fits in memory. A group's tree is grown from the root: the open
suffixes are split by their next few words, and a branch of one suffix is closed. The nodes left
at a depth of ``LENGTH`` words are the repeats, the leaves below one their places.

Cases: a null text has no words. Rows equal in key and text count as one document: neither is
earlier than the other, and both lose the same. Rows of one key with other texts are ordered by a
hash of the text after the place. A null key comes before all others. Texts are read whole. Columns
besides key and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import repeats, words

LENGTH = 20
RUN = 7  # words of an anchor's run
REACH = 5  # words by which open suffixes are split at a time


def deep_nodes(found: repeats.Contexts, length: int, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """The windows below tree nodes of ``length`` words, and the node of each."""
    which, place = found.starts()
    leaf = np.arange(len(which))
    node = found.h[which].view("uint64")
    depth = 0
    while depth < length and len(leaf):
        step = min(reach, length - depth)
        branch = words.mix(node)
        for i in range(step):
            branch = words.mix((branch ^ found.values[place[leaf] + depth + i]) * words.U(words.BASE))
        _, number, count = np.unique(branch, return_inverse=True, return_counts=True)
        open_ = count[number] > 1
        leaf, node = leaf[open_], number[open_].astype("uint64")
        depth += step
    return leaf, node


def later_leaves(found: repeats.Contexts, length: int) -> np.ndarray:
    """Which windows repeat one that starts earlier."""
    which, place = found.starts()
    leaf, node = deep_nodes(found, length)
    later = np.zeros(len(which), bool)
    if len(leaf):
        context = which[leaf]
        start = found.first[context] + place[leaf] - found.base[context]
        order = np.lexsort((found.mark[context], start, found.doc[context], node))
        first = np.ones(len(order), bool)
        first[1:] = node[order][1:] != node[order][:-1]
        later[leaf[order[~first]]] = True
    return later


def spans(rows: DataFrame, scheme: repeats.Scheme, group: int = repeats.GROUP) -> DataFrame:
    """(doc, mark, first, last): starts of windows that also start earlier."""
    anchors = repeats.repeated_anchors(rows, scheme)
    contexts = repeats.stored(
        anchors.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc", "pack", "mark")).alias("at")), "words-contexts"
    )
    runs = contexts.groupBy("h").agg(F.count("*").alias("n_contexts"))
    earlier = contexts.filter("n > 1").select("h", "c", "at")
    copies = repeats._spans(anchors.join(earlier, ["h", "c"]).filter(F.struct("doc", "pack", "mark") > F.col("at")))
    wanted = contexts.join(runs.filter("n_contexts > 1"), "h").select("h", "n", "n_contexts", "at.doc", "at.pack", "at.mark")
    content = repeats.stored(repeats.contents(rows, wanted, scheme), "words-contents")

    def resolve(found: repeats.Contexts) -> np.ndarray:
        return later_leaves(found, scheme.length)

    out = copies.unionByName(repeats.grouped_spans(content.filter(F.col("n_contexts") <= group), scheme, resolve))
    large = content.filter(F.col("n_contexts") > group)
    if large.limit(1).count():
        at = F.struct("doc", "start", "mark")
        window = repeats.window_rows(large, scheme)
        first = window.groupBy("w1", "w2").agg(F.min(at).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
        later = window.join(first, ["w1", "w2"]).filter(at > F.col("_first"))
        out = out.unionByName(later.select("doc", "mark", F.col("start").alias("first"), F.col("start").alias("last")))
    return repeats.stored(out, "words-spans")


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, run: int = RUN,
    group: int = repeats.GROUP, digest: bool = False,
) -> DataFrame:
    """key, n_words, n_removed, and the kept words joined by one space as ``kept``, or their SHA-256."""
    scheme = repeats.Scheme("words", length, run)
    rows = repeats._rows(docs, key, text)
    last = "kept_sha256" if digest else "kept"

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in repeats.opened(batches):
            sizes, removed, kept = [], [], []
            for data, spans in zip(texts, batch.column("spans").to_pylist()):
                own, at, left = data.split(), 0, []
                for a, b in repeats.covered(spans, length):
                    left += own[at:a]
                    at = b
                left += own[at:]
                text = b" ".join(left)
                sizes.append(len(own))
                removed.append(len(own) - len(left))
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8"))
            columns = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], ["doc", "n_words", "n_removed", last])

    joined = repeats.per_document(rows, spans(rows, scheme, group))
    return joined.mapInArrow(keep, f"doc long, n_words long, n_removed long, {last} string").withColumnRenamed("doc", key)
