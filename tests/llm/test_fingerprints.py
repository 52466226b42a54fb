import hashlib
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import fingerprints as f


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("parts", ["1", "7", "60"])
def test_edits_and_successors(spark, folder, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = {r.doc_id: r for r in f.edit_likeness(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy(F.desc("doc_id")).select("doc_id", "text").collect()
    assert len(found) == len(docs)
    by_text = {}
    for i, (k, t) in enumerate(docs):
        following = docs[(i + 1) % len(docs)].text
        m = len(t) // 3
        edited = t[: len(t) - m] + following[:m]
        r = found[k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - jaccard(shingles(t), shingles(edited))) < 0.2
        assert abs(r.near_next - jaccard(shingles(t), shingles(following))) < 0.2
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len({frozenset(shingles(t)) for t in by_text})


def test_awkward_rows(awkward, none):
    found = f.edit_likeness(awkward).collect()
    rows = awkward.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    assert sorted((r.n_chars for r in found)) == sorted(len(t or "") for _, t in rows)
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1] or ""))
    want = []
    for (k, t), (_, following) in zip(order, [*order[1:], order[0]]):
        t, following = t or "", following or ""
        m = len(t) // 3
        want.append((str(k), hashlib.sha256((t[: len(t) - m] + following[:m]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in found) == sorted(want)
    assert f.edit_likeness(none).count() == 0
    one = awkward.filter("doc_id = 104")
    assert [(r.near_edited, r.near_next) for r in f.edit_likeness(one).collect()] == [(0.0, 1.0)]
    assert f.edit_likeness(awkward.filter("doc_id IS NULL")).count() == 2


def test_sketches_merge_and_compare(spark):
    parts = [(1, [f"w{i}" for i in range(0, 3000)]), (1, [f"w{i}" for i in range(2996, 6000)]), (2, [f"w{i}" for i in range(0, 1500)]), (3, [])]
    df = spark.createDataFrame([(g, " ".join(w)) for g, w in parts], "doc_id long, text string")
    merged = {r.doc_id: r.sketch for r in f.merge(f.sketch(df), "doc_id").collect()}
    whole = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(6000)))], "doc_id long, text string")
    assert merged[1] == f.sketch(whole).first().sketch and merged[3] == []
    pair = spark.createDataFrame([(merged[1], merged[2], merged[3])], "a array<long>, b array<long>, e array<long>")
    r = pair.select(
        f.resemblance(F.col("a"), F.col("b")), f.containment(F.col("b"), F.col("a")), f.distinct_shingles(F.col("a")),
        f.resemblance(F.col("e"), F.col("e")), f.containment(F.col("e"), F.col("a")), f.distinct_shingles(F.col("e")),
    ).first()
    assert abs(r[0] - 0.25) < 0.13 and r[1] == 1.0 and abs(r[2] / 5996 - 1) < 0.3
    assert tuple(r[3:]) == (1.0, 1.0, 0.0)  # the empty set lies in every set


def test_words_made_by_doubling_have_other_fingerprints():
    from test_repeats import thue_morse

    one, two = thue_morse(11)
    same = " ".join(f"w{i}" for i in range(19))
    a, b = f.sketches_of(pa.array([f"{same} {one}", f"{same} {two}"]))
    assert a.tolist() != b.tolist() and 0.8 < f.likeness(a, b) < 1


def test_sketches_are_the_smallest_hashes_of_all_shingles(awkward):
    texts = [t or "" for _, t in awkward.select("doc_id", "text").collect()]
    for text, found in zip(texts, f.sketches_of(pa.array(texts), 16, 3)):
        own = text.split()
        shingles = {" ".join(own[i : i + 3]) for i in range(len(own) - 2)} or ({text} if own else set())
        every = {int(h) for s in shingles for h in f.sketches_of(pa.array([s]), 1, 3)[0]}
        assert found.tolist() == sorted(every)[:16]
