import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from ledgerline.llm import prefix_trees, repeats, suffix_buckets, words


def without(units, covered):
    return [u for i, u in enumerate(units) if i not in covered]


def plain_bytes(rows, length):
    """rows (key, text) -> (key, n_bytes, n_removed, n_spans, kept), by counting all windows."""
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[s : s + length] for _, t in texts for s in range(len(t) - length + 1))
    out = []
    for k, t in texts:
        gone = set()
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone.update(range(s, s + length))
        spans = sum(i - 1 not in gone for i in gone)
        out.append((k, len(t), len(gone), spans, bytes(without(t, gone))))
    return sorted(out, key=str)


def plain_words(rows, length):
    """rows (key, text) -> (key, n_words, n_removed, kept); equal rows are one document.

    Texts of one key are ordered by the place of the window, then by a hash of the text.
    """
    first, texts = {}, [(k, re.findall(r"[^\x20\x09-\x0D]+", t or ""), np.uint64(xxhash.xxh64_intdigest(t or "", 42)).astype("int64")) for k, t in rows]
    for k, w, mark in texts:
        for s in range(len(w) - length + 1):
            window, at = tuple(w[s : s + length]), ((-1 if k is None else k), s, mark)
            first[window] = min(at, first.get(window, at))
    out = []
    for k, w, mark in texts:
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < ((-1 if k is None else k), s, mark):
                gone.update(range(s, s + length))
        out.append((k, len(w), len(gone), " ".join(without(w, gone))))
    return sorted(out, key=str)


def corpus(pick):
    """Texts that share passages, near copies, runs of one letter, and short ones."""
    def prose(n):
        return " ".join(pick.choices("ab ba aba bab ca abc é".split(), k=n))

    shared = [prose(pick.randint(4, 20)) for _ in range(4)]
    rows = []
    for i in range(60):
        kind = pick.randrange(6)
        if kind == 0:
            text = prose(pick.randint(0, 8))
        elif kind == 1:
            text = "a " * pick.randint(0, 30) + pick.choice(shared)
        elif kind == 2 and rows:
            words = (pick.choice(rows)[1] or "").split(" ")
            words[pick.randrange(len(words))] = "zz"
            text = " ".join(words)
        else:
            text = " ".join([prose(pick.randint(0, 6)), pick.choice(shared), prose(pick.randint(0, 6)), pick.choice(shared)])
        rows.append((i, text))
    return [*rows, (60, None), (61, ""), (62, rows[0][1]), (63, rows[9][1]), (63, rows[9][1])]


@pytest.mark.parametrize(("seed", "group"), [(1, 50_000), (2, 1), (3, 50_000)])
def test_bytes_against_all_windows(spark, seed, group):
    rows = corpus(random.Random(seed))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = suffix_buckets.remove_repeats(df, length=24, run=7, group=group).collect()
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found), key=str) == plain_bytes(rows, 24)


@pytest.mark.parametrize(("seed", "group"), [(4, 50_000), (5, 1), (6, 50_000)])
def test_words_against_all_windows(spark, seed, group):
    rows = corpus(random.Random(seed))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = prefix_trees.remove_repeats(df, length=6, run=2, group=group).collect()
    assert sorted(map(tuple, found), key=str) == plain_words(rows, 6)


def test_thousands_of_texts_under_one_null_key(spark):
    pick = random.Random(8)
    shared = [" ".join(f"s{j}w{i}" for i in range(9)) for j in range(700)]
    rows = [(None, " ".join([f"a{i}", pick.choice(shared), f"b{i}", pick.choice(shared)])) for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = suffix_buckets.remove_repeats(df, length=24, run=7).collect()
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found), key=str) == plain_bytes(rows, 24)
    found = prefix_trees.remove_repeats(df, length=6, run=2).collect()
    assert sorted(map(tuple, found), key=str) == plain_words(rows, 6)


def thue_morse(n):
    """A word of 2**n letters and its complement."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_made_by_doubling_do_not_collide(spark):
    one, two = thue_morse(11)
    same = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{same} {one}"), (2, f"{same} {two}"), (3, f"{one} {same}"), (4, same + one)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in prefix_trees.remove_repeats(df).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    found = suffix_buckets.remove_repeats(df, length=200).collect()
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found), key=str) == plain_bytes(rows, 200)


def test_run_hashes_are_polynomials_modulo_the_prime():
    pick = np.random.default_rng(3)
    a, b = (pick.integers(0, words.PRIME, 1000, dtype="uint64") for _ in range(2))
    a[:3], b[:3] = words.PRIME - 1, [0, 1, words.PRIME - 1]
    assert words.times(a, b).tolist() == [int(x) * int(y) % words.PRIME for x, y in zip(a, b)]
    assert words.powers(12345, 70_000)[69_999] == pow(12345, 69_999, words.PRIME)
    values = pick.integers(0, 1 << 63, 400, dtype="uint64") * np.uint64(2)
    sums = words.prefix_sums(np.concatenate([values, values, values]))
    starts = np.arange(0, 1200, 400)
    assert len(set(words.run_hashes(sums, starts, starts + 400).tolist())) == 1
    assert len(set(words.run_hashes(sums, np.arange(400), np.arange(400) + 30).tolist())) == 400


def test_awkward_rows(awkward, none):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    found = suffix_buckets.remove_repeats(awkward, digest=True).collect()
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in plain_bytes(rows, 200)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    found = prefix_trees.remove_repeats(awkward).collect()
    assert sorted(map(tuple, found), key=str) == plain_words(rows, 20)
    assert suffix_buckets.remove_repeats(none).count() == prefix_trees.remove_repeats(none).count() == 0


def test_anchors_are_the_same_for_equal_windows_and_cover_all():
    pick = np.random.default_rng(1)
    scheme = repeats.Scheme("bytes", 40, 9)
    shared = pick.integers(1, 1 << 60, 90, dtype="uint64")
    one = np.concatenate([pick.integers(1, 1 << 60, 33, dtype="uint64"), shared])
    two = np.concatenate([shared, pick.integers(1, 1 << 60, 71, dtype="uint64")])
    values, bounds = np.concatenate([one, two]), np.array([0, len(one), len(one), len(one) + len(two)])
    found = repeats.anchors(values, bounds, scheme)
    starts = [s for a, b in zip(found.low, found.high) for s in range(a, b + 1)]
    assert starts == [*range(len(one) - 39), *range(len(one), len(values) - 39)]
    of = {s: p for a, b, p in zip(found.low, found.high, found.place) for s in range(a, b + 1)}
    assert all(of[33 + i] - 33 - i == of[len(one) + i] - len(one) - i for i in range(51))


def test_equal_contexts_have_equal_hashes():
    pick = np.random.default_rng(2)
    scheme = repeats.Scheme("words", 10, 3)
    text = pick.integers(1, 1 << 60, 50, dtype="uint64")
    found = repeats.anchors(np.concatenate([text, text]), np.array([0, 50, 100]), scheme)
    half = len(found.run) // 2
    assert (found.context[:half] == found.context[half:]).all() and (found.run[:half] == found.run[half:]).all()
    assert len(set(found.context[:half].tolist())) == half
