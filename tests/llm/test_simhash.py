import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash
from ledgerline.llm.components import components
from ledgerline.llm.queries import QUERIES


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """rows: (key, fingerprint); the smallest key reachable for each fingerprint, by comparing all."""
    fps = np.array(sorted({f for _, f in rows}), "uint64")
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 3) + i + 1:
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    of = {int(f): root(i) for i, f in enumerate(fps)}
    least = {}
    for key, f in rows:
        if key is not None:
            least[of[f]] = min(key, least.get(of[f], key))
    return {f: least.get(r) for f, r in of.items()}


def check(found, texts):
    rows = [(k, plain_fingerprint(t)) for k, t in texts]
    component = plain_components(rows)
    expected = sorted(((k, f"{f:016x}", component[f]) for k, f in rows), key=str)
    assert sorted(((r[0], r[1], r[2]) for r in found), key=str) == expected


def test_query_against_brute_force(spark, folder):
    found = QUERIES["op5_simhash"](spark, folder).collect()
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    check(found, texts)


def test_awkward_rows(awkward, none):
    found = simhash.near_duplicates(awkward).collect()
    check(found, awkward.select("doc_id", "text").collect())
    assert simhash.near_duplicates(none).count() == 0


def test_links_of_a_hot_ball_are_complete_and_few(spark):
    """Thousands of fingerprints around one centre, with and without refined variants."""
    pick, centre = random.Random(5), 0x0123456789ABCDEF
    fps = {centre}
    while len(fps) < 3000:
        f = centre
        for b in pick.sample(range(64), pick.randint(1, 5)):
            f ^= 1 << b
        fps.add(f)
    fps |= {pick.getrandbits(64) for _ in range(300)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = plain_components([(i, f) for i, f in enumerate(sorted(fps))])
    for group in (100, 20_000):
        links = simhash.links(frame, group=group).collect()
        assert len(links) < 64 * len(fps) * 4
        edges = [(u % (1 << 64), v % (1 << 64)) for u, v in links]
        assert all((u ^ v).bit_count() <= 3 for u, v in edges)
        label = {f: f for f in fps}

        def root(f):
            while label[f] != f:
                label[f] = label[label[f]]
                f = label[f]
            return f

        for u, v in edges:
            label[root(u)] = root(v)
        groups = {}
        for f in fps:
            groups.setdefault(root(f), set()).add(want[f])
        assert all(len(g) == 1 for g in groups.values())
        assert len(groups) == len(set(want.values()))


def test_majority_over_many_hashes():
    pick = np.random.default_rng(3)
    sizes = np.array([0, 1, 255, 256, 0, 1000, 2])
    hashes = pick.integers(0, 1 << 63, int(sizes.sum()), dtype="uint64") * np.uint64(2) + np.uint64(1)
    got, at = simhash.majority_bits(hashes, sizes), 0
    for n, bits in zip(sizes, got):
        part = hashes[at : at + n]
        assert int(bits) == sum(1 << b for b in range(64) if 2 * int(((part >> np.uint64(b)) & np.uint64(1)).sum()) > n)
        at += n


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1400)] + [(-5, 1399), (7, 7)]
    roots = dict(components(spark.createDataFrame(pairs, "u long, v long")).collect())
    assert roots == {**{i: 0 for i in range(1, 51)}, **{i: -5 for i in range(1000, 1400)}}
    assert components(spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v"))).count() == 0


def plain_stay(rows):
    """rows (key, text), keys unique -> the keys that stay, by comparing the fingerprints of all."""
    fps = {k: plain_fingerprint(t) for k, t in rows}
    least = plain_components([(k, f) for k, f in fps.items()])
    return {k for k, f in fps.items() if least[f] == k}


def test_one_of_each(spark):
    """Edited copies, some within three bits; texts without words are one group."""
    pick, rows = random.Random(11), []
    for _ in range(40):
        words = [f"w{pick.randint(0, 5000)}" for _ in range(pick.randint(60, 400))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(pick.randint(0, 4)):
            edited = list(words)
            for at in pick.sample(range(len(words)), pick.choice([1, 1, 2, 5])):
                edited[at] = f"x{pick.randint(0, 5000)}"
            rows.append((len(rows), " ".join(edited)))
    rows += [(1000, ""), (1001, None), (1002, " \n"), (1003, rows[0][1]), (1004, "one two"), (1005, "one  two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    stay = {r.doc_id for r in simhash.one_of_each(docs).collect()}
    assert stay == plain_stay(rows) and not {1001, 1002, 1003, 1005} & stay
    assert 40 < len(stay) < len(rows) - 5


def test_one_of_each_of_awkward_rows(awkward, none):
    stay = [r.doc_id for r in simhash.one_of_each(awkward).collect()]
    assert len(stay) == len(set(stay)) and {3, 100, 103, 105} <= set(stay) and not {101, 102, 200, None} & set(stay)
    assert simhash.one_of_each(none).count() == 0
