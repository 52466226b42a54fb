import math
import random

import numpy as np
import pytest

from ledgerline.llm import hard_negatives as hn

ANCHOR = "id % 100 = 0"


def plain(rows, positives=5, negatives=10):
    """rows (id, vector, label) -> mined rows, from all scores."""
    good = []
    for i, (k, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            label = (label + 1) % 10 if k is not None and k % 7 == 0 else label
            good.append((k, i, label, [math.floor(256 * float(x)) for x in v]))
    out = []

    def first(anchor, found, k):
        scored = [(sum(a * b for a, b in zip(anchor[3], r[3])), r) for r in found]
        return sorted(scored, key=lambda s: (-s[0], s[1][0] is None, s[1][0] or 0, s[1][1]))[:k]

    for anchor in good:
        if anchor[0] is None or anchor[0] % 100:
            continue
        others = first(anchor, [r for r in good if r[2] != anchor[2]], None)
        for ps, p in first(anchor, [r for r in good if r[2] == anchor[2] and r[1] != anchor[1]], positives):
            fit = [(s, r) for s, r in others if 30 * ps <= 100 * s <= 90 * ps][:negatives]
            out += [(anchor[0], p[0], rank, r[0], ps, s) for rank, (s, r) in enumerate(fit, 1)]
    return sorted(out, key=str)


LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def mined(df, **options):
    return sorted(map(tuple, hn.mine(df, ANCHOR, label=LABEL, **options).collect()), key=str)


@pytest.mark.parametrize(("seed", "dimension", "group", "range_rows"), [(1, 8, 2, 100), (2, 64, 512, 1 << 15), (3, 130, 3, 57)])
def test_against_all_scores(spark, monkeypatch, seed, dimension, group, range_rows):
    monkeypatch.setattr(hn, "CHUNK", 40)
    pick = np.random.default_rng(seed)
    centres = pick.normal(0, 0.2, (4, dimension))
    labels = pick.integers(0, 4, 450)
    vectors = (centres[labels] + pick.normal(0, 0.1, (450, dimension))).round(2)
    rows = [(int(i) * (10 if i % 3 else 25), v.tolist(), int(y)) for i, (v, y) in enumerate(zip(vectors, labels))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    rows = [tuple(r) for r in df.collect()]
    found = mined(df, group=group, range_rows=range_rows)
    assert len(found) > 200 and found == plain(rows)


def test_awkward_rows(spark):
    pick = random.Random(5)
    rows = [(i, [pick.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)], pick.randrange(2)) for i in range(60)]
    rows += [(100, [1.0, 0.5, 0.0], 0), (100, [1.0, 0.5, 0.0], 0), (200, None, 1), (300, [1.0, None, 0.0], 1), (400, [float("nan"), 1.0, 1.0], 1)]
    rows += [(500, [float("inf"), 0.0, 0.0], 0), (600, [], 1), (700, [1.0], 1), (800, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (900, [0.0, 0.0, 0.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    more = df.selectExpr("*", "1 AS row", "2 AS block", "'g' AS `group`", "3 AS id", "4 AS vector")
    found = mined(more)
    assert found == plain(rows) and {r[0] for r in found} >= {0, 100}
    assert hn.mine(more.limit(0), ANCHOR).count() == 0


def test_large_components_are_clipped(spark):
    rows = [(0, [1e30, 2.0], 1), (1, [1e30, 1.0], 1), (2, [1e5, 3.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    top = hn.LARGEST
    found = hn.mine(df, ANCHOR, shares=(0, 100)).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 2, top * top + 512 * 256, top * 25_600_000 + 512 * 768)]


def test_intervals_hold_every_score():
    pick = np.random.default_rng(7)
    for dimension in (1, 3, 64, 100):
        vectors = pick.integers(-300, 300, (200, dimension)).astype("int32")
        vectors[0] = 0
        vectors[1] = vectors[2] * 2
        numbers = np.arange(200)
        codes = hn.Codes.of(numbers, numbers, numbers, vectors)
        low, high = hn.Queries(numbers, numbers, numbers, vectors).intervals(codes)
        exact = vectors.astype("int64") @ vectors.astype("int64").T
        assert (low <= exact).all() and (exact <= high).all()
        turned = hn.rotated(vectors, hn.width_of(dimension))
        assert np.allclose(turned @ turned.T, exact)


def test_intervals_drop_rows():
    pick = np.random.default_rng(8)
    near, far = pick.normal(40, 4, (50, 64)), pick.normal(0, 40, (950, 64))
    vectors = np.concatenate([near, far]).astype("int32")
    numbers = np.arange(1000)
    labels = np.zeros(1000, "int64")
    queries = hn.Queries(numbers[:20], numbers[:20], labels[:20], vectors[:20])
    low, high = queries.intervals(hn.Codes.of(numbers, numbers, labels, vectors))
    floor = np.sort(vectors[:20].astype("int64") @ vectors.T.astype("int64"), axis=1)[:, -10]
    assert (high < floor[:, None]).mean() > 0.5
