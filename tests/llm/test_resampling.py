import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import resampling as r
from ledgerline.llm.queries import GOOD


def test_held_out_accuracy(spark):
    """Fitted on the labels of even keys, judged on those of odd keys."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    kept = r.resample(docs, labels.filter("doc_id % 2 = 0"), GOOD).select("doc_id", F.lit(1).alias("kept"))
    aside = labels.filter("doc_id % 2 = 1 AND toxic = 0").join(kept, "doc_id", "left")
    share = {x.quality: x.s for x in aside.groupBy("quality").agg(F.avg(F.coalesce("kept", F.lit(0))).alias("s")).collect()}
    assert share[1] > 0.985 and share[0] < 0.15


@pytest.mark.parametrize("k", [0, 1, 17, 500, 2999, 3000, 9999])
def test_top_k_is_exact(spark, monkeypatch, k):
    monkeypatch.setattr(r, "EXACT_ROWS", 20)
    pick = random.Random(k)
    rows = [(i, pick.choice([pick.gauss(0, 3), 1.0, 2.5])) for i in range(3000)]
    df = spark.createDataFrame(rows + [(-1, None), (-2, float("nan"))], "doc_id long, sample_key double")
    want = sorted(rows, key=lambda x: (-x[1], x[0]))[:k]
    assert sorted(map(tuple, r.top_k(df, k, bins=7).collect())) == sorted(want)


def test_draws(spark):
    d = [x[0] for x in spark.range(50_000).select(r.gumbel(1, F.col("id"))).collect()]
    assert abs(sum(d) / len(d) - 0.5772) < 0.02
    assert abs(sum(x < 0 for x in d) / len(d) - 0.3679) < 0.01


def test_weights_are_of_the_text_alone(spark):
    texts = ["a b c d", "", None, "a", "b b b b b", " ".join(["a"] * 4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    ratios = r.log_ratios(docs, r.target_keys(labels, GOOD, "doc_id"), key="doc_id", text="text", buckets=50)
    together = {x.doc_id: x.log_weight for x in r.with_weights(docs.coalesce(1), ratios, key="doc_id", text="text").collect()}
    apart = {x.doc_id: x.log_weight for x in r.with_weights(docs.repartition(6), ratios, key="doc_id", text="text").collect()}
    assert together == apart and together[1] == together[2] == 0.0


def test_awkward_rows(spark, awkward, none):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (None, 1, 0), (103, 0, 0), (3, 1, None), (9_999, 1, 0)], "doc_id long, quality int, toxic int")
    kept = r.resample(awkward, labels, GOOD)
    assert kept.columns == [*awkward.columns, "log_weight", "n_features", "sample_key"]
    assert kept.filter("doc_id = 3").count() in (0, 3)
    assert r.resample(awkward, labels.limit(0), GOOD).count() == awkward.count()
    assert r.resample(none, labels, GOOD).count() == 0
