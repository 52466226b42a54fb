"""Loads under a contract: every row is in the table or in the quarantine, with all its reasons."""

import random
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import contracts
from ledgerline.session import scratch

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(5, 2), False), T.StructField("day", T.DateType()),
    T.StructField("note", T.StringType()),
])
CONTRACT = contracts.Contract(SCHEMA, key=("id",), bad={"negative_amount": "amount < 0"})
TEXT = "NOTE string, Amount string, ID string, day string, further string"


def load(spark, data, contract=CONTRACT, schema=TEXT, **settings):
    df = spark.createDataFrame(data, schema).repartition(5)
    return contracts.load(df, contract, scratch(spark, "t"), scratch(spark, "q"), **settings)


def test_reasons(spark):
    data = [
        ("a", "1.50", "1", "2024-01-01", "x"),
        ("b", "x", "2", "2024-01-01", "x"),  # no number
        ("c", "12345", "3", "2024-13-01", "x"),  # two values that do not fit
        ("d", None, "4", None, "x"),  # mandatory
        (None, "2", None, "2024-01-02", "x"),  # null key
        ("f", "-1", "6", None, "x"),  # named condition
        (None, "3", "7", None, None),  # nulls where they may be
    ]
    out = load(spark, data)
    assert rows(out.table, "id", "note") == [(1, "a"), (7, None)]
    assert {tuple(r[0]) for r in out.quarantine.select(contracts.REASONS).collect()} == {
        ("cast_amount",), ("cast_amount", "cast_day"), ("null_amount",), ("null_id",), ("negative_amount",)
    }
    assert out.quarantine.filter("_raw LIKE '%12345%2024-13-01%'").count() == 1  # as it came
    assert dict(rows(contracts.reasons(out.quarantine)))["cast_amount"] == 2


def test_hot_key_and_repeats_by_brute_force(spark):
    pick = random.Random(3)
    data = [(pick.choice("abc"), str(pick.randrange(4)), "1" if i % 3 == 0 else str(pick.randrange(60)), "2024-01-01", "x") for i in range(600)]
    out = load(spark, data)
    by_key = {}
    for note, amount, key, _, _ in data:
        by_key.setdefault(int(key), []).append((int(amount), note))
    assert rows(out.table, "id", F.col("amount").cast("int"), "note") == sorted((k, *max(v)) for k, v in by_key.items())
    left = Counter()
    for k, v in by_key.items():
        left.update((k, *r) for r in v)
        left[(k, *max(v))] -= 1
    raw = F.from_json(contracts.RAW, "id long, amount decimal(5,2), note string")
    found = {(r.r.id, int(r.r.amount), r.r.note): r.n for r in out.quarantine.select(raw.alias("r"), F.col(contracts.COPIES).alias("n")).collect()}
    assert found == {k: n for k, n in left.items() if n}
    assert {r.n_bad for r in out.report.collect()} == {0}


def test_too_many_bad_rows_leave_the_table(spark):
    target = scratch(spark, "kept")
    good = spark.createDataFrame([("a", "1", "1", None, None)], TEXT)
    contracts.load(good, CONTRACT, target, scratch(spark, "q"))
    bad = spark.createDataFrame([("b", "1", "2", None, None), ("c", "x", "3", None, None)], TEXT)
    with pytest.raises(ValueError, match="share_of_bad_rows"):
        contracts.load(bad, CONTRACT, target, scratch(spark, "q"), most_bad=0.4)
    assert rows(spark.read.parquet(target), "id") == [(1,)]


def test_empty_table_no_key_and_missing_columns(spark):
    out = load(spark, [])
    assert out.table.count() == out.quarantine.count() == 0
    keyless = contracts.Contract(SCHEMA)
    out = load(spark, [("1", "5")] * 3, keyless, "amount string, unlike string")
    assert rows(out.table, "id", "note") == [(None, None)] * 3
    with pytest.raises(ValueError, match="amount"):
        load(spark, [("1",)], keyless, "id string")


def test_all_columns_are_the_key(spark):
    schema = T.StructType([T.StructField("id", T.LongType())])
    out = load(spark, [("1",), ("1",), ("2",)], contracts.Contract(schema, key=("id",)), "id string")
    assert rows(out.table) == [(1,), (2,)]
    assert rows(contracts.reasons(out.quarantine)) == [("duplicate_id", 1)]
