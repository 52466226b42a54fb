"""Scans over a stored layout, against plain loops: hot keys, null times and keys, many partitions."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerline.operators import lifecycle, skew

T0 = dt.datetime(2024, 1, 1)


def entries(seed):
    """(id, user, ts, amount): user 7 has a third of all rows, many in one minute, some without a time."""
    pick, out = random.Random(seed), []
    for i in range(400):
        user = 7 if i % 3 == 0 else pick.choice([None, 1, 2, 3, 4])
        ts = None if pick.random() < 0.2 else T0 + dt.timedelta(seconds=pick.choice([0, 1, 2, 40, 4000, 9000, 9001]) + pick.randrange(3))
        out.append((i, user, ts, pick.choice([None, 1, 5, -3])))
    return out


def in_order(data):
    by_user = defaultdict(list)
    for row in sorted(data, key=lambda r: (r[2] is not None, r[2] or T0, r[0])):
        by_user[row[1]].append(row)
    return by_user


def add(old, new):
    return new if old is None else old if new is None else old + new


@pytest.mark.parametrize("partitions", [1, 13])
@pytest.mark.parametrize("reverse", [False, True])
def test_aggregates(spark, partitions, reverse):
    data = entries(partitions)
    df = spark.createDataFrame(data, "id long, user_id long, ts timestamp_ntz, amount long")
    amount = F.col("amount")
    scans = {
        "total": ("sum", amount, True), "before": ("sum", amount, False), "seen": ("count", amount, False),
        "low": ("min", amount, True), "high": ("max", amount, False),
    }
    found = skew.running(df, ["user_id"], ["ts", "id"], scans, reverse=reverse, partitions=partitions)
    want = []
    for of_user in in_order(data).values():
        total = low = high = None
        seen = 0
        for i, _, _, a in reversed(of_user) if reverse else of_user:
            before, before_high = total, high
            total = add(total, a)
            low = a if low is None else low if a is None else min(a, low)
            want.append((i, total, before, seen, low, before_high))
            high = a if high is None else high if a is None else max(a, high)
            seen += a is not None
    assert rows(found, "id", *scans) == sorted(want)


def test_the_hot_key_is_spread(spark):
    df = spark.createDataFrame(entries(5), "id long, user_id long, ts timestamp_ntz, amount long")
    laid = skew.laid_out(df, ["user_id"], ["ts", "id"], partitions=13)
    assert laid.filter("user_id = 7").select("_part").distinct().count() >= 4
    assert laid.groupBy("_part").count().agg(F.max("count")).first()[0] < 120
    carries = skew.scan(laid, ["user_id"], {"n": ("count", F.col("id"), True)})
    assert carries.groupBy("user_id").agg(F.max("n").alias("n"), F.count("*").alias("m")).filter("n <> m").count() == 0


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_sessions_take_the_pause_over_a_border(spark, partitions, monkeypatch):
    data = [r for r in entries(6) if r[2] is not None]
    df = spark.createDataFrame(data, "id long, user_id long, ts timestamp_ntz, amount long")
    plain_layout = skew.laid_out
    monkeypatch.setattr(lifecycle, "laid_out", lambda *a: plain_layout(*a, partitions=int(partitions)))
    found = lifecycle.sessions(df, "user_id", "ts", "id", 30, {"paid": F.sum("amount")})
    want = []
    for user, of_user in in_order(data).items():
        number, last, groups = 0, None, {}
        for row in of_user:
            number += last is None or row[2] > last + dt.timedelta(minutes=30)
            last = row[2]
            groups.setdefault(number, []).append(row)
        for number, group in groups.items():
            paid = [r[3] for r in group if r[3] is not None]
            want.append((user, number, group[0][2], group[-1][2], len(group), sum(paid) if paid else None))
    got = rows(found, "user_id", "session_no", "session_start", "session_end", "events", "paid")
    assert got == sorted(want, key=lambda r: [(v is not None, v) for v in r])


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, user_id long, ts timestamp_ntz, amount long")
    assert skew.running(df, ["user_id"], ["ts", "id"], {"total": ("sum", F.col("amount"), True)}).count() == 0
