"""Random inputs against plain Python."""

import datetime as dt
from collections import defaultdict

import pytest
from helpers import rows
from dateutil.relativedelta import relativedelta
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.operators import keys, lifecycle, skew

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
START = dt.datetime(2024, 1, 1)

def entries_of(users, minutes):
    kinds = st.sampled_from(["view", "click", "error"])
    return st.lists(st.tuples(users, minutes, kinds, st.integers(-5, 9)), min_size=1, max_size=60)


log = entries_of(st.integers(1, 3), st.integers(0, 60 * 50))
# Null users and times, and many entries within few minutes and around midnight.
rough = entries_of(
    st.one_of(st.none(), st.integers(1, 2)), st.one_of(st.none(), st.integers(0, 3), st.integers(1435, 1445), st.integers(0, 60 * 90))
)


def events(spark, entries):
    data = [(i, user, None if m is None else START + dt.timedelta(minutes=m), kind, n) for i, (user, m, kind, n) in enumerate(entries)]
    return data, spark.createDataFrame(data, "id bigint, user_id bigint, ts timestamp_ntz, kind string, n int")


def by_user(data):
    groups = defaultdict(list)
    for row in sorted(data, key=lambda r: (r[2] is not None, r[2] or START, r[0])):
        groups[row[1]].append(row)
    return groups


@SLOW
@given(rough)
@pytest.mark.parametrize("reverse", [False, True])
def test_running_aggregates(spark, reverse, entries):
    data, df = events(spark, entries)
    scans = {
        "total": ("sum", F.col("n"), True),
        "before": ("sum", F.col("n"), False),
        "low": ("min", F.col("n"), False),
        "login": ("max", F.when(F.col("kind") == "view", F.col("ts")), True),
        "seen": ("count", F.when(F.col("kind") == "view", 1), True),
    }
    got = rows(skew.running(df, ["user_id"], ["ts", "id"], scans, reverse=reverse), "id", *scans)
    expected = []
    for group in by_user(data).values():
        ordered = group[::-1] if reverse else group
        for at, row in enumerate(ordered):
            past, here = ordered[:at], ordered[: at + 1]
            views = [r[2] for r in here if r[3] == "view"]
            expected.append(
                (
                    row[0],
                    sum(r[4] for r in here),
                    sum(r[4] for r in past) if past else None,
                    min((r[4] for r in past), default=None),
                    max((v for v in views if v), default=None),
                    len(views),
                )
            )
    assert got == sorted(expected, key=lambda r: r[0])


@SLOW
@given(log)
def test_sessions(spark, entries):
    data, df = events(spark, entries)
    got = rows(lifecycle.sessions(df, "user_id", "ts", "id", 30, {}))
    expected = []
    for user, group in by_user(data).items():
        cut = []
        for row in group:
            if not cut or row[2] - cut[-1][-1] > dt.timedelta(minutes=30):
                cut.append([])
            cut[-1].append(row[2])
        expected += [(user, no, s[0], s[-1], len(s)) for no, s in enumerate(cut, 1)]
    assert got == sorted(expected)


@SLOW
@given(log)
def test_milestones(spark, entries):
    data, df = events(spark, entries)
    kinds = {"view": "a", "click": "b", "error": "c"}
    got = rows(lifecycle.milestones(df, "user_id", "ts", "kind", kinds))

    def first(group, kind, since):
        return min((r[2] for r in group if r[3] == kind and since is not None and r[2] >= since), default=None)

    expected = []
    for user, group in by_user(data).items():
        start = first(group, "view", dt.datetime.min)
        expected.append((user, start, first(group, "click", start), first(group, "error", start)))
    assert got == sorted(expected, key=lambda r: r[0])


@SLOW
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=50), st.integers(1, 6))
def test_dense_keys_and_tiles(spark, values, tiles):
    data = list(enumerate(values))
    df = spark.createDataFrame(data, "id bigint, v int")
    in_order = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    numbered = rows(keys.dense_key(df, ["v", "id"], "key", after=10), "key", "id")
    assert numbered == [(11 + i, row[0]) for i, row in enumerate(in_order)]
    small, large = divmod(len(data), tiles)
    sizes = [small + (i < large) for i in range(tiles)]
    expected = [t + 1 for t, size in enumerate(sizes) for _ in range(size)]
    placed = {row[0]: tile for row, tile in zip(in_order, expected)}
    assert dict(rows(keys.ntile(df, ["v", "id"], tiles, "tile"), "id", "tile")) == placed


@SLOW
@given(
    st.lists(
        st.tuples(st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2030, 1, 1)), st.integers(0, 4000)), min_size=20, max_size=80
    )
)
def test_complete_months_agree_with_calendar_arithmetic(spark, pairs):
    data = [(s, s + dt.timedelta(days=d)) for s, d in pairs] + [(dt.datetime(2024, m, 31), dt.datetime(2025, 2, 28)) for m in (1, 3, 12)]
    df = spark.createDataFrame(data, "s timestamp_ntz, e timestamp_ntz")
    got = df.select("s", "e", cal.complete_months(F.col("s"), F.col("e")).alias("n")).collect()
    for row in got:
        delta = relativedelta(row["e"], row["s"])
        assert row["n"] == delta.years * 12 + delta.months
