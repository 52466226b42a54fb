"""Aggregates by day: after late rows and corrections they equal a full computation, and other days stay untouched."""

import datetime as dt
import os
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerline.operators import incremental
from ledgerline.session import scratch
from ledgerline.sources import sinks

MEASURES = {"amount": "sum(amount)"}


def log(days, n, seed):
    pick = random.Random(seed)
    return [(pick.choice([None, 1, 1, 1, 2, 3]), pick.choice(days), pick.randrange(9)) for _ in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "user_id long, day date, amount long").repartition(3)


def plain(data, period):
    out = {}
    for user, day, amount in data:
        held = out.setdefault(period(day), [0, 0, set()])
        held[0] += 1
        held[1] += amount
        held[2] |= {user} - {None}
    return {(k, n, total, len(users)) for k, (n, total, users) in out.items()}


def daily(state, period=None):
    found = incremental.rolled_up(state, F.col(incremental.DAY) if period is None else period, "period", "user_id", "users", {incremental.ROWS: "n", "amount": "total"})
    return {tuple(r) for r in found.select("period", "n", "total", "users").collect()}


def files(path):
    return {os.path.join(base, f) for base, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def days():
    return [dt.date(2024, 1, 30) + dt.timedelta(days=i) for i in range(6)] + [None]


def test_late_rows_and_corrections(spark, days):
    lake, path = scratch(spark, "lake"), scratch(spark, "state")
    first = log(days, 200, 1)
    landed = sinks.land_by_day(frame(spark, first), F.col("day"), lake)
    state = incremental.refresh(landed, path, "user_id", MEASURES)
    assert daily(state) == plain(first, lambda d: d)
    before = files(path)

    late = log([days[1], days[4], None], 30, 2)  # also rows without a day
    delayed = frame(spark, late)
    touched = incremental.days_of(delayed.withColumn(incremental.DAY, F.col("day")))
    assert set(touched) == {days[1], days[4], None}
    landed = sinks.append_by_day(delayed, F.col("day"), lake)
    for _ in range(2):  # a repeated refresh changes nothing
        state = incremental.refresh(landed, path, "user_id", MEASURES, touched)
        assert daily(state) == plain(first + late, lambda d: d)
    kept = {f for f in before if not any(f"={d}" in f for d in ("2024-01-31", "2024-02-03", "__HIVE"))}
    assert kept and kept <= files(path)

    # A correction takes every row of a day away.
    gone = [r for r in first + late if r[1] != days[2]]
    state = incremental.refresh(landed.filter(~F.col(incremental.DAY).eqNullSafe(F.lit(days[2]))), path, "user_id", MEASURES, [days[2]])
    assert daily(state) == plain(gone, lambda d: d)
    # Distinct users of a month come from the days' sets.
    month = F.trunc(incremental.DAY, "month")
    assert daily(state, month) == plain(gone, lambda d: d and d.replace(day=1))
    assert daily(incremental.refresh(landed, path, "user_id", MEASURES, [])) == plain(gone, lambda d: d)


def test_only_changed_days_are_read(spark, days, capsys):
    landed = sinks.land_by_day(frame(spark, log(days, 50, 3)), F.col("day"), scratch(spark, "lake"))
    incremental.on_days(landed, [days[0], None]).explain("formatted")
    folders = next(line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line)
    assert "2024-01-30" in folders and "isnull(load_date" in folders


def test_empty(spark):
    landed = sinks.land_by_day(frame(spark, []), F.col("day"), scratch(spark, "lake"))
    assert daily(incremental.refresh(landed, scratch(spark, "state"), "user_id", MEASURES)) == set()
