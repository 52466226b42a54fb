"""The daily load: days equal one load, a killed day is not seen, and nothing is lost or counted twice."""

import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerline.operators import daily, quality
from ledgerline.session import scratch

FIRST, LAST = dt.date(2024, 1, 3), dt.date(2024, 1, 5)
EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
POSITION = "position_key string, user_id long, amount_invested decimal(18,2), maturity_date date, is_withdrawn_early boolean"


def log(n=120):
    pick, out = random.Random(4), []
    for i in range(n):
        ts = None if i % 17 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=pick.randrange(5 * 1440))
        out.append((i, ts, pick.choice([None, 1, 2, 3]), pick.choice(["signup", "click", "view", "purchase", "error", "other"]), float(i)))
    return out


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(log(), EVENT)


@pytest.fixture(scope="module")
def held(spark):
    days = [(dt.date(2024, 1, d), early) for d in (1, 3, 4, 5, 9) for early in (False, None, True)] + [(None, False)]
    return spark.createDataFrame([(f"p{i}", i % 3, 100 + i, day, early) for i, (day, early) in enumerate(days)], "position_key string, user_id long, amount_invested int, maturity_date date, is_withdrawn_early boolean")


@pytest.fixture(scope="module")
def one_load(spark, events, held):
    root = scratch(spark, "one")
    daily.backfill(events, LAST + dt.timedelta(days=1), root, held)
    return {name: rows(daily.as_of(spark, root, name)) for name in (*daily.GROWING, *daily.STATE)}


def by_days(events, held, root):
    daily.backfill(events, FIRST, root, held)
    return daily.rerun_from(events, FIRST, LAST, root, held)


def without_keys(facts):
    return sorted((r[1:] for r in facts), key=str)


def test_days_equal_one_load(spark, events, held, one_load):
    root = scratch(spark, "days")
    by_days(events, held, root)
    got = {name: rows(daily.as_of(spark, root, name)) for name in one_load}
    assert {n: len(r) for n, r in got.items()} == {n: len(r) for n, r in one_load.items()}
    assert got == one_load
    keys = [r.event_key for r in daily.as_of(spark, root, "facts").select("event_key").collect()]
    assert sorted(keys) == list(range(1, len(log()) + 2 * 8 + 1))  # eight positions mature by the last day
    assert rows(daily.as_of(spark, root, "redemptions"), "position_key") == sorted((f"p{i}",) for i in (0, 1, 3, 4, 6, 7, 9, 10))


def test_a_killed_day_leaves_the_old_tables(spark, events, held, one_load, monkeypatch):
    root = scratch(spark, "killed")
    daily.backfill(events, FIRST, root, held)
    before = {name: rows(daily.as_of(spark, root, name)) for name in one_load}

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(daily, "_publish", dies)
        with pytest.raises(KeyboardInterrupt):
            daily.run_day(events, FIRST, root, held)
    assert {name: rows(daily.as_of(spark, root, name)) for name in one_load} == before
    daily.rerun_from(events, FIRST, LAST, root, held)
    assert {name: rows(daily.as_of(spark, root, name)) for name in one_load} == one_load


def test_a_repeated_day_counts_once(spark, events, held, one_load):
    root = scratch(spark, "twice")
    by_days(events, held, root)
    daily.run_day(events, LAST, root, held)
    assert {name: rows(daily.as_of(spark, root, name)) for name in one_load} == one_load


def test_a_corrected_day_shows_when_the_last_day_is_loaded_again(spark, events, held):
    root = scratch(spark, "corrected")
    by_days(events, held, root)
    old = rows(daily.as_of(spark, root, "wallets"))
    fixed = events.withColumn("value", F.when(F.to_date("ts") == F.lit(FIRST), F.col("value") + 1000).otherwise(F.col("value")))
    daily.run_day(fixed, FIRST, root, held)
    assert rows(daily.as_of(spark, root, "wallets")) == old
    daily.rerun_from(fixed, FIRST, LAST, root, held)
    whole = scratch(spark, "whole")
    daily.backfill(fixed, LAST + dt.timedelta(days=1), whole, held)
    assert rows(daily.as_of(spark, root, "wallets")) == rows(daily.as_of(spark, whole, "wallets")) != old
    assert rows(daily.as_of(spark, root, "wallets", FIRST - dt.timedelta(days=1))) != old


def test_events_without_a_time_come_with_the_load_that_sees_them_first(spark, events, held):
    root = scratch(spark, "undated")
    late = spark.createDataFrame([(900, None, 2, "purchase", 5.0), (901, None, None, "view", None)], EVENT)
    daily.backfill(events, FIRST, root)
    daily.run_day(events.unionByName(late), FIRST, root)
    daily.run_day(events.unionByName(late), FIRST + dt.timedelta(days=1), root)
    facts = daily.as_of(spark, root, "facts")
    assert facts.filter("ts IS NULL").count() == len([r for r in log() if r[1] is None]) + 2
    assert facts.count() == facts.select("source", "source_id").distinct().count()


def test_a_load_that_fails_its_checks_is_not_published(spark, events):
    root = scratch(spark, "checked")
    daily.backfill(events, FIRST, root)
    bad = spark.createDataFrame([(950, dt.datetime(2024, 1, 3, 1), 1, "purchase", -5.0)], EVENT)
    with pytest.raises(ValueError, match="amount_not_negative on facts: 1 of"):
        daily.run_day(events.unionByName(bad), FIRST, root)
    twice = spark.createDataFrame([(951, dt.datetime(2024, 1, 3, 1), 1, "view", None)] * 2, EVENT)
    with pytest.raises(ValueError, match="loaded_once"):
        daily.run_day(events.unionByName(twice), FIRST, root)
    assert daily.commits(spark, root).select("version").distinct().count() == 1
    with pytest.raises(ValueError, match="no load of 2024-01-03"):
        daily.run_day(events, FIRST + dt.timedelta(days=1), root)
    none = lambda tables: quality.row_checks(tables["facts"], "facts", {"nothing": F.lit(False)})
    daily.run_day(events.unionByName(bad), FIRST, root, checks=none)
    assert daily.as_of(spark, root, "transactions").filter("amount < 0").count() == 1
