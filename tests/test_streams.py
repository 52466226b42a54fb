"""Streams over several small batches, replays and late rows."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerline.schemas import INPUT
from ledgerline.session import scratch
from ledgerline.sources import readers
from ledgerline.streaming import drain, jobs


@pytest.fixture(scope="module")
def inbox(spark, tables):
    """The events as six files that arrive in time order, five days each."""
    path = scratch(spark, "inbox")
    for day in range(1, 31, 5):
        first = dt.datetime(2024, 1, day)
        due = F.col("ts").between(first, first + dt.timedelta(days=5) - dt.timedelta(microseconds=1))
        tables.events.filter(due).coalesce(1).write.mode("append").parquet(path)
    assert spark.read.parquet(path).count() == tables.events.count()
    return path


def stream(spark, path):
    reader = spark.readStream.schema(INPUT["events"]).option("maxFilesPerTrigger", 1)
    return readers.zoned(reader.parquet(path))


def batch(spark, path):
    return readers.zoned(spark.read.schema(INPUT["events"]).parquet(path))


@pytest.mark.parametrize(
    "job, keys",
    [
        (jobs.wallet_balances, ["wallet_id"]),
        (jobs.last_logins, ["user_id"]),
        (jobs.lifecycle_states, ["user_id"]),
        (jobs.tumbling_counts, ["window_start", "event_type"]),
    ],
)
def test_many_batches_equal_one_batch(spark, inbox, job, keys):
    drained = drain.upsert(job(stream(spark, inbox)), "many", keys)
    assert rows(drained) == rows(job(batch(spark, inbox)))


def test_interval_join_over_batches(spark, inbox):
    drained = drain.append(jobs.failed_then_success(stream(spark, inbox)), "pairs", store=drain.ROCKSDB)
    assert rows(drained) == next_successes(batch(spark, inbox).select("event_id", "user_id", "ts", "event_type").collect())


def test_closed_sessions_equal_batch_sessions(spark, inbox):
    drained = drain.append(jobs.login_sessions(stream(spark, inbox)), "sessions")
    expected = jobs.login_sessions(batch(spark, inbox))
    got, wanted = rows(drained), rows(expected)
    # The stream holds back only sessions at the end, which the watermark has not passed.
    last = max(r[2] for r in wanted)
    assert set(got) <= set(wanted)
    assert all(r[2] > last - dt.timedelta(hours=4) for r in set(wanted) - set(got))


def test_replayed_file_is_dropped(spark, tables):
    path = scratch(spark, "replay")
    some = tables.events.filter(F.col("ts") < "2024-01-02")
    some.coalesce(1).write.parquet(path)
    some.coalesce(1).write.mode("append").parquet(path)
    drained = drain.append(jobs.deduplicated(stream(spark, path)), "dedupe")
    assert drained.count() == some.count() > 0


def test_late_rows_are_counted_not_merged(spark):
    path, root = scratch(spark, "late-inbox"), scratch(spark, "late")
    columns = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

    def deliver(*events):
        data = [(i, dt.datetime(2024, 1, d), 1, "view", 1.0, "{}") for i, d in events]
        spark.createDataFrame(data, columns).coalesce(1).write.mode("append").parquet(path)
        kept = jobs.deduplicated(stream(spark, path).select("event_id", "ts"))
        return drain.progress_counts(drain.start_append(kept, root))

    assert deliver((1, 1), (2, 1), (3, 20)) == (3, 0)
    # Event 3 again is a duplicate, 4 and 5 lie behind the watermark of January 19.
    assert deliver((4, 1), (5, 18), (3, 20), (6, 28)) == (4, 2)
    assert [r[0] for r in rows(spark.read.parquet(f"{root}/rows"), "event_id")] == [1, 2, 3, 6]


def test_daily_counts_close_with_the_watermark(spark, inbox):
    drained = drain.append(jobs.daily_counts(stream(spark, inbox)), "closed")
    whole = rows(jobs.daily_counts(batch(spark, inbox)))
    # The newest events are of January 30: that day and, at most, the one before stay open.
    assert rows(drained) in (whole[:-1], whole[:-2])


def test_rolling_actives_are_exact(spark, inbox, tables):
    drained = {r[0]: r[1] for r in rows(drain.append(jobs.sliding_active(stream(spark, inbox)), "rolling"))}
    events = [(ts, user) for ts, user in rows(tables.events, "ts", "user_id")]
    assert len(drained) >= 28
    for start, active in drained.items():
        assert active == len({user for ts, user in events if start <= ts < start + dt.timedelta(days=7)})


def test_ingested_rows_lie_under_their_day(spark, inbox):
    root = scratch(spark, "by-day")
    drain.start_append(stream(spark, inbox).withColumn("load_date", F.to_date("ts")), root, ["load_date"])
    found = spark.read.parquet(f"{root}/rows")
    assert found.count() == found.filter(F.to_date("ts") == F.col("load_date")).count() == spark.read.parquet(inbox).count()
    assert found.select("load_date").distinct().count() == len({p.split("load_date=")[1].split("/")[0] for p in found.inputFiles()})


def test_counts_cover_more_batches_than_are_kept_by_default(spark):
    """130 batches; a query keeps 100 reports unless told otherwise."""
    path, root = scratch(spark, "many-files"), scratch(spark, "many-batches")
    columns = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    data = [(i, dt.datetime(2024, 1, 1), 1, "view", 1.0, "{}") for i in range(130)]
    spark.createDataFrame(data, columns).repartitionByRange(130, "event_id").write.parquet(path)
    job = drain.start_append(jobs.deduplicated(stream(spark, path).select("event_id", "ts")), root)
    assert drain.progress_counts(job) == (130, 0)


def test_upsert_with_null_keys_and_a_repeated_batch(spark, inbox):
    events = stream(spark, inbox).withColumn("user_id", F.when(F.col("user_id") % 3 > 0, F.col("user_id")))
    drained = drain.upsert(jobs.last_logins(events), "null-keys", ["user_id"])
    plain = batch(spark, inbox).withColumn("user_id", F.when(F.col("user_id") % 3 > 0, F.col("user_id")))
    assert rows(drained) == rows(jobs.last_logins(plain))


def next_successes(events):
    """One row per failure that the last watermark has decided, by a plain search."""
    tried = [e for e in events if e.ts is not None and e.event_type in ("error", "purchase")]
    last = max(e.ts for e in tried)
    watermark, day, out = last.replace(microsecond=last.microsecond // 1000 * 1000) - dt.timedelta(days=1), dt.timedelta(days=1), []
    won = sorted((e.ts, e.event_id, e.user_id) for e in tried if e.event_type == "purchase" and e.user_id is not None)
    for e in tried:
        if e.event_type == "error":
            found = next(((s, t) for t, s, u in won if u == e.user_id and e.ts < t <= e.ts + day), (None, None))
            if (found[1] or e.ts + day) <= watermark:
                out.append((e.event_id, found[0], e.user_id, e.ts, found[1]))
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


def test_next_success_with_null_users_and_times_and_a_hot_user(spark):
    path, first = scratch(spark, "retries-in"), dt.datetime(2024, 1, 1)
    made = []
    for i in range(240):
        user = 1 if i % 3 == 0 else None if i % 7 == 0 else i % 5
        ts = None if i % 41 == 0 else first + dt.timedelta(minutes=i * 37 + (i % 2) * 300, microseconds=i)
        made.append((i, user, ts, ("error", "purchase", "error", "view")[i % 4]))
    for part in range(4):
        some = spark.createDataFrame(made[part * 60 : part * 60 + 60], "event_id long, user_id long, ts timestamp, event_type string")
        some.coalesce(1).write.mode("append").parquet(path)
    events = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    drained = drain.append(jobs.failed_then_success(events), "retries-out", store=drain.ROCKSDB)
    want = next_successes(spark.read.parquet(path).collect())
    assert rows(drained) == want and len(want) > 50 and {r[1] is None for r in want} == {True, False}
