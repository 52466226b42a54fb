"""Streaming queries, drained over the event table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.operators import snapshots
from ledgerline.plans.registry import query
from ledgerline.schemas import INPUT, fixed_rows
from ledgerline.session import scratch
from ledgerline.sources import readers
from ledgerline.streaming import drain, jobs
from ledgerline.streaming.jobs import naive


def _events(t):
    return readers.stream_table(t, "events")


@query("SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS load_date FROM events")
def stream_daily_ingest(t):
    stream = _events(t).select("event_id", "user_id", "event_type", "ts")
    return drain.ingest(stream, F.to_date("ts"), "ingest").drop("ts")


@query("SELECT event_id, user_id, ts FROM events")
def stream_dedupe(t):
    """The events fed twice come out once."""
    twice = _events(t).select("event_id", "user_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    rows = drain.append(jobs.deduplicated(twice), "dedupe")
    return rows.withColumns(naive("ts"))


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL")
def stream_tumbling_counts(t):
    rows = drain.upsert(jobs.tumbling_counts(_events(t)), "tumbling", ["window_start", "event_type"], "complete")
    return rows.withColumns(naive("window_start"))


@query(
    """WITH d AS (SELECT DISTINCT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events WHERE user_id IS NOT NULL),
w AS (SELECT DISTINCT user_id, day - to_days(CAST(k AS INTEGER)) AS window_start FROM d, range(0, 7) r(k))
SELECT window_start, count(*) AS active_users FROM w
WHERE window_start + INTERVAL 7 DAY <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events) GROUP BY 1"""
)
def stream_sliding_active(t):
    """Windows of seven days that the watermark has passed."""
    rows = drain.append(jobs.sliding_active(_events(t)), "sliding")
    return rows.withColumns(naive("window_start"))


@query(
    """WITH v AS (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
FROM events WHERE event_type = 'view' WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM v)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS logins FROM n GROUP BY user_id, no
HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM v)"""
)
def stream_session_engagement(t):
    """Sessions that the watermark has closed, one hour behind the newest login."""
    rows = drain.append(jobs.login_sessions(_events(t)), "sessions")
    return rows.withColumns(naive("session_start", "session_end"))


@query(
    """SELECT user_id AS wallet_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS balance, count(*) AS fundings
FROM events WHERE event_type = 'purchase' GROUP BY 1"""
)
def stream_wallet_balance(t):
    return drain.upsert(jobs.wallet_balances(_events(t)), "balances", ["wallet_id"])


@query(
    """SELECT c_custkey AS user_id, max(ts) AS last_login_at FROM customer
LEFT JOIN events ON user_id = c_custkey AND event_type = 'view' GROUP BY 1"""
)
def stream_last_login(t):
    latest = drain.upsert(jobs.last_logins(_events(t)), "last_login", ["user_id"]).withColumns(naive("last_login_at"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.lit(None).cast("timestamp_ntz").alias("last_login_at"))
    return snapshots.merge(users, latest, ["user_id"])


@query(
    """WITH w AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY AS w FROM events WHERE event_type IN ('error', 'purchase')),
p AS (SELECT f.event_id AS failed_id, arg_min(s.event_id, (s.ts, s.event_id)) AS success_id, f.user_id, f.ts AS failed_at, min(s.ts) AS success_at
FROM events f LEFT JOIN events s ON s.user_id = f.user_id AND s.ts > f.ts AND s.ts <= f.ts + INTERVAL 1 DAY AND s.event_type = 'purchase'
WHERE f.event_type = 'error' AND f.ts IS NOT NULL GROUP BY f.event_id, f.user_id, f.ts)
SELECT p.* FROM p, w WHERE coalesce(success_at, failed_at + INTERVAL 1 DAY) <= w"""
)
def stream_failed_then_success(t):
    """Failures that the last watermark has decided; those of the last hours are still open."""
    rows = drain.append(jobs.failed_then_success(_events(t)), "retries", store=drain.ROCKSDB)
    return rows.withColumns(naive("failed_at", "success_at"))


@query(
    """SELECT 1::INTEGER AS delivery, count(*) AS rows_read, CAST(0 AS BIGINT) AS rows_too_late, count(*) AS rows_kept
FROM events WHERE ts >= TIMESTAMP '2024-01-16'
UNION ALL SELECT 2, count(*), count(*) FILTER (WHERE ts < b), count(*) FILTER (WHERE ts >= b OR ts IS NULL)
FROM (SELECT ts, (SELECT max(ts) FROM events) - INTERVAL 1 DAY AS b FROM events WHERE NOT coalesce(ts >= TIMESTAMP '2024-01-16', false))"""
)
def stream_late_data(t):
    """Two deliveries, the older events last: what lies behind the watermark is counted, not kept."""
    later = F.coalesce(F.col("ts") >= cal.ntz(dt.date(2024, 1, 16)), F.lit(False))
    root = scratch(t.spark, "late")
    reports, kept_before = [], 0
    for number, condition in ((1, later), (2, ~later)):
        t.events.filter(condition).write.mode("append").parquet(f"{root}/inbox")
        stream = readers.zoned(t.spark.readStream.schema(INPUT["events"]).parquet(f"{root}/inbox"))
        kept_stream = jobs.deduplicated(stream.select("event_id", "ts"))
        read, late = drain.progress_counts(drain.start_append(kept_stream, root))
        kept = t.spark.read.schema(kept_stream.schema).parquet(f"{root}/rows").count()
        reports.append((number, read, late, kept - kept_before))
        kept_before = kept
    return fixed_rows(t.spark, reports, "delivery int, rows_read bigint, rows_too_late bigint, rows_kept bigint")


@query(
    """WITH f AS (SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS signup_at, min(ts) FILTER (WHERE event_type = 'click') AS kyc_at,
min(ts) FILTER (WHERE event_type = 'purchase') AS funded_at FROM events WHERE event_type IN ('signup', 'click', 'purchase') GROUP BY 1)
SELECT *, CASE WHEN signup_at IS NULL THEN 'Unknown' WHEN kyc_at IS NULL THEN 'Registered' WHEN funded_at IS NULL THEN 'KYC_Completed'
ELSE 'Activated' END AS state FROM f"""
)
def stream_lifecycle_state(t):
    rows = drain.upsert(jobs.lifecycle_states(_events(t)), "states", ["user_id"])
    return rows.withColumns(naive("signup_at", "kyc_at", "funded_at"))
