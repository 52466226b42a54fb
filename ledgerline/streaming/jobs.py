"""Streaming forms of the daily steps.

Every job takes a streaming frame and returns one; ``drain`` runs it over what is there. State
is bounded by a watermark, or by the number of users where the result is one row per user.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import money
from ledgerline.streaming import retries
from ledgerline.streaming.retries import NextSuccess

WATERMARK = "1 day"


def deduplicated(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Drop replays of an event id that arrive within the watermark."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def tumbling_counts(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Events per window and type. Without a watermark, for complete output."""
    counted = events.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("events"))
    return counted.select(F.col("window.start").alias("window_start"), "event_type", "events")


def daily_counts(events: DataFrame) -> DataFrame:
    """Events per day, final once the watermark has passed the day."""
    per_day = events.withWatermark("ts", WATERMARK).groupBy(F.window("ts", "1 day"))
    return per_day.agg(F.count("*").alias("events")).select(F.col("window.start").alias("window_start"), "events")


def sliding_active(events: DataFrame, width: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Active users of each rolling window, exact, once the watermark has passed the window.

    A user is kept once per window; the users of a window are then counted.
    """
    seen = events.withWatermark("ts", WATERMARK).select(F.window("ts", width, slide).alias("window"), "user_id")
    once = seen.filter(F.col("user_id").isNotNull()).dropDuplicates(["window", "user_id"])
    counted = once.groupBy("window").agg(F.count("*").alias("active_users"))
    return counted.select(F.col("window.start").alias("window_start"), "active_users")


def login_sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Login sessions per user, closed by the watermark."""
    logins = events.filter(F.col("event_type") == "view").withWatermark("ts", "1 hour")
    return (
        logins.groupBy(F.session_window("ts", gap), "user_id")
        .agg(F.count("*").alias("logins"))
        .select(
            "user_id",
            F.col("session_window.start").alias("session_start"),
            F.col("session_window.end").alias("session_end"),
            "logins",
        )
    )


def wallet_balances(events: DataFrame) -> DataFrame:
    """Balance per wallet from successful fundings; one state row per wallet."""
    paid = events.filter(F.col("event_type") == "purchase")
    return paid.groupBy(F.col("user_id").alias("wallet_id")).agg(
        money(F.sum(money(F.col("value")))).alias("balance"), F.count("*").alias("fundings")
    )


def last_logins(events: DataFrame) -> DataFrame:
    """Latest login per user."""
    logins = events.filter(F.col("event_type") == "view")
    return logins.groupBy("user_id").agg(F.max("ts").alias("last_login_at"))


def lifecycle_states(events: DataFrame) -> DataFrame:
    """First time of each milestone and the state it implies; one state row per user."""
    kinds = {"signup": "signup_at", "click": "kyc_at", "purchase": "funded_at"}
    times = events.filter(F.col("event_type").isin(*kinds)).groupBy("user_id").agg(
        *[F.min(F.when(F.col("event_type") == k, F.col("ts"))).alias(n) for k, n in kinds.items()]
    )
    state = (
        F.when(F.col("funded_at").isNotNull() & F.col("kyc_at").isNotNull() & F.col("signup_at").isNotNull(), "Activated")
        .when(F.col("kyc_at").isNotNull() & F.col("signup_at").isNotNull(), "KYC_Completed")
        .when(F.col("signup_at").isNotNull(), "Registered")
        .otherwise("Unknown")
    )
    return times.withColumn("state", state)


def failed_then_success(events: DataFrame, within: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """Each failed funding with its user's next success within the interval, or with none.

    A row comes out once per failure, when the watermark has decided it; see ``retries``. Failures
    and successes without a time are never decided and do not count. Needs the RocksDB state store.
    """
    tried = events.filter(F.col("event_type").isin("error", "purchase") & F.col("ts").isNotNull()).withWatermark("ts", WATERMARK)
    of = F.col("user_id").cast("string").alias("of")  # a number with nulls among it would lose digits on the way
    rows = tried.select(of, "event_id", "ts", F.unix_micros("ts").alias("us"), (F.col("event_type") == "error").alias("failed"))
    decided = rows.groupBy("of").transformWithStateInPandas(
        NextSuccess(int(within.total_seconds() * 1_000_000)), outputStructType=retries.OUT, outputMode="Append", timeMode="EventTime"
    )
    return decided.select(
        "failed_id", "success_id", F.col("of").cast("long").alias("user_id"), F.timestamp_micros("failed_us").alias("failed_at"), F.timestamp_micros("success_us").alias("success_at")
    )


def naive(*columns: str) -> dict[str, Column]:
    """Zoned columns back to naive UTC timestamps, for the batch tables."""
    return {c: F.col(c).cast("timestamp_ntz") for c in columns}
