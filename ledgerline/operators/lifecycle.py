"""Lifecycle facts of users: milestones, states, logins, retries and sessions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calendar import minutes_between, ntz
from ledgerline.operators.skew import laid_out, running, scan


def first_times(df: DataFrame, user: str, ts: str, kind: str, kinds: dict[str, str]) -> DataFrame:
    """First time of each kind of event per user, as one column per kind."""
    known = F.col(user).isNotNull() & F.col(kind).isin(*kinds)
    return df.filter(known).groupBy(user).agg(
        *[F.min(F.when(F.col(kind) == k, F.col(ts))).alias(name) for k, name in kinds.items()]
    )


def milestones(df: DataFrame, user: str, ts: str, kind: str, kinds: dict[str, str]) -> DataFrame:
    """First anchor event per user, and the first of each other kind at or after it.

    The first of ``kinds`` is the anchor. One aggregate answers every user whose events come in
    order. Only users with something before their anchor have their events read again, through
    a join with that short list.
    """
    anchor_kind, anchor = next(iter(kinds.items()))
    later = {k: name for k, name in kinds.items() if k != anchor_kind}
    first = first_times(df, user, ts, kind, kinds)
    out_of_order = F.lit(False)
    for name in later.values():
        out_of_order = out_of_order | F.coalesce(F.col(name) < F.col(anchor), F.lit(False))
    again = first.filter(out_of_order).select(user, anchor)
    redone = (
        df.filter(F.col(kind).isin(*later))
        .select(user, ts, kind)
        .join(again, user)
        .filter(F.col(ts) >= F.col(anchor))
        .groupBy(user)
        .agg(*[F.min(F.when(F.col(kind) == k, F.col(ts))).alias(f"_{name}") for k, name in later.items()])
    )
    return first.join(redone, user, "left").select(
        user,
        anchor,
        *[
            F.when(F.col(name) >= F.col(anchor), F.col(name)).otherwise(F.col(f"_{name}")).alias(name)
            for name in later.values()
        ],
    )


def lifecycle_state(signup: Column, kyc: Column, funded: Column, as_of: dt.date) -> Column:
    """Registered, KYC_Completed or Activated at the end of the day before ``as_of``."""
    by = ntz(as_of)
    return (
        F.when(funded < by, "Activated").when(kyc < by, "KYC_Completed").when(signup < by, "Registered")
    )


def with_last_login(
    df: DataFrame,
    user: str,
    ts: str,
    tiebreak: str,
    is_login: Column,
    name: str = "last_login_at",
) -> DataFrame:
    """The latest login at or before each event of the same user (an as-of join with itself)."""
    login_time = F.when(is_login, F.col(ts))
    return running(df, [user], [ts, tiebreak], {name: ("max", login_time, True)})


def retry_pairs(
    df: DataFrame, key: str, ts: str, tiebreak: str, failed: Column, succeeded: Column
) -> DataFrame:
    """Each failed attempt with the next success of the same key, null when none follows."""
    next_success = {"success_at": ("min", F.when(succeeded, F.col(ts)), False)}
    seen = running(df.filter(failed | succeeded), [key], [ts, tiebreak], next_success, reverse=True)
    return seen.filter(failed).withColumn("lag_minutes", minutes_between(F.col(ts), F.col("success_at")))


def sessions(
    df: DataFrame,
    user: str,
    ts: str,
    tiebreak: str,
    gap_minutes: int,
    measures: dict[str, Column],
    seen: dict[str, tuple[str, Column, bool]] | None = None,
) -> DataFrame:
    """Cut each user's events where the pause exceeds the gap; one row per session.

    ``seen`` are further running columns that the measures may read. They and the event before are
    found in one scan, the session numbers in a second one over the same stored layout.
    """
    rows = laid_out(df, [user], [ts, tiebreak])
    before = scan(rows, [user], {"_before": ("max", F.col(ts), False), **(seen or {})})
    starts = F.col("_before").isNull() | (
        F.col(ts) > F.col("_before") + F.make_dt_interval(mins=F.lit(gap_minutes))
    )
    numbered = scan(before, [user], {"session_no": ("sum", starts.cast("long"), True)})
    return numbered.groupBy(user, "session_no").agg(
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
        F.count("*").alias("events"),
        *[agg.alias(name) for name, agg in measures.items()],
    )


def month_spine(df: DataFrame, user: str, ts: str, as_of: dt.date) -> DataFrame:
    """One row per user and month from the first activity to ``as_of``."""
    first = df.groupBy(user).agg(F.trunc(F.to_date(F.min(ts)), "MM").alias("_first"))
    months = F.sequence(F.col("_first"), F.lit(as_of), F.expr("interval 1 month"))
    return first.filter(F.col("_first") <= F.lit(as_of)).select(user, F.explode(months).alias("month"))
