"""Financial metrics: assets under management, deposits, reliability and segments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.calendar import date_spine, month_start, ntz
from ledgerline.functions.money import ratio, signed, total
from ledgerline.operators.positions import active_on

# Login counts and balance from which a user belongs to a tier.
HIGH_LOGINS, MODERATE_LOGINS, HIGH_BALANCE = 15, 4, 5000


def aum(positions: DataFrame, day: dt.date, by: list[str] | None = None) -> DataFrame:
    """Amount held in positions that are open on the day."""
    held = positions.filter(active_on(F.col("start_date"), F.col("closed_on"), F.lit(day)))
    return held.groupBy(*(by or [])).agg(
        total(F.col("amount_invested")).alias("aum"), F.count("*").alias("positions")
    )


def aum_daily(positions: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """AUM of every day: amounts enter on the start and leave on the closing day.

    Both movements come out of one read of the positions and are summed per day at once. The
    running sum then orders calendar days, whose number no table size changes.
    """
    entry = F.struct(F.col("start_date").alias("date"), F.col("amount_invested").alias("delta"))
    leave = F.struct(F.col("closed_on").alias("date"), (-F.col("amount_invested")).alias("delta"))
    deltas = positions.select(F.inline(F.array(entry, leave))).filter(F.col("date").isNotNull())
    # What happened before the first day is the opening balance of that day.
    placed = deltas.select(F.greatest("date", F.lit(first)).alias("date"), "delta")
    per_day = placed.groupBy("date").agg(F.sum("delta").alias("delta"))
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    spine = date_spine(positions.sparkSession, first, last)
    return spine.join(per_day, "date", "left").select(
        "date", F.coalesce(F.sum("delta").over(so_far), F.lit(0)).cast("decimal(18,2)").alias("aum")
    )


def aum_month_end(positions: DataFrame, months: DataFrame) -> DataFrame:
    """AUM at the end of each of the months: movements per month, then a running sum over months."""
    entry = F.struct(F.col("start_date").alias("date"), F.col("amount_invested").alias("delta"))
    leave = F.struct(F.col("closed_on").alias("date"), (-F.col("amount_invested")).alias("delta"))
    moved = positions.select(F.inline(F.array(entry, leave))).filter(F.col("date").isNotNull())
    per_month = moved.groupBy(month_start(F.col("date")).alias("month")).agg(F.sum("delta").alias("delta"))
    # Months asked for and months with movements are merged, so that the sum misses none of either.
    asked = months.select("month", F.lit(True).alias("asked"))
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    summed = per_month.join(asked, "month", "full_outer").withColumn("aum", F.coalesce(F.sum("delta").over(so_far), F.lit(0)))
    return summed.filter("asked").select("month", F.col("aum").cast("decimal(18,2)").alias("aum"))


def net_deposits(cash: DataFrame) -> DataFrame:
    """Successful credits less successful debits per month."""
    moved = signed(F.col("amount"), F.col("direction"), F.col("status"))
    return cash.groupBy(month_start(F.col("event_time")).alias("month")).agg(total(moved).alias("net_deposits"))


def average_balance(wallets: DataFrame, by: str) -> DataFrame:
    """Average balance per group and over all, the total built from the groups."""
    groups = wallets.groupBy(by).agg(F.count("*").alias("n"), F.sum("balance").alias("b"))
    size, amount = F.sum("n"), total(F.col("b"))
    return groups.rollup(by).agg(
        size.alias("wallets"),
        amount.alias("total_balance"),
        ratio(amount, size).alias("average_balance"),
    ).fillna("all", [by])


def segment(logins: Column, balance: Column) -> Column:
    """Engagement tier and balance tier in one label."""
    engagement = F.when(logins >= HIGH_LOGINS, "High").when(logins >= MODERATE_LOGINS, "Moderate").otherwise("Low")
    wealth = F.when(balance >= HIGH_BALANCE, "High").otherwise("Low")
    return F.concat(engagement, F.lit("_Engagement_"), wealth, F.lit("_Balance"))


def churn_indicators(activity: DataFrame, split: dt.date, before_days: int, after_days: int) -> DataFrame:
    """How users behaved before ``split``, by whether they came back after it.

    ``activity`` holds (user_id, ts, amount). Each user is one row before labels are compared.
    """
    start, end = split - dt.timedelta(days=before_days), split + dt.timedelta(days=after_days)
    ts = F.col("ts")
    before, after = (ts >= ntz(start)) & (ts < ntz(split)), (ts >= ntz(split)) & (ts < ntz(end))
    users = (
        activity.filter(before | after)
        .groupBy("user_id")
        .agg(
            F.count_if(before).alias("n"),
            F.sum(F.when(before, F.col("amount"))).alias("spent"),
            F.datediff(F.lit(split), F.to_date(F.max(F.when(before, ts)))).alias("idle"),
            F.count_if(after).alias("later"),
        )
        .filter("n > 0")
    )
    label = F.when(F.col("later") > 0, "retained").otherwise("churned")
    size = F.count("*")
    return users.groupBy(label.alias("outcome")).agg(
        size.alias("users"),
        ratio(F.sum("n"), size).alias("mean_actions"),
        ratio(F.sum("spent"), size).alias("mean_amount"),
        ratio(F.sum("idle"), size).alias("mean_idle_days"),
    )
