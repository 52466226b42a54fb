"""Growth metrics: activation, active users, retention, cohorts and funnels.

The definitions are this library's own; each function states its one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.calendar import minutes_between, month_start
from ledgerline.functions.money import ratio


def activation(users: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of signed-up users with a funding at or after signup."""
    return (
        users.filter(F.col("signup_at").isNotNull())
        .groupBy(*by)
        .agg(F.count("*").alias("signups"), F.count("funded_at").alias("activated"))
        .withColumn("activation_rate", ratio(F.col("activated"), F.col("signups")))
    )


def time_to_first_funding(users: DataFrame) -> DataFrame:
    """Exact quartiles of the minutes from signup to first funding.

    Users are counted per minute first: the percentile then holds one entry per distinct
    minute, which the calendar bounds, and not one per user.
    """
    minutes = minutes_between(F.col("signup_at"), F.col("funded_at"))
    counted = (
        users.filter(F.col("funded_at").isNotNull())
        .groupBy(minutes.alias("minutes"))
        .agg(F.count("*").alias("n"))
    )
    return counted.agg(
        F.sum("n").alias("users"),
        F.percentile("minutes", 0.25, F.col("n")).alias("p25_minutes"),
        F.percentile("minutes", 0.5, F.col("n")).alias("median_minutes"),
        F.percentile("minutes", 0.75, F.col("n")).alias("p75_minutes"),
    )


def monthly_active(activity: DataFrame, user: str, ts: str) -> DataFrame:
    """Distinct users with an event in the calendar month."""
    return activity.groupBy(month_start(F.col(ts)).alias("month")).agg(F.count_distinct(user).alias("active_users"))


def daily_weekly_active(activity: DataFrame, user: str, ts: str) -> DataFrame:
    """Daily actives, actives of the seven days up to the day, and their ratio.

    A user active on a day counts for that day and the six after it, or up to the next active
    day if that comes sooner: one step up, one step down. The steps are summed per day, and the
    running sum over the calendar's days gives the weekly actives. No pair is multiplied.
    """
    days = activity.select(user, F.to_date(ts).alias("day")).distinct()
    following = F.lead("day").over(Window.partitionBy(user).orderBy("day"))
    until = F.least(F.date_add("day", 7), following)
    up = F.struct(F.col("day"), F.lit(1).alias("step"), F.lit(1).alias("here"))
    down = F.struct(F.col("until").alias("day"), F.lit(-1).alias("step"), F.lit(0).alias("here"))
    steps = days.withColumn("until", until).select(F.inline(F.array(up, down)))
    per_day = steps.groupBy("day").agg(F.sum("step").alias("step"), F.sum("here").alias("dau"))
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    weekly = per_day.select("day", "dau", F.sum("step").over(so_far).alias("wau")).filter("dau > 0")
    return weekly.withColumn("stickiness", ratio(F.col("dau"), F.col("wau")))


def retention(
    signups: DataFrame,
    activity: DataFrame,
    user: str,
    ts: str,
    horizons: Sequence[int],
    as_of: dt.date,
    by: Sequence[str] = (),
) -> DataFrame:
    """Day-n retention: users active on the calendar day n days after signup.

    ``signups`` holds (user, signup_day, *by). Only users whose day n lies before ``as_of``
    count. Activity is reduced to distinct (user, day) pairs before the join.
    """
    due = signups.select(user, "signup_day", *by, F.explode(F.lit(list(horizons))).alias("horizon_days"))
    due = due.withColumn("day", F.date_add("signup_day", F.col("horizon_days"))).filter(F.col("day") < F.lit(as_of))
    days = activity.select(user, F.to_date(ts).alias("day")).distinct().withColumn("_back", F.lit(1))
    return (
        due.join(days, [user, "day"], "left")
        .groupBy("horizon_days", *by)
        .agg(F.count("*").alias("eligible_users"), F.count("_back").alias("retained_users"))
        .withColumn("retention_rate", ratio(F.col("retained_users"), F.col("eligible_users")))
    )


def active_months(activity: DataFrame, user: str, ts: str) -> DataFrame:
    """Distinct (user, month) pairs."""
    return activity.select(user, month_start(F.col(ts)).alias("month")).distinct()


def cohorts(activity: DataFrame, user: str, ts: str) -> DataFrame:
    """Users by month of first activity and months since, with the share of the cohort."""
    months = active_months(activity, user, ts)
    first = F.min("month").over(Window.partitionBy(user))  # a user has as many rows as months
    since = F.months_between("month", "cohort_month").cast("int")
    cells = (
        months.withColumn("cohort_month", first)
        .groupBy("cohort_month", since.alias("months_since"))
        .agg(F.count("*").alias("active_users"))
    )
    size = F.max(F.when(F.col("months_since") == 0, F.col("active_users"))).over(Window.partitionBy("cohort_month"))
    return cells.withColumn("cohort_size", size).withColumn(
        "share", ratio(F.col("active_users"), F.col("cohort_size"))
    )


def retention_churn(activity: DataFrame, user: str, ts: str) -> DataFrame:
    """Of the users active in the month before: how many came back, how many did not."""
    months = active_months(activity, user, ts)
    following = F.lead("month").over(Window.partitionBy(user).orderBy("month"))
    expected = F.add_months("month", 1)
    counted = (
        months.select(expected.alias("month"), F.coalesce(following == expected, F.lit(False)).alias("back"))
        .groupBy("month")
        .agg(F.count("*").alias("previous_users"), F.count_if("back").alias("retained_users"))
    )
    # One row per month is left. The month after the last active one has not happened yet.
    last = F.max("month").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    seen = counted.withColumn("_last", last).filter(F.col("month") < F.col("_last")).drop("_last")
    churned = F.col("previous_users") - F.col("retained_users")
    return seen.withColumns(
        {
            "churned_users": churned,
            "retention_rate": ratio(F.col("retained_users"), F.col("previous_users")),
            "churn_rate": ratio(churned, F.col("previous_users")),
        }
    )


def ordered_funnel(times: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Users per step, where each step's time must be at or after the one before.

    ``times`` has one row per user. One scan counts all steps; the tall result has one row per
    step with its conversion from the step before and from the first.
    """
    reached, counts = F.lit(True), []
    previous = None
    for _, at in steps:
        reached = reached & at.isNotNull() & (F.lit(True) if previous is None else at >= previous)
        counts.append(F.count_if(reached))
        previous = at
    return _funnel(times, [name for name, _ in steps], counts)


def reach_funnel(times: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Users that reached each step at all, in any order."""
    return _funnel(times, [name for name, _ in steps], [F.count_if(c) for _, c in steps])


def _funnel(times: DataFrame, names: Sequence[str], counts: Sequence[Column]) -> DataFrame:
    wide = times.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step_no"),
                F.lit(name).alias("step"),
                F.col(f"_{i}").alias("users"),
                ratio(F.col(f"_{i}"), F.col(f"_{max(i - 1, 0)}")).alias("step_rate"),
                ratio(F.col(f"_{i}"), F.col("_0")).alias("total_rate"),
            )
            for i, name in enumerate(names)
        ]
    )
    return wide.select(F.inline(rows))
