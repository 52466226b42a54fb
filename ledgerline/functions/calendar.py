"""Calendar expressions and the calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_id(ts: Column) -> Column:
    """``yyyymmdd`` as an int, by arithmetic so that it stays in generated code."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def midnight(day: Column) -> Column:
    """A date as a naive timestamp at 00:00."""
    return day.cast("timestamp_ntz")


def day_of_week(ts: Column) -> Column:
    """0 = Sunday .. 6 = Saturday (Spark itself counts from 1)."""
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def is_month_start(ts: Column) -> Column:
    return F.dayofmonth(ts) == 1


def is_month_end(ts: Column) -> Column:
    day = F.to_date(ts)
    return day == F.last_day(day)


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def plus(ts: Column, *, days=None, hours=None, minutes=None, seconds=None, months=None) -> Column:
    """Add an interval; each part may be a number or a column."""

    def part(value):
        return F.lit(0) if value is None else value if isinstance(value, Column) else F.lit(value)

    return ts + F.make_interval(
        years=F.lit(0), months=part(months), weeks=F.lit(0), days=part(days),
        hours=part(hours), mins=part(minutes), secs=part(seconds),
    )


def complete_months(start: Column, end: Column) -> Column:
    """Whole calendar months from ``start`` to ``end``; month ends clamp."""
    rough = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return rough - (plus(start, months=rough) > end).cast("int")


def month_length(ts: Column) -> Column:
    """Days from this date to the same day of the next month."""
    day = F.to_date(ts)
    return F.datediff(F.add_months(day, 1), day)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def within_day(ts: Column, day: dt.date) -> Column:
    """Half-open day test on the bare column, so that file statistics prune."""
    nxt = day + dt.timedelta(days=1)
    return (ts >= ntz(day)) & (ts < ntz(nxt))


def ntz(moment: dt.date | dt.datetime) -> Column:
    """A naive timestamp literal."""
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def date_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")
    )


def dim_date(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """The calendar dimension between two dates."""
    day = F.col("date")
    return date_spine(spark, first, last).select(
        date_id(day).alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
        day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
        is_month_start(day).alias("is_month_start"),
        is_month_end(day).alias("is_month_end"),
    )
