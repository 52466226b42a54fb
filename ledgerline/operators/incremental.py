"""Aggregates kept up to date by day: late rows and corrections cost only the days they touch.

The state holds a row per day and member (a user, say) with additive measures; it is the day's set
of distinct members and its sums at once. Sums and distinct counts over any set of days come from
the state, never from the rows. A refresh reads the rows of the changed days alone (their folders
are pruned by name), and replaces these days in one write, so repeating it after a crash is safe.
A day that has lost all its rows gets an empty mark. Rows without a day are a day of their own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import fixed_rows

DAY = "load_date"
ROWS = "_rows"  # how many rows a member has on the day; 0 marks an empty day


def days_of(changes: DataFrame, day: str = DAY) -> list[dt.date | None]:
    """The days that a batch touches; as many as the calendar has at most."""
    return [r[0] for r in changes.select(day).distinct().collect()]


def on_days(lake: DataFrame, days: Sequence[dt.date | None], day: str = DAY) -> DataFrame:
    """Rows of the given days, as a filter on folders."""
    found = F.col(day).isin([d for d in days if d is not None])
    return lake.filter(found | F.col(day).isNull() if None in days else found)


def refresh(
    lake: DataFrame, path: str, member: str, measures: dict[str, str], days: Sequence[dt.date | None] | None = None, day: str = DAY
) -> DataFrame:
    """Bring the state at ``path`` up to date for ``days`` (all, when None), and return it.

    ``measures`` are additive aggregates in SQL, such as sums and counts.
    """
    spark = lake.sparkSession
    rows = lake if days is None else on_days(lake, days, day)
    part = rows.groupBy(day, member).agg(F.count("*").alias(ROWS), *[F.expr(m).alias(c) for c, m in measures.items()])
    fresh = part
    if days is not None:
        if not days:
            return state(spark, path, part.schema)
        marks = fixed_rows(spark, [(d and d.isoformat(), 0) for d in days], f"{day} date, {ROWS} bigint")
        fresh = part.unionByName(marks, allowMissingColumns=True)
    (
        fresh.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    return state(spark, path, part.schema)


def state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).filter(F.col(ROWS) > 0)


def rolled_up(held: DataFrame, period: Column, name: str, member: str, distinct: str, sums: dict[str, str]) -> DataFrame:
    """Sums and distinct members per period of days; null members are in the sums alone."""
    out = [F.sum(c).alias(alias) for c, alias in sums.items()]
    per_member = held.groupBy(period.alias(name), member).agg(*[F.sum(c).alias(c) for c in sums])
    return per_member.groupBy(name).agg(*out, F.count(member).alias(distinct))
