"""Investment positions: maturity, status, proceeds, penalties and candidates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.calendar import midnight, plus
from ledgerline.functions.money import percent_of, simple_interest_value
from ledgerline.operators.skew import running


def maturity_date(start: Column, tenure: Column) -> Column:
    """Start plus tenure; open-ended plans have no tenure and no maturity."""
    return F.date_add(start, tenure)


def status_as_of(maturity: Column, as_of: dt.date) -> Column:
    return F.when(maturity < F.lit(as_of), "Matured").otherwise("Active")


def penalty(amount: Column, pct: Column, early: Column) -> Column:
    return F.when(early, percent_of(amount, pct))


def maturity_value(amount: Column, rate_pct: Column, tenure: Column) -> Column:
    """Simple interest at the plan's lowest rate over the tenure; null when open-ended."""
    return simple_interest_value(amount, rate_pct, tenure)


def paid_out(status: Column, value: Column, amount: Column, penalty_amount: Column) -> Column:
    """Maturity value (or the principal, without one) less the penalty, once redeemed."""
    zero = F.lit(0).cast("decimal(18,2)")
    out = F.coalesce(value, amount) - F.coalesce(penalty_amount, zero)
    return F.when(status == "Redeemed", out).cast("decimal(18,2)")


def closing_date(maturity: Column, withdrawn: Column) -> Column:
    return F.coalesce(withdrawn, maturity)


def active_on(start: Column, closed: Column, day: Column) -> Column:
    """Held on ``day``: started by then and not yet closed."""
    return (start <= day) & (closed.isNull() | (closed > day))


# Hours from closing a position to the credit of its proceeds, and the days after
# which a redeemed open-ended position counts as sold.
PROCEEDS_DELAY = {"vest": 0, "early_withdrawal": 24, "sale": 24}
SALE_HELD_OVER = 200


def sale_date(start: Column, maturity: Column, redeemed: Column, as_of: dt.date) -> Column:
    """When an open-ended position, held over 200 days and redeemed, was sold."""
    held = F.datediff(F.lit(as_of), start)
    return F.when(redeemed & maturity.isNull() & (held > SALE_HELD_OVER), F.date_add(start, SALE_HELD_OVER))


def proceeds(positions: DataFrame, delays: dict[str, int] = PROCEEDS_DELAY) -> DataFrame:
    """Credits for closed positions: vested, withdrawn early and sold ones.

    Each position is read once; needs the columns of its closing dates and ``sale_date``.
    """
    early, vests = F.col("is_withdrawn_early"), F.col("maturity_date").isNotNull()
    reason = (
        F.when(vests & early, "early_withdrawal").when(vests, "vest").when(F.col("sale_date").isNotNull(), "sale")
    )
    day = F.coalesce("early_withdrawal_date", "maturity_date", "sale_date")
    hours = F.lit(None).cast("int")
    for name, delay in delays.items():
        hours = F.when(reason == name, delay).otherwise(hours)
    return positions.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        "position_key",
        "reason",
        F.lit("credit").alias("direction"),
        plus(midnight(day), hours=hours).alias("transferred_at"),
        "amount_invested",
    )


def next_debit(closed: DataFrame, debits: DataFrame) -> DataFrame:
    """Each closed position with the first later debit of its owner.

    Both are put in one order per user and read from the last to the first, so that a user with
    many of both does not give all their pairs.
    """
    both = closed.select("user_id", F.col("closed_at").alias("at"), F.col("position_key").alias("tie"), F.lit(None).cast("timestamp_ntz").alias("debit_at"))
    both = both.withColumn("kind", F.lit(1)).unionByName(
        debits.select(
            "user_id", F.col("event_time").alias("at"), F.col("transaction_id").cast("string").alias("tie"),
            F.col("event_time").alias("debit_at"), F.lit(0).alias("kind"),
        )
    )
    # Of a debit and a closing at one time the debit sorts first: only later ones count.
    seen = running(both, ["user_id"], ["at", "kind", "tie"], {"withdrawn_at": ("min", F.col("debit_at"), False)}, reverse=True, bare=False)
    return seen.filter("kind = 1").select(F.col("tie").alias("position_key"), F.col("at").alias("closed_at"), "withdrawn_at")


def first_per_user(positions: DataFrame, order: list[Column]) -> DataFrame:
    """The first position of each user; the rank filter also runs before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(*order))
    return positions.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def held_by(positions: DataFrame, as_of: dt.date) -> DataFrame:
    """Positions started by ``as_of`` and neither withdrawn nor redeemed."""
    started = F.col("start_date") <= F.lit(as_of)
    return positions.filter(started & ~F.col("is_withdrawn_early") & ~F.col("is_redeemed"))


def near_maturity(positions: DataFrame, as_of: dt.date, within: int) -> DataFrame:
    """Users whose next maturity is at most ``within`` days away.

    Rank first, filter second: an overdue position hides its user. Open-ended ones rank last.
    """
    nearest = first_per_user(held_by(positions, as_of), [F.asc_nulls_last("maturity_date"), F.asc("position_key")])
    left = F.datediff("maturity_date", F.lit(as_of))
    return nearest.withColumn("days_left", left).filter(F.col("days_left").between(0, within))


def long_held(positions: DataFrame, as_of: dt.date, longer_than: int) -> DataFrame:
    """The oldest open position of each user, if held longer than the given days."""
    oldest = first_per_user(held_by(positions, as_of), [F.asc("start_date"), F.asc("position_key")])
    held = F.datediff(F.lit(as_of), "start_date")
    return oldest.withColumn("days_held", held).filter(F.col("days_held") > longer_than)
