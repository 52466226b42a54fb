"""Money expressions: decimals in, decimals out, half-up at two digits."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def total(amount: Column) -> Column:
    """Sum of money, back at two digits."""
    return F.sum(amount).cast(MONEY)


def scaled(amount: Column, factor: str) -> Column:
    """Amount times a decimal factor."""
    return (amount * F.lit(Decimal(factor))).cast(MONEY)


def percent_of(amount: Column, pct: Column) -> Column:
    return (amount * pct * F.lit(Decimal("0.01"))).cast(MONEY)


def signed(amount: Column, direction: Column, status: Column | None = None) -> Column:
    """Credit adds, debit takes; anything that did not succeed moves nothing."""
    value = F.when(direction == "credit", amount).otherwise(-amount)
    if status is not None:
        value = F.when(status == "success", value).otherwise(F.lit(Decimal("0.00")))
    return value.cast(MONEY)


def simple_interest_value(amount: Column, rate_pct: Column, days: Column) -> Column:
    """Principal plus simple interest for ``days`` on a 365-day year; null without days."""
    factor = (rate_pct.cast("double") * days / F.lit(36500.0)).cast("decimal(14,12)")
    return (amount + amount * factor).cast(MONEY)


def ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    """part / whole as a rounded double; null over zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)
