"""Current-state tables: changes reduced to one row per key, then merged into the old state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calendar import date_id
from ledgerline.functions.money import total


def latest_time(base: DataFrame, changes: DataFrame, key: str, column: str, ts: str) -> DataFrame:
    """Move ``column`` forward to the latest change per key; it never moves back."""
    newest = changes.groupBy(key).agg(F.max(ts).alias("_new"))
    return (
        base.join(newest, key, "left").withColumn(column, F.greatest(column, "_new")).drop("_new")
    )


def earliest_time(base: DataFrame, changes: DataFrame, key: str, column: str, ts: str) -> DataFrame:
    """Stamp ``column`` with the earliest change per key, once: a set value stays."""
    first = changes.groupBy(key).agg(F.min(ts).alias("_new"))
    return (
        base.join(first, key, "left").withColumn(column, F.coalesce(column, "_new")).drop("_new")
    )


def apply_amounts(
    balances: DataFrame, changes: DataFrame, key: str, amount: Column, ts: str, change_id: str
) -> DataFrame:
    """Add the changes of each wallet to its balance and stamp the last one.

    The changes are summed first, so that two fundings in one batch both count.
    """
    per_key = changes.groupBy(key).agg(
        total(amount).alias("_delta"),
        F.max_by(change_id, F.struct(ts, change_id)).alias("_last_id"),
        F.max(ts).alias("_last_at"),
    )
    return (
        balances.join(per_key, key, "left")
        .withColumn(
            "current_balance",
            (F.col("current_balance") + F.coalesce("_delta", F.lit(0).cast("decimal(18,2)"))).cast("decimal(18,2)"),
        )
        .withColumn("last_transaction_id", F.coalesce("_last_id", "last_transaction_id"))
        .withColumn("last_updated_at", F.coalesce("_last_at", "last_updated_at"))
        .drop("_delta", "_last_id", "_last_at")
    )


def zero_balances(wallets: DataFrame) -> DataFrame:
    """One opening row per wallet."""
    return wallets.select(
        "wallet_id",
        "user_id",
        F.lit(0).cast("decimal(15,2)").alias("current_balance"),
        F.col("created_at"),
        F.col("created_at").alias("last_updated_at"),
        date_id(F.col("created_at")).alias("last_updated_date_id"),
        F.lit(None).cast("bigint").alias("last_transaction_id"),
        F.lit(None).cast("bigint").alias("last_event_id"),
    )


def balance_snapshot(ledger: DataFrame, key: str, signed: Column, ts: str, event_id: str, moves: Column) -> DataFrame:
    """Balance, last money movement and last event per wallet, in one pass over the ledger."""
    newest = F.struct(ts, event_id)
    return ledger.groupBy(key).agg(
        total(signed).alias("current_balance"),
        F.max(F.when(moves, newest))[event_id].alias("last_transaction_id"),
        F.max(newest)[event_id].alias("last_event_id"),
        F.max(F.when(moves, F.col(ts))).alias("last_updated_at"),
        date_id(F.max(F.when(moves, F.col(ts)))).alias("last_updated_date_id"),
    )


def merge(base: DataFrame, delta: DataFrame, key: Sequence[str]) -> DataFrame:
    """Upsert: rows of ``delta`` (one per key) replace or join those of ``base``.

    Whole rows are replaced, so a null in the delta is a value too.
    """
    key = list(key)
    others = [c for c in base.columns if c not in key]
    fresh = delta.select(*key, F.struct(*others).alias("_new"))
    old = base.select(*key, F.struct(*others).alias("_old"))
    merged = old.join(fresh, key, "full_outer").withColumn("_row", F.coalesce("_new", "_old"))
    return merged.select(*key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*base.columns)


def set_where_listed(base: DataFrame, listed: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Set columns on the rows whose key is in ``listed``; all other rows stay as they are."""
    marks = listed.select(key).distinct().withColumn("_listed", F.lit(True))
    return (
        base.join(marks, key, "left")
        .withColumns({c: F.when(F.col("_listed"), v).otherwise(F.col(c)) for c, v in values.items()})
        .drop("_listed")
    )
