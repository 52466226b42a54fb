"""The star schema seen through the input tables.

Users are customers, the event log is ``events``, positions are line items with the order's
customer as owner, and wallets carry the user's key. See FIXTURES.md section 4.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calendar import date_id
from ledgerline.functions.money import money
from ledgerline.operators.lifecycle import milestones
from ledgerline.schemas import plan_rows
from ledgerline.sources.readers import Tables

EVENTS_AS_OF = dt.date(2024, 1, 31)
ORDERS_AS_OF = dt.date(2001, 6, 30)

# --- fixed values: input event type -> event code, and part type -> plan -------------------

EVENT_CODES = {
    "signup": "signup_completed",
    "view": "app_login",
    "click": "review_plan_options",
    "purchase": "wallet_funded",
    "error": "wallet_funding_failed",
}

PLAN_OF_TYPE = {
    "STANDARD": 101,
    "ECONOMY": 102,
    "SMALL": 102,
    "MEDIUM": 103,
    "LARGE": 103,
    "PROMO": 104,
}

STATUS_OF_ORDER = {"F": "success", "O": "pending", "P": "failure"}


def choose(column: Column, values: dict, other: Column | None = None) -> Column:
    """A fixed mapping as a CASE expression."""
    first, *rest = values.items()
    out = F.when(column == first[0], F.lit(first[1]))
    for key, value in rest:
        out = out.when(column == key, F.lit(value))
    return out if other is None else out.otherwise(other)


def event_fact(t: Tables) -> DataFrame:
    """fact_user_event with its code, amount and money flag."""
    return t.events.select(
        "event_id",
        "user_id",
        F.col("user_id").alias("wallet_id"),
        choose(F.col("event_type"), EVENT_CODES).alias("event_type_code"),
        F.col("ts").alias("event_time"),
        date_id(F.col("ts")).alias("event_date_id"),
        money(F.col("value")).alias("amount"),
        F.col("event_type").isin("purchase", "error").alias("is_money_movement_activity"),
    )


def wallet_transactions(t: Tables) -> DataFrame:
    """Fundings from the event log: purchases succeeded, errors failed."""
    return t.events.filter(F.col("event_type").isin("purchase", "error")).select(
        "event_id",
        F.col("user_id").alias("wallet_id"),
        F.col("ts").alias("event_time"),
        money(F.col("value")).alias("amount"),
        F.when(F.col("event_type") == "purchase", "success").otherwise("failure").alias("status"),
        F.lit("credit").alias("direction"),
    )


def cash_flow(t: Tables) -> DataFrame:
    """Long-run transactions from the orders: urgent and high priority ones are debits."""
    return t.orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("wallet_id"),
        F.col("o_orderdate").alias("event_time"),
        money(F.col("o_totalprice")).alias("amount"),
        choose(F.col("o_orderstatus"), STATUS_OF_ORDER).alias("status"),
        F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), "debit")
        .otherwise("credit")
        .alias("direction"),
        "o_orderpriority",
    )


def user_milestones(t: Tables, *, kyc: bool = True) -> DataFrame:
    """First signup, and first KYC and funding at or after it, per user of the event log.

    Without ``kyc`` its events are not read, and users that have nothing else do not show.
    """
    kinds = {"signup": "signup_at", "click": "kyc_at", "purchase": "funded_at"}
    if not kyc:
        del kinds["click"]
    return milestones(t.events, "user_id", "ts", "event_type", kinds)


def wallets(t: Tables) -> DataFrame:
    """dim_wallet: created at signup, activated at first funding; users without signup have none."""
    return user_milestones(t, kyc=False).filter(F.col("signup_at").isNotNull()).select(
        F.col("user_id").alias("wallet_id"),
        "user_id",
        F.col("signup_at").alias("wallet_created_at"),
        F.col("funded_at").alias("wallet_activated_at"),
    )


def positions(t: Tables, *, owner: bool = False, plan: bool = True, where: Column | None = None) -> DataFrame:
    """fact_investment_position; the owner costs a join with orders, the plan one with part.

    ``where`` is a condition on the bare line item columns, so that it reaches the scan.
    """
    day = F.to_date("l_shipdate")
    df = t.lineitem if where is None else t.lineitem.filter(where)
    if owner:
        orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
        df = df.join(orders, "l_orderkey")
    df = df.select(
        *(["user_id"] if owner else []),
        position_key().alias("position_key"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        money(F.col("l_extendedprice")).alias("amount_invested"),
        day.alias("start_date"),
        (F.col("l_returnflag") == "R").alias("is_withdrawn_early"),
        (F.col("l_linestatus") == "F").alias("is_redeemed"),
    )
    if not plan:
        return df
    # Four fixed plans: their terms are broadcast, the parts are not.
    terms = F.broadcast(plan_rows(t.spark))
    parts = t.part.select(
        F.col("p_partkey").alias("part_key"), choose(F.col("p_type"), PLAN_OF_TYPE).alias("plan_id")
    )
    maturity = F.date_add("start_date", F.col("tenure_days"))
    return (
        df.join(parts, "part_key", "left")  # a position of no known plan stays, without terms
        .join(terms, "plan_id", "left")
        .withColumn("maturity_date", maturity)
        .withColumn(
            "early_withdrawal_date",
            F.when(
                F.col("is_withdrawn_early") & F.col("maturity_date").isNotNull(),
                F.greatest(F.col("start_date"), F.date_sub("maturity_date", F.col("lead_days"))),
            ),
        )
    )


def position_key() -> Column:
    """A natural key for a line item, which has none of its own."""
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", date_id(F.col("l_shipdate")), cents
    )
