"""The same metrics through the stand-in tables and through star tables built from them."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerline.functions.money import money
from ledgerline.metrics import finance, growth
from ledgerline.operators import lifecycle, quality
from ledgerline.schemas import STAR, event_type_rows, plan_rows, transaction_type_rows
from ledgerline.session import scratch
from ledgerline.sources import standin
from ledgerline.sources.catalog import STAR_NOTES
from ledgerline.sources.star import MILESTONES, Star

AS_OF = dt.date(2001, 6, 30)
# The stand-in's click is the KYC step.
CODES = standin.EVENT_CODES | {"click": "kyc_completed"}


@pytest.fixture(scope="module")
def star(spark, tables):
    """The eleven tables, written and read like those of a warehouse."""
    t, made = tables, {}
    made["dim_event_type"] = event_type_rows(spark)
    made["dim_plan"] = plan_rows(spark)
    made["dim_transaction_type"] = transaction_type_rows(spark)
    ids = event_type_rows(spark).select("event_type_code", "event_type_id")
    coded = t.events.withColumn("event_type_code", standin.choose(F.col("event_type"), CODES)).join(ids, "event_type_code")
    made["fact_user_event"] = coded.select(
        "event_id", "user_id", "event_type_id", F.col("user_id").alias("wallet_id"), F.col("ts").alias("event_time"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("event_date_id"), F.col("event_type").isin("purchase", "error").alias("is_money_movement_activity"),
        F.when(F.col("event_type").isin("purchase", "error"), F.col("event_id")).alias("transaction_id"),
    )
    flow = standin.cash_flow(t).select(
        (F.col("transaction_id") + 10_000_000).alias("transaction_id"), "wallet_id", F.when(F.col("direction") == "credit", 4).otherwise(2).alias("transaction_type_id"),
        F.col("amount").alias("transaction_amount"), F.col("status").alias("transaction_status"), F.col("event_time").alias("transaction_timestamp"),
    )
    fundings = standin.wallet_transactions(t).select(
        F.col("event_id").alias("transaction_id"), "wallet_id", F.lit(1).alias("transaction_type_id"), F.col("amount").alias("transaction_amount"),
        F.col("status").alias("transaction_status"), F.col("event_time").alias("transaction_timestamp"),
    )
    made["fact_transaction"] = flow.unionByName(fundings).withColumn("transaction_date_id", F.lit(0))
    held = standin.positions(t, owner=True)
    made["fact_investment_position"] = held.select(
        F.xxhash64("position_key").alias("investment_id"), "user_id", F.col("user_id").alias("wallet_id"), "plan_id", "amount_invested",
        F.col("start_date").alias("investment_start_date"), F.col("maturity_date").alias("investment_maturity_date"), "is_withdrawn_early", "early_withdrawal_date",
        F.when(F.col("is_redeemed"), "Redeemed").otherwise("Active").alias("investment_status"),
    )
    made["dim_wallet"] = standin.wallets(t)
    made["dim_user"] = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("acquisition_channel"))
    made["fact_wallet_balance"] = t.customer.select(F.col("c_custkey").alias("wallet_id"), F.col("c_custkey").alias("user_id"), money(F.col("c_acctbal")).alias("current_balance"))
    root = scratch(spark, "star")
    for name in STAR_NOTES:
        df = made.get(name, spark.range(0))
        # Mandatory columns the stand-in has no value for are filled, none of them is read below.
        for field in STAR[name].fields:
            if field.name not in df.columns:
                filler = F.lit(None) if field.nullable else F.lit("2024-01-01" if "time" in field.dataType.typeName() or field.dataType.typeName() == "date" else "0")
                df = df.withColumn(field.name, filler.cast(field.dataType))
        df.write.parquet(f"{root}/{name}")
    return Star.read(spark, root)


def closed(df):
    return df.withColumn("closed_on", F.coalesce("early_withdrawal_date", "maturity_date"))


def test_growth(tables, star):
    ours, theirs = standin.user_milestones(tables), star.user_milestones()
    assert rows(ours, "user_id", *MILESTONES.values()) == rows(theirs, "user_id", *MILESTONES.values())
    assert rows(growth.activation(ours)) == rows(growth.activation(theirs))
    assert rows(growth.time_to_first_funding(ours)) == rows(growth.time_to_first_funding(theirs))
    events = star.event_fact()
    assert rows(growth.daily_weekly_active(tables.events, "user_id", "ts")) == rows(growth.daily_weekly_active(events, "user_id", "event_time"))
    assert rows(growth.monthly_active(tables.events, "user_id", "ts")) == rows(growth.monthly_active(events, "user_id", "event_time"))
    channel = tables.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("acquisition_channel"))
    by = ["acquisition_channel"]
    assert rows(growth.activation(ours.join(channel, "user_id"), by)) == rows(growth.activation(theirs.join(star.users(*by), "user_id"), by))


def test_money(tables, star):
    ours, theirs = standin.wallet_transactions(tables), star.wallet_transactions()
    columns = ("event_id", "wallet_id", "event_time", "amount", "status", "direction")
    assert rows(ours, *columns) == rows(theirs, *columns)
    status = F.col("status")
    pairs = [lifecycle.retry_pairs(df, "wallet_id", "event_time", "event_id", status == "failure", status == "success") for df in (ours, theirs)]
    assert rows(pairs[0], "event_id", "lag_minutes") == rows(pairs[1], "event_id", "lag_minutes")
    flow = star.cash_flow().filter("transaction_id >= 10000000")
    assert rows(finance.net_deposits(standin.cash_flow(tables))) == rows(finance.net_deposits(flow))


def test_positions(tables, star):
    ours, theirs = closed(standin.positions(tables, owner=True)), closed(star.positions())
    for by in ([], ["plan_name"], ["user_id"]):
        assert rows(finance.aum(ours, AS_OF, by)) == rows(finance.aum(theirs, AS_OF, by))
    first, last = dt.date(1996, 1, 1), AS_OF
    assert rows(finance.aum_daily(ours, first, last)) == rows(finance.aum_daily(theirs, first, last))


def test_checks(star):
    found = quality.report([
        quality.unique(star.wallets(), ["user_id"], "one_wallet", "dim_wallet"),
        quality.foreign_key(star.event_fact(), "user_id", star.users(), "user_id", "known_user", "fact_user_event"),
        quality.row_checks(star.cash_flow(), "fact_transaction", {"positive": F.col("amount") <= 0, "status": ~F.col("status").isin("success", "failure", "pending")}),
    ])
    assert found.count() == 4 and found.filter("n_rows > 0").count() == 4
