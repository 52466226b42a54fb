"""Queries over current-state tables, dimensions and the daily load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.money import money
from ledgerline.operators import daily, keys, snapshots
from ledgerline.plans.registry import query
from ledgerline.plans.views import date_id, with_views
from ledgerline.schemas import INPUT, STAR, contract
from ledgerline.session import scratch
from ledgerline.sources import catalog, readers, sinks, standin
from ledgerline.sources.standin import EVENTS_AS_OF

HALFWAY = dt.date(2024, 1, 15)


def _events_of(t, kind: str):
    return t.events.filter(F.col("event_type") == kind).select("user_id", "ts", "event_id", "value")


@query(
    """SELECT c_custkey AS user_id, max(ts) AS last_login_at FROM customer
LEFT JOIN events ON user_id = c_custkey AND event_type = 'view' GROUP BY c_custkey"""
)
def scd1_last_login(t):
    """Logins up to the 15th are stored; later ones, and a replay of early ones, are merged."""
    logins = _events_of(t, "view")
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.lit(None).cast("timestamp_ntz").alias("last_login_at"))
    stored = snapshots.latest_time(users, logins.filter(F.col("ts") < cal.ntz(HALFWAY)), "user_id", "last_login_at", "ts")
    late = logins.filter((F.col("ts") >= cal.ntz(HALFWAY)) | (F.col("ts") < cal.ntz(dt.date(2024, 1, 3))))
    return snapshots.latest_time(stored, late, "user_id", "last_login_at", "ts")


@query(
    """SELECT c_custkey AS user_id, min(ts) IS NOT NULL AS kyc_completed, min(ts) AS kyc_completion_date FROM customer
LEFT JOIN events ON user_id = c_custkey AND event_type = 'click' GROUP BY c_custkey"""
)
def scd1_kyc_status(t):
    users = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.lit(None).cast("timestamp_ntz").alias("kyc_completion_date")
    )
    done = snapshots.earliest_time(users, _events_of(t, "click"), "user_id", "kyc_completion_date", "ts")
    return done.withColumn("kyc_completed", F.col("kyc_completion_date").isNotNull())


@query(
    """SELECT c_custkey AS wallet_id, min(ts) AS wallet_activated_at FROM customer
LEFT JOIN events ON user_id = c_custkey AND event_type = 'purchase' GROUP BY c_custkey"""
)
def wallet_activation(t):
    wallets = t.customer.select(
        F.col("c_custkey").alias("wallet_id"), F.lit(None).cast("timestamp_ntz").alias("wallet_activated_at")
    )
    paid = standin.wallet_transactions(t).filter(F.col("status") == "success")
    return snapshots.earliest_time(wallets, paid, "wallet_id", "wallet_activated_at", "event_time")


def _opening(t):
    return t.customer.select(
        F.col("c_custkey").alias("wallet_id"),
        money(F.col("c_acctbal")).alias("current_balance"),
        F.lit(None).cast("bigint").alias("last_transaction_id"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_at"),
    )


@query(
    """SELECT c_custkey AS wallet_id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) + coalesce(d.amount, 0) AS DECIMAL(18,2)) AS current_balance,
d.last_id AS last_transaction_id, d.last_at AS last_updated_at FROM customer LEFT JOIN
(SELECT user_id, sum(CAST(value AS DECIMAL(18,2))) AS amount, max(ts) AS last_at, arg_max(event_id, (ts, event_id)) AS last_id
 FROM events WHERE event_type = 'purchase' GROUP BY user_id) d ON d.user_id = c_custkey"""
)
def wallet_topup(t):
    paid = standin.wallet_transactions(t).filter(F.col("status") == "success")
    return snapshots.apply_amounts(_opening(t), paid, "wallet_id", F.col("amount"), "event_time", "event_id")


@query(
    with_views("cash_flow")
    + """SELECT c_custkey AS wallet_id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) - coalesce(d.amount, 0) AS DECIMAL(18,2)) AS current_balance,
d.last_id AS last_transaction_id, d.last_at AS last_updated_at FROM customer LEFT JOIN
(SELECT wallet_id, sum(amount) AS amount, max(event_time) AS last_at, arg_max(transaction_id, (event_time, transaction_id)) AS last_id
 FROM cash_flow WHERE direction = 'debit' AND status = 'success' GROUP BY wallet_id) d ON d.wallet_id = c_custkey"""
)
def wallet_debit(t):
    spent = standin.cash_flow(t).filter((F.col("direction") == "debit") & (F.col("status") == "success"))
    return snapshots.apply_amounts(_opening(t), spent, "wallet_id", -F.col("amount"), "event_time", "transaction_id")


@query(
    with_views("milestones")
    + f"""SELECT user_id AS wallet_id, user_id, CAST(0 AS DECIMAL(15,2)) AS current_balance, signup_at AS created_at,
signup_at AS last_updated_at, {date_id('signup_at')} AS last_updated_date_id, CAST(NULL AS BIGINT) AS last_transaction_id,
CAST(NULL AS BIGINT) AS last_event_id FROM milestones WHERE signup_at IS NOT NULL"""
)
def wallet_balance_init(t):
    return snapshots.zero_balances(standin.wallets(t).withColumnRenamed("wallet_created_at", "created_at"))


@query(
    f"""SELECT c_custkey AS wallet_id, CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase'), 0)
AS DECIMAL(18,2)) AS current_balance, arg_max(event_id, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS last_transaction_id,
arg_max(event_id, (ts, event_id)) AS last_event_id, max(ts) FILTER (WHERE event_type = 'purchase') AS last_updated_at,
{date_id("max(ts) FILTER (WHERE event_type = 'purchase')")} AS last_updated_date_id
FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey"""
)
def wallet_balance_snapshot(t):
    facts = standin.event_fact(t)
    paid = F.col("event_type_code") == "wallet_funded"
    amount = F.when(paid, F.col("amount"))
    moved = snapshots.balance_snapshot(facts, "wallet_id", amount, "event_time", "event_id", paid)
    everyone = t.customer.select(F.col("c_custkey").alias("wallet_id")).join(moved, "wallet_id", "left")
    zero = F.lit(0).cast("decimal(18,2)")
    return everyone.withColumn("current_balance", F.coalesce("current_balance", zero))


@query(
    with_views("milestones")
    + f""", w AS (SELECT row_number() OVER (ORDER BY signup_at, user_id) AS wallet_id, user_id, signup_at,
 funded_at AS activated_at FROM milestones WHERE signup_at IS NOT NULL)
SELECT wallet_id, user_id, 'GBP' AS wallet_currency, signup_at AS wallet_created_at, activated_at AS wallet_activated_at,
{date_id('signup_at')} AS wallet_created_date_id, {date_id('activated_at')} AS wallet_activated_date_id,
signup_at AS created_at, coalesce(activated_at, signup_at) AS last_updated_at FROM w"""
)
def wallet_dim_build(t):
    """Wallets keyed in signup order, activated by their first funding."""
    built = standin.wallets(t).drop("wallet_id")
    keyed = keys.dense_key(built, ["wallet_created_at", "user_id"], "wallet_id")
    full = keyed.withColumns(
        {
            "wallet_currency": F.lit("GBP"),
            "wallet_created_date_id": cal.date_id(F.col("wallet_created_at")),
            "wallet_activated_date_id": cal.date_id(F.col("wallet_activated_at")),
            "created_at": F.col("wallet_created_at"),
            "last_updated_at": F.coalesce("wallet_activated_at", "wallet_created_at"),
        }
    )
    return readers.conform(full, STAR["dim_wallet"])


@query(
    with_views("positions")
    + "SELECT position_key, CASE WHEN is_redeemed THEN 'Redeemed' ELSE 'Active' END AS investment_status FROM positions"
)
def position_status_update(t):
    held = standin.positions(t, plan=False)
    base = held.select("position_key", F.lit("Active").alias("investment_status"))
    closed = held.filter("is_redeemed").select("position_key")
    return snapshots.set_where_listed(base, closed, "position_key", {"investment_status": F.lit("Redeemed")})


@query(
    with_views("positions")
    + f"""SELECT position_key, is_withdrawn_early, CASE WHEN is_withdrawn_early THEN DATE '2001-06-30' END AS early_withdrawal_date,
CASE WHEN is_withdrawn_early THEN {date_id("DATE '2001-06-30'")} END AS early_withdrawal_date_id FROM positions"""
)
def position_early_flag_update(t):
    held = standin.positions(t, plan=False)
    base = held.select(
        "position_key",
        F.lit(False).alias("is_withdrawn_early"),
        F.lit(None).cast("date").alias("early_withdrawal_date"),
        F.lit(None).cast("int").alias("early_withdrawal_date_id"),
    )
    day = F.lit(standin.ORDERS_AS_OF)
    values = {
        "is_withdrawn_early": F.lit(True),
        "early_withdrawal_date": day,
        "early_withdrawal_date_id": cal.date_id(day),
    }
    return snapshots.set_where_listed(base, held.filter("is_withdrawn_early"), "position_key", values)


@query(
    """SELECT c_custkey AS user_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name END AS name,
CAST(CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN CAST(c_acctbal AS DECIMAL(18,2)) + 100
ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS balance FROM customer"""
)
def scd1_merge(t):
    """Yesterday holds all segments but BUILDING; today BUILDING is new and MACHINERY changed."""
    customers = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), money(F.col("c_acctbal")).alias("balance"), "c_mktsegment"
    )
    segment = F.col("c_mktsegment")
    yesterday = customers.filter(segment != "BUILDING").drop("c_mktsegment")
    today = customers.filter(segment.isin("BUILDING", "MACHINERY")).select(
        "user_id",
        F.when(segment == "BUILDING", F.col("name")).alias("name"),
        money(F.col("balance") + 100).alias("balance"),
    )
    return snapshots.merge(yesterday, today, ["user_id"])


@query(
    f"""SELECT {date_id('d')} AS date_id, CAST(d AS DATE) AS date, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter,
month(d)::INTEGER AS month, monthname(d) AS month_name, day(d)::INTEGER AS day, week(d)::INTEGER AS week_of_year,
dayofweek(d)::INTEGER AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, day(d) = 1 AS is_month_start,
CAST(d AS DATE) = last_day(CAST(d AS DATE)) AS is_month_end
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate) + INTERVAL 3 YEAR, INTERVAL 1 DAY)) AS d FROM orders)"""
)
def dim_date_build(t):
    """The calendar from the first order to three years after the last."""
    first, last = t.orders.agg(
        F.to_date(F.min("o_orderdate")), F.add_months(F.to_date(F.max("o_orderdate")), 36)
    ).first()
    return cal.dim_date(t.spark, first, last)


@query(
    """SELECT 'region' AS table_name, r_regionkey AS id, r_name AS code FROM region
UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation"""
)
def dim_static_load(t):
    names = ("region", "nation")
    files = {n: sinks.overwrite_csv(t.read(n), scratch(t.spark, f"{n}_dim")) for n in names}
    loaded = catalog.load_static(t.spark, files, INPUT)
    shape = contract("table_name string, id int not null, code string not null")
    parts = [
        readers.conform(
            df.select(F.lit(n).alias("TABLE_NAME"), F.col(f"{n[0]}_{n}key").alias("Id"), F.col(f"{n[0]}_name").alias("code")), shape
        )
        for n, df in loaded.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    with_views("event_types")
    + f"""SELECT row_number() OVER (ORDER BY ts, source_id) AS event_id, source_id, user_id, event_type_code,
{date_id('ts')} AS event_date_id FROM (SELECT event_id AS source_id, * EXCLUDE (event_id) FROM events) JOIN event_types USING (event_type)
WHERE ts < TIMESTAMP '2024-01-31'"""
)
def initial_backfill(t):
    history = standin.event_fact(t).filter(F.col("event_time") < cal.ntz(EVENTS_AS_OF))
    history = history.withColumnRenamed("event_id", "source_id")
    keyed = keys.dense_key(history, ["event_time", "source_id"], "event_id", bare=True)
    return keyed.select("event_id", "source_id", "user_id", "event_type_code", "event_date_id")


@query(
    """WITH k AS (SELECT *, row_number() OVER o AS event_key, count(*) FILTER (WHERE event_type IN ('purchase', 'error')) OVER
(o ROWS UNBOUNDED PRECEDING) AS tx FROM events WINDOW o AS (ORDER BY ts NULLS FIRST, CAST(event_id AS VARCHAR)))
SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS signup_at, min(ts) FILTER (WHERE event_type = 'click') AS kyc_at,
max(ts) FILTER (WHERE event_type = 'view') AS last_login_at, max(event_key) AS last_event_key, count(*) AS events,
CAST(CASE WHEN count(*) FILTER (WHERE event_type IN ('purchase', 'error')) > 0 THEN coalesce(sum(CAST(value AS DECIMAL(18,2)))
FILTER (WHERE event_type = 'purchase'), 0) END AS DECIMAL(18,2)) AS balance, min(ts) FILTER (WHERE event_type = 'purchase') AS funded_at,
max(tx) FILTER (WHERE event_type IN ('purchase', 'error')) AS last_transaction_key FROM k GROUP BY user_id"""
)
def incremental_daily_load(t):
    """History, then the last three days of the log one by one, the very last one twice.

    Users and wallets as the last commit shows them; users without a transaction have no wallet.
    """
    root = scratch(t.spark, "daily")
    last = t.events.agg(F.to_date(F.max("ts"))).first()[0] or EVENTS_AS_OF
    days = [last - dt.timedelta(days=n) for n in (2, 1, 0, 0)]
    daily.backfill(t.events, days[0], root)
    for day in days:
        daily.run_day(t.events, day, root)
    wallets = daily.as_of(t.spark, root, "wallets").drop("last_updated_at")
    users = daily.as_of(t.spark, root, "users")
    both = users.join(wallets, users["user_id"].eqNullSafe(wallets["wallet_id"]), "left")
    return both.drop("wallet_id")
