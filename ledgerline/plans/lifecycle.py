"""Queries over lifecycle facts: milestones, transactions, positions and sessions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.operators import keys, lifecycle, positions, sampling
from ledgerline.plans.registry import query
from ledgerline.plans.views import date_id, with_views
from ledgerline.schemas import STAR, event_type_rows
from ledgerline.sources import readers, standin
from ledgerline.sources.standin import ORDERS_AS_OF, choose

# Market segment -> behaviour segment.
BEHAVIOUR_OF_SEGMENT = {
    "BUILDING": "High_Engagement_High_Balance",
    "MACHINERY": "High_Engagement_Low_Balance",
    "HOUSEHOLD": "Moderate_Engagement_High_Balance",
    "FURNITURE": "Moderate_Engagement_Low_Balance",
    "AUTOMOBILE": "Low_Engagement_Low_Balance",
}


@query(
    with_views("event_types")
    + """SELECT event_id, event_type_code, event_type_category, event_type_stage, is_conversion_milestone, product_area
FROM events LEFT JOIN event_types USING (event_type)"""
)
def event_stage_enrich(t):
    dims = F.broadcast(event_type_rows(t.spark).drop("event_type_id"))
    return standin.event_fact(t).select("event_id", "event_type_code").join(dims, "event_type_code", "left")


@query(
    with_views("milestones")
    + """SELECT user_id, CASE WHEN funded_at < TIMESTAMP '2024-01-02' THEN 'Activated' WHEN kyc_at < TIMESTAMP '2024-01-02'
THEN 'KYC_Completed' ELSE 'Registered' END AS state FROM milestones WHERE signup_at < TIMESTAMP '2024-01-02'"""
)
def user_lifecycle_state(t):
    state = lifecycle.lifecycle_state(F.col("signup_at"), F.col("kyc_at"), F.col("funded_at"), dt.date(2024, 1, 2))
    return standin.user_milestones(t).select("user_id", state.alias("state")).filter(F.col("state").isNotNull())


@query(
    """SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS signup_at, min(ts) FILTER (WHERE event_type = 'view') AS login_at,
min(ts) FILTER (WHERE event_type = 'click') AS kyc_at, min(ts) FILTER (WHERE event_type = 'purchase') AS funded_at,
min(ts) FILTER (WHERE event_type = 'error') AS failed_at FROM events GROUP BY user_id"""
)
def first_event_times(t):
    kinds = {"signup": "signup_at", "view": "login_at", "click": "kyc_at", "purchase": "funded_at", "error": "failed_at"}
    return lifecycle.first_times(t.events, "user_id", "ts", "event_type", kinds)


@query(
    with_views("milestones")
    + """, l AS (SELECT m.user_id, kyc_at, funded_at, max(ts) FILTER (WHERE ts <= kyc_at) AS k, max(ts) FILTER (WHERE ts <= funded_at) AS f
FROM milestones m JOIN events e ON e.user_id = m.user_id AND event_type = 'view' WHERE signup_at IS NOT NULL GROUP BY ALL)
SELECT user_id, datesub('minute', k, kyc_at) AS kyc_gap_minutes, datesub('minute', f, funded_at) AS funding_gap_minutes FROM l"""
)
def onboarding_login_gap(t):
    """Minutes from the last login to KYC and to the first funding."""
    steps = standin.user_milestones(t).filter(F.col("signup_at").isNotNull())
    logins = t.events.filter(F.col("event_type") == "view").select("user_id", "ts")
    ts = F.col("ts")
    latest = logins.join(steps, "user_id").groupBy("user_id").agg(
        *[
            cal.minutes_between(F.max(F.when(ts <= F.col(step), ts)), F.max(step)).alias(f"{name}_gap_minutes")
            for step, name in (("kyc_at", "kyc"), ("funded_at", "funding"))
        ]
    )
    return latest


@query(
    f"""SELECT 967 + row_number() OVER (ORDER BY ts, event_id) AS transaction_id, user_id AS wallet_id, 1::INTEGER AS transaction_type_id,
CAST(value AS DECIMAL(18,2)) AS transaction_amount, CASE event_type WHEN 'purchase' THEN 'success' ELSE 'failure' END AS transaction_status,
ts AS transaction_timestamp, {date_id('ts')} AS transaction_date_id FROM events WHERE event_type IN ('purchase', 'error')"""
)
def transaction_extract(t):
    moves = standin.wallet_transactions(t)
    keyed = keys.dense_key(moves, ["event_time", "event_id"], "transaction_id", after=967, bare=True)
    shaped = keyed.select(
        "transaction_id",
        "wallet_id",
        F.lit(1).alias("transaction_type_id"),
        F.col("amount").alias("transaction_amount"),
        F.col("status").alias("transaction_status"),
        F.col("event_time").alias("transaction_timestamp"),
        cal.date_id(F.col("event_time")).alias("transaction_date_id"),
    )
    return readers.conform(shaped, STAR["fact_transaction"])


@query(
    with_views("positions")
    + f"""SELECT row_number() OVER (ORDER BY start_date, position_key) AS investment_id, user_id, user_id AS wallet_id,
plan_id::INTEGER AS plan_id, amount_invested, CAST(amount_invested + amount_invested * CAST(CAST(rate_min AS DOUBLE) * tenure_days / 36500
 AS DECIMAL(14,12)) AS DECIMAL(18,2)) AS expected_maturity_value, start_date::TIMESTAMP AS investment_start_date,
{date_id('start_date')} AS investment_start_date_id, maturity_date::TIMESTAMP AS investment_maturity_date,
{date_id('maturity_date')} AS investment_maturity_date_id,
CASE WHEN is_redeemed THEN 'Redeemed' WHEN is_withdrawn_early THEN 'Withdrawn_Early' WHEN maturity_date < DATE '2001-06-30' THEN 'Matured'
ELSE 'Active' END AS investment_status, is_withdrawn_early,
CASE WHEN is_withdrawn_early THEN CAST(amount_invested * penalty_pct * 0.01 AS DECIMAL(18,2)) END AS penalty_amount,
CASE WHEN is_redeemed THEN CAST(coalesce(CAST(amount_invested + amount_invested * CAST(CAST(rate_min AS DOUBLE) * tenure_days / 36500
 AS DECIMAL(14,12)) AS DECIMAL(18,2)), amount_invested) - CASE WHEN is_withdrawn_early THEN CAST(amount_invested * penalty_pct * 0.01
 AS DECIMAL(18,2)) ELSE 0 END AS DECIMAL(18,2)) END AS amount_paid_out,
early_withdrawal_date::TIMESTAMP AS early_withdrawal_date, {date_id('early_withdrawal_date')} AS early_withdrawal_date_id,
start_date::TIMESTAMP AS created_at, TIMESTAMP '2001-06-30' AS last_updated_at FROM positions"""
)
def position_extract(t):
    """The full position fact with dense ids in start order."""
    # Only what the fact needs goes through the keying; the amounts are worked out afterwards.
    held = standin.positions(t, owner=True).select(
        "position_key",
        "user_id",
        "plan_id",
        "amount_invested",
        "start_date",
        "maturity_date",
        "early_withdrawal_date",
        "is_withdrawn_early",
        "is_redeemed",
        "tenure_days",
        "interest_rate_min",
        "penalty_rate_pct",
    )
    keyed = _valued(keys.dense_key(held, ["start_date", "position_key"], "investment_id"))
    start, end, early = (F.col(c) for c in ("start_date", "maturity_date", "early_withdrawal_date"))
    shaped = keyed.select(
        "investment_id",
        "user_id",
        F.col("user_id").alias("wallet_id"),
        "plan_id",
        "amount_invested",
        "expected_maturity_value",
        cal.midnight(start).alias("investment_start_date"),
        cal.date_id(start).alias("investment_start_date_id"),
        cal.midnight(end).alias("investment_maturity_date"),
        cal.date_id(end).alias("investment_maturity_date_id"),
        "investment_status",
        "is_withdrawn_early",
        "penalty_amount",
        "amount_paid_out",
        cal.midnight(early).alias("early_withdrawal_date"),
        cal.date_id(early).alias("early_withdrawal_date_id"),
        cal.midnight(start).alias("created_at"),
        cal.ntz(ORDERS_AS_OF).alias("last_updated_at"),
    )
    return readers.conform(shaped, STAR["fact_investment_position"])


def _valued(held):
    """Positions with status, maturity value, penalty and payout."""
    amount = F.col("amount_invested")
    return (
        held.withColumn(
            "investment_status",
            F.when(F.col("is_redeemed"), "Redeemed")
            .when(F.col("is_withdrawn_early"), "Withdrawn_Early")
            .otherwise(positions.status_as_of(F.col("maturity_date"), ORDERS_AS_OF)),
        )
        .withColumn(
            "expected_maturity_value",
            positions.maturity_value(amount, F.col("interest_rate_min"), F.col("tenure_days")),
        )
        .withColumn(
            "penalty_amount", positions.penalty(amount, F.col("penalty_rate_pct"), F.col("is_withdrawn_early"))
        )
        .withColumn(
            "amount_paid_out",
            positions.paid_out(
                F.col("investment_status"), F.col("expected_maturity_value"), amount, F.col("penalty_amount")
            ),
        )
    )


@query(with_views("positions") + "SELECT position_key, start_date, tenure_days::INTEGER AS tenure_days, maturity_date FROM positions")
def position_maturity(t):
    return standin.positions(t).select("position_key", "start_date", "tenure_days", "maturity_date")


@query(
    with_views("positions")
    + """SELECT position_key, CASE WHEN maturity_date < DATE '2001-06-30' THEN 'Matured' ELSE 'Active' END AS status FROM positions"""
)
def position_status_as_of(t):
    status = positions.status_as_of(F.col("maturity_date"), ORDERS_AS_OF)
    return standin.positions(t).select("position_key", status.alias("status"))


@query(
    with_views("positions")
    + """SELECT position_key, CASE WHEN tenure_days IS NULL THEN 'saleable' WHEN maturity_date < DATE '2001-06-30' THEN 'vestable'
ELSE 'active' END AS part FROM positions WHERE tenure_days IS NOT NULL OR start_date <= DATE '2001-06-30' - 90"""
)
def position_split(t):
    """Vestable, saleable and active positions; young open-ended ones belong to none."""
    cutoff = ORDERS_AS_OF - dt.timedelta(days=90)
    open_ended = F.col("tenure_days").isNull()
    part = (
        F.when(~open_ended & (F.col("maturity_date") < F.lit(ORDERS_AS_OF)), "vestable")
        .when(~open_ended, "active")
        .when(F.col("start_date") <= F.lit(cutoff), "saleable")
    )
    return standin.positions(t).select("position_key", part.alias("part")).filter(F.col("part").isNotNull())


@query(with_views("positions") + "SELECT position_key, plan_name, amount_invested FROM positions WHERE maturity_date = DATE '2001-06-29'")
def vested_on_day(t):
    day = ORDERS_AS_OF - dt.timedelta(days=1)
    due = standin.positions(t).filter(F.col("maturity_date") == F.lit(day))
    return due.select("position_key", "plan_name", "amount_invested")


_SALE_SQL = """sales AS (SELECT *, CASE WHEN is_redeemed AND tenure_days IS NULL AND DATE '2001-06-30' - start_date > 200
THEN start_date + 200 END AS sale_date FROM positions)"""


def _with_sales(t):
    sold = positions.sale_date(F.col("start_date"), F.col("maturity_date"), F.col("is_redeemed"), ORDERS_AS_OF)
    return standin.positions(t).withColumn("sale_date", sold)


@query(
    with_views("positions")
    + ", "
    + _SALE_SQL
    + """SELECT position_key, 'vest' AS reason, 'credit' AS direction, maturity_date::TIMESTAMP AS transferred_at, amount_invested
FROM sales WHERE maturity_date IS NOT NULL AND NOT is_withdrawn_early
UNION ALL SELECT position_key, 'early_withdrawal', 'credit', early_withdrawal_date::TIMESTAMP + INTERVAL 24 HOUR, amount_invested
FROM sales WHERE early_withdrawal_date IS NOT NULL
UNION ALL SELECT position_key, 'sale', 'credit', sale_date::TIMESTAMP + INTERVAL 24 HOUR, amount_invested FROM sales WHERE sale_date IS NOT NULL"""
)
def proceeds_transfer(t):
    return positions.proceeds(_with_sales(t))


@query(
    with_views("positions", "cash_flow")
    + """, closed AS (SELECT position_key, user_id, coalesce(early_withdrawal_date, maturity_date)::TIMESTAMP AS closed_at FROM positions
WHERE is_redeemed AND tenure_days IS NOT NULL)
SELECT position_key, closed_at, (SELECT min(event_time) FROM cash_flow WHERE wallet_id = user_id AND direction = 'debit'
 AND status = 'success' AND event_time > closed_at) AS withdrawn_at FROM closed"""
)
def withdrawal_after_redemption(t):
    """The owner's first successful debit after each redemption; null when none follows."""
    closed = positions.closing_date(F.col("maturity_date"), F.col("early_withdrawal_date")).cast("timestamp_ntz")
    redeemed = standin.positions(t, owner=True).withColumn("closed_at", closed)
    redeemed = redeemed.filter(F.col("is_redeemed") & F.col("closed_at").isNotNull()).select("user_id", "position_key", "closed_at")
    debits = standin.cash_flow(t).filter("direction = 'debit' AND status = 'success'")
    return positions.next_debit(redeemed, debits.select(F.col("wallet_id").alias("user_id"), "transaction_id", "event_time"))


PAIRS = """pairs AS (SELECT event_id, user_id AS wallet_id, ts AS failed_at, event_type, min(CASE WHEN event_type = 'purchase' THEN ts END)
OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS success_at
FROM events WHERE event_type IN ('purchase', 'error'))"""


def retry_pairs(t):
    """Each failed funding with the next success of the same wallet."""
    moves = standin.wallet_transactions(t).select("event_id", "wallet_id", "event_time", "status")
    status = F.col("status")
    return lifecycle.retry_pairs(moves, "wallet_id", "event_time", "event_id", status == "failure", status == "success")


@query(
    f"""WITH {PAIRS} SELECT event_id, wallet_id, failed_at, success_at, datesub('minute', failed_at, success_at) AS lag_minutes
FROM pairs WHERE event_type = 'error'"""
)
def withdrawal_retry_pairs(t):
    return retry_pairs(t).select(
        "event_id", "wallet_id", F.col("event_time").alias("failed_at"), "success_at", "lag_minutes"
    )


@query(
    with_views("positions")
    + f"""SELECT position_key, is_withdrawn_early, early_withdrawal_date, {date_id('early_withdrawal_date')} AS early_withdrawal_date_id
FROM positions WHERE maturity_date IS NOT NULL"""
)
def early_withdrawal_request(t):
    """The request date of positions that were withdrawn early, null for the others."""
    return standin.positions(t).filter(F.col("maturity_date").isNotNull()).select(
        "position_key",
        "is_withdrawn_early",
        "early_withdrawal_date",
        cal.date_id(F.col("early_withdrawal_date")).alias("early_withdrawal_date_id"),
    )


@query(
    with_views("positions")
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY maturity_date ASC NULLS LAST, position_key) AS rn
FROM positions WHERE NOT is_withdrawn_early AND NOT is_redeemed AND start_date <= DATE '1995-06-30')
SELECT user_id, position_key, maturity_date FROM ranked WHERE rn = 1 AND maturity_date - DATE '1995-06-30' BETWEEN 0 AND 30
ORDER BY md5(concat('5:', position_key)), position_key LIMIT 5"""
)
def early_withdrawal_candidates(t):
    near = positions.near_maturity(standin.positions(t, owner=True), dt.date(1995, 6, 30), 30)
    return sampling.top_k_random(near.select("user_id", "position_key", "maturity_date"), "position_key", 5, 5)


@query(
    with_views("positions")
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_date, position_key) AS rn
FROM positions WHERE NOT is_withdrawn_early AND NOT is_redeemed AND start_date <= DATE '2001-06-30'),
daily AS (SELECT 'daily' AS rule, position_key, start_date FROM ranked WHERE rn = 1 AND DATE '2001-06-30' - start_date > 180
ORDER BY md5(concat('6:', position_key)), position_key LIMIT 15)
SELECT * FROM daily UNION ALL SELECT 'history', position_key, start_date FROM positions
WHERE tenure_days IS NULL AND NOT is_withdrawn_early AND NOT is_redeemed AND DATE '2001-06-30' - start_date > 200"""
)
def asset_sale_candidates(t):
    """Daily rule: 15 users' oldest positions held over 180 days. History rule: every open-ended one held over 200."""
    columns = ["position_key", "start_date"]
    oldest = positions.long_held(standin.positions(t, owner=True, plan=False), ORDERS_AS_OF, 180)
    daily = sampling.top_k_random(oldest.select(*columns), "position_key", 15, 6)
    held = F.datediff(F.lit(ORDERS_AS_OF), "start_date")
    history = positions.held_by(standin.positions(t), ORDERS_AS_OF).filter(
        F.col("tenure_days").isNull() & (held > positions.SALE_HELD_OVER)
    )
    return daily.select(F.lit("daily").alias("rule"), *columns).unionByName(
        history.select(F.lit("history").alias("rule"), *columns)
    )


@query(
    with_views("positions")
    + ", "
    + _SALE_SQL
    + """SELECT position_key, coalesce(maturity_date, sale_date) AS maturity_date,
CASE WHEN sale_date IS NOT NULL THEN 'Redeemed' WHEN maturity_date < DATE '2001-06-30' THEN 'Matured' ELSE 'Active' END AS status FROM sales"""
)
def asset_sale_redemption(t):
    sold = F.col("sale_date").isNotNull()
    status = F.when(sold, "Redeemed").otherwise(positions.status_as_of(F.col("maturity_date"), ORDERS_AS_OF))
    return _with_sales(t).select(
        "position_key", F.coalesce("maturity_date", "sale_date").alias("maturity_date"), status.alias("status")
    )


@query(
    with_views("positions")
    + """SELECT position_key, CASE WHEN is_withdrawn_early THEN CAST(amount_invested * penalty_pct * 0.01 AS DECIMAL(18,2)) END AS penalty_amount
FROM positions"""
)
def penalty_amount(t):
    return _valued(standin.positions(t)).select("position_key", "penalty_amount")


@query(
    with_views("positions")
    + """SELECT position_key, CAST(amount_invested + amount_invested * CAST(CAST(rate_min AS DOUBLE) * tenure_days / 36500 AS DECIMAL(14,12))
AS DECIMAL(18,2)) AS expected_maturity_value FROM positions"""
)
def expected_maturity_value(t):
    return _valued(standin.positions(t)).select("position_key", "expected_maturity_value")


@query(
    with_views("positions")
    + """, v AS (SELECT *, coalesce(CAST(amount_invested + amount_invested * CAST(CAST(rate_min AS DOUBLE) * tenure_days / 36500
AS DECIMAL(14,12)) AS DECIMAL(18,2)), amount_invested) AS value, CASE WHEN is_withdrawn_early
THEN CAST(amount_invested * penalty_pct * 0.01 AS DECIMAL(18,2)) ELSE 0 END AS penalty FROM positions)
SELECT position_key, CASE WHEN is_redeemed THEN CAST(value - penalty AS DECIMAL(18,2)) END AS amount_paid_out FROM v"""
)
def amount_paid_out(t):
    return _valued(standin.positions(t)).select("position_key", "amount_paid_out")


@query(
    with_views("milestones", "positions")
    + """SELECT m.user_id, CAST(m.funded_at AS DATE) AS activated_on FROM milestones m LEFT JOIN
(SELECT DISTINCT user_id FROM positions WHERE plan_id = 104 AND NOT is_redeemed AND NOT is_withdrawn_early) o ON o.user_id = m.user_id
WHERE o.user_id IS NULL AND CAST(m.funded_at AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-07'"""
)
def activated_without_position(t):
    """Wallets activated one to seven days before January 8 whose owner holds no open mutual fund."""
    as_of = dt.date(2024, 1, 8)
    recent = (F.col("funded_at") >= cal.ntz(as_of - dt.timedelta(days=7))) & (F.col("funded_at") < cal.ntz(as_of))
    activated = standin.user_milestones(t, kyc=False).filter(recent)
    held = standin.positions(t, owner=True)
    owners = held.filter((F.col("plan_id") == 104) & ~F.col("is_redeemed") & ~F.col("is_withdrawn_early")).select("user_id").distinct()
    return activated.join(owners, "user_id", "left_anti").select("user_id", F.to_date("funded_at").alias("activated_on"))


@query(
    """WITH f AS (SELECT o_custkey AS user_id, date_trunc('month', min(o_orderdate)) AS first_month FROM orders GROUP BY 1)
SELECT user_id, CAST(unnest(generate_series(first_month, TIMESTAMP '2001-06-30', INTERVAL 1 MONTH)) AS DATE) AS month FROM f"""
)
def monthly_user_spine(t):
    return lifecycle.month_spine(t.orders.withColumnRenamed("o_custkey", "user_id"), "user_id", "o_orderdate", ORDERS_AS_OF)


@query(
    """WITH b AS (SELECT *, lag(ts) OVER w AS before, max(CASE WHEN event_type = 'view' THEN ts END) OVER
(PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS login_at FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, CAST(sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER
(PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM b)
SELECT user_id, session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events,
count(*) FILTER (WHERE event_type = 'view') AS logins,
count(*) FILTER (WHERE event_type = 'click' AND ts <= login_at + INTERVAL 30 MINUTE) AS reviews_after_login
FROM n GROUP BY user_id, session_no"""
)
def session_login_review(t):
    """Sessions cut at 30 idle minutes, with logins and the reviews that follow a login within 30 minutes."""
    kind, ts = F.col("event_type"), F.col("ts")
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    login = {"login_at": ("max", F.when(kind == "view", ts), True)}
    belongs = (kind == "click") & (ts <= cal.plus(F.col("login_at"), minutes=30))
    measures = {"logins": F.count_if(kind == "view"), "reviews_after_login": F.count_if(belongs)}
    return lifecycle.sessions(events, "user_id", "ts", "event_id", 30, measures, login)


@query(
    """SELECT c_custkey AS user_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'High' WHEN 'MACHINERY' THEN 'High' WHEN 'HOUSEHOLD' THEN 'Moderate'
WHEN 'FURNITURE' THEN 'Moderate' ELSE 'Low' END AS tier FROM customer"""
)
def engagement_tier(t):
    segment = choose(F.col("c_mktsegment"), BEHAVIOUR_OF_SEGMENT)
    return t.customer.select(F.col("c_custkey").alias("user_id"), F.split(segment, "_")[0].alias("tier"))


@query(
    "SELECT c_custkey AS user_id, c_mktsegment AS persona, CASE c_mktsegment "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BEHAVIOUR_OF_SEGMENT.items())
    + " END AS segment FROM customer"
)
def persona_segment_lookup(t):
    """The behaviour segment of each recorded market segment; null for one that is not listed."""
    return t.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("persona"),
        choose(F.col("c_mktsegment"), BEHAVIOUR_OF_SEGMENT).alias("segment"),
    )
