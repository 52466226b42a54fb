"""Financial, behaviour and executive metric queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions.calendar import month_start, ntz
from ledgerline.functions.money import money, ratio, total
from ledgerline.metrics import finance, growth
from ledgerline.operators import keys, skew
from ledgerline.operators.positions import SALE_HELD_OVER
from ledgerline.plans.lifecycle import PAIRS, retry_pairs
from ledgerline.plans.registry import query
from ledgerline.plans.views import with_views
from ledgerline.schemas import DAILY_BANDS, fixed_rows
from ledgerline.sources import standin
from ledgerline.sources.standin import ORDERS_AS_OF

_CLOSED = """, held AS (SELECT *, coalesce(early_withdrawal_date, maturity_date, CASE WHEN is_redeemed THEN start_date + 200 END) AS closed_on
FROM positions)"""


def _held(t, owner: bool = False, started: dt.date | None = ORDERS_AS_OF):
    """Positions started by a day, or all, with their closing day.

    A redeemed open-ended one closes after 200 days.
    """
    started = None if started is None else F.col("l_shipdate") < ntz(started + dt.timedelta(days=1))
    sold = F.when(F.col("is_redeemed"), F.date_add("start_date", SALE_HELD_OVER))
    closed = F.coalesce(F.col("early_withdrawal_date"), F.col("maturity_date"), sold)
    return standin.positions(t, owner=owner, where=started).withColumn("closed_on", closed)


@query(
    with_views("positions")
    + _CLOSED
    + """SELECT CAST(sum(amount_invested) AS DECIMAL(18,2)) AS aum, count(*) AS positions FROM held
WHERE start_date <= DATE '2001-06-30' AND (closed_on IS NULL OR closed_on > DATE '2001-06-30')"""
)
def metric_aum(t):
    return finance.aum(_held(t), ORDERS_AS_OF)


@query(
    with_views("positions")
    + _CLOSED
    + """SELECT c_mktsegment AS persona, CAST(sum(amount_invested) AS DECIMAL(18,2)) AS aum, count(*) AS positions FROM held
JOIN customer ON c_custkey = user_id WHERE start_date <= DATE '2001-06-30' AND (closed_on IS NULL OR closed_on > DATE '2001-06-30') GROUP BY 1"""
)
def metric_aum_by_persona(t):
    per_user = finance.aum(_held(t, owner=True), ORDERS_AS_OF, ["user_id"])
    personas = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("persona"))
    return (
        per_user.join(personas, "user_id")
        .groupBy("persona")
        .agg(total(F.col("aum")).alias("aum"), F.sum("positions").alias("positions"))
    )


_AUM_DAILY = """, days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(DATE '1996-01-01', DATE '2001-06-30', INTERVAL 1 DAY) g(d)),
moves AS (SELECT start_date AS date, amount_invested AS delta FROM held UNION ALL SELECT closed_on, -amount_invested FROM held WHERE closed_on IS NOT NULL),
opening AS (SELECT sum(delta) AS delta FROM moves WHERE date < DATE '1996-01-01'),
aum_daily AS (SELECT days.date, CAST(coalesce((SELECT delta FROM opening), 0) + coalesce(sum(sum(m.delta)) OVER (ORDER BY days.date), 0) AS DECIMAL(18,2)) AS aum
FROM days LEFT JOIN moves m ON m.date = days.date GROUP BY days.date)"""
_FIRST_DAY = dt.date(1996, 1, 1)


@query(with_views("positions") + _CLOSED + _AUM_DAILY + "SELECT date, aum FROM aum_daily")
def metric_aum_daily(t):
    return finance.aum_daily(_held(t), _FIRST_DAY, ORDERS_AS_OF)


_NET = """, net AS (SELECT CAST(date_trunc('month', event_time) AS DATE) AS month, CAST(sum(CASE WHEN status IS DISTINCT FROM 'success' THEN 0
WHEN direction = 'credit' THEN amount ELSE -amount END) AS DECIMAL(18,2)) AS net_deposits FROM cash_flow GROUP BY 1)"""


@query(with_views("cash_flow") + _NET + "SELECT month, net_deposits FROM net")
def metric_net_deposits(t):
    return finance.net_deposits(standin.cash_flow(t))


@query(
    with_views("cash_flow")
    + """SELECT CAST(date_trunc('month', event_time) AS DATE) AS month, o_orderpriority AS transaction_type,
CAST(sum(amount) FILTER (WHERE direction = 'credit') AS DECIMAL(18,2)) AS credit,
CAST(sum(amount) FILTER (WHERE direction = 'debit') AS DECIMAL(18,2)) AS debit FROM cash_flow WHERE status = 'success' GROUP BY ALL"""
)
def metric_cash_flow(t):
    done = standin.cash_flow(t).filter(F.col("status") == "success")
    by = [month_start(F.col("event_time")).alias("month"), F.col("o_orderpriority").alias("transaction_type")]
    return done.groupBy(*by).pivot("direction", ["credit", "debit"]).agg(total(F.col("amount")))


@query(
    """WITH w AS (SELECT c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS b FROM customer)
SELECT c_mktsegment AS segment, count(*) AS wallets, CAST(sum(b) AS DECIMAL(18,2)) AS total_balance,
round(CAST(sum(b) AS DOUBLE) / count(*), 6) AS average_balance FROM w GROUP BY 1
UNION ALL SELECT 'all', count(*), CAST(sum(b) AS DECIMAL(18,2)), round(CAST(sum(b) AS DOUBLE) / count(*), 6) FROM w"""
)
def metric_avg_wallet_balance(t):
    wallets = t.customer.select(F.col("c_mktsegment").alias("segment"), money(F.col("c_acctbal")).alias("balance"))
    return finance.average_balance(wallets, "segment")


@query(
    """WITH a AS (SELECT user_id, event_type, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER
(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS won FROM events WHERE event_type IN ('purchase', 'error'))
SELECT count(*) AS attempts, count(*) FILTER (WHERE event_type = 'error') AS failures,
round(CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / count(*), 6) AS failure_rate,
count(*) FILTER (WHERE event_type = 'error' AND won = 0) AS failures_before_first_success FROM a"""
)
def metric_funding_friction(t):
    won = F.when(F.col("status") == "success", 1)
    attempts = skew.running(
        standin.wallet_transactions(t), ["wallet_id"], ["event_time", "event_id"], {"won": ("count", won, False)}
    )
    failed = F.col("status") == "failure"
    return attempts.agg(
        F.count("*").alias("attempts"),
        F.count_if(failed).alias("failures"),
        F.count_if(failed & (F.coalesce("won", F.lit(0)) == 0)).alias("failures_before_first_success"),
    ).withColumn("failure_rate", ratio(F.col("failures"), F.col("attempts")))


@query(
    f"""WITH {PAIRS} SELECT count(*) AS failures, count(success_at) AS recovered,
round(CAST(count(success_at) AS DOUBLE) / count(*), 6) AS recovery_rate,
round(CAST(sum(datesub('minute', failed_at, success_at)) AS DOUBLE) / count(success_at), 6) AS mean_minutes_to_success
FROM pairs WHERE event_type = 'error'"""
)
def metric_withdrawal_reliability(t):
    found = F.count("success_at")
    return retry_pairs(t).agg(
        F.count("*").alias("failures"),
        found.alias("recovered"),
        ratio(found, F.count("*")).alias("recovery_rate"),
        ratio(F.sum("lag_minutes"), found).alias("mean_minutes_to_success"),
    )


@query(
    with_views("positions")
    + """SELECT plan_name, count(*) AS positions, count(*) FILTER (WHERE is_withdrawn_early) AS withdrawn_early,
round(CAST(count(*) FILTER (WHERE is_withdrawn_early) AS DOUBLE) / count(*), 6) AS early_withdrawal_rate FROM positions GROUP BY 1"""
)
def metric_early_withdrawal_rate(t):
    return (
        standin.positions(t)
        .groupBy("plan_name")
        .agg(F.count("*").alias("positions"), F.count_if("is_withdrawn_early").alias("withdrawn_early"))
        .withColumn("early_withdrawal_rate", ratio(F.col("withdrawn_early"), F.col("positions")))
    )


@query(
    """WITH u AS (SELECT o_custkey, count(*) FILTER (WHERE b) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE b) AS spent,
 DATE '2001-04-01' - CAST(max(o_orderdate) FILTER (WHERE b) AS DATE) AS idle, count(*) FILTER (WHERE NOT b) AS later
 FROM (SELECT *, o_orderdate < TIMESTAMP '2001-04-01' AS b FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-06-30') GROUP BY 1)
SELECT CASE WHEN later > 0 THEN 'retained' ELSE 'churned' END AS outcome, count(*) AS users,
round(CAST(sum(n) AS DOUBLE) / count(*), 6) AS mean_actions, round(CAST(sum(spent) AS DOUBLE) / count(*), 6) AS mean_amount,
round(CAST(sum(idle) AS DOUBLE) / count(*), 6) AS mean_idle_days FROM u WHERE n > 0 GROUP BY 1"""
)
def metric_churn_indicators(t):
    activity = t.orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ts"), money(F.col("o_totalprice")).alias("amount")
    )
    return finance.churn_indicators(activity, dt.date(2001, 4, 1), 90, 90)


@query(
    """WITH l AS (SELECT user_id, count(*) AS logins FROM events WHERE event_type = 'view' GROUP BY 1),
p AS (SELECT o_custkey AS user_id, count(*) AS positions FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
SELECT c_mktsegment AS segment, count(*) AS users, round(corr(logins, coalesce(positions, 0)), 6) AS correlation FROM l
JOIN customer ON c_custkey = user_id LEFT JOIN p USING (user_id) GROUP BY 1"""
)
def metric_engagement_adoption(t):
    logins = t.events.filter(F.col("event_type") == "view").groupBy("user_id").agg(F.count("*").alias("logins"))
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    taken = per_order.join(t.orders, "o_orderkey").groupBy(F.col("o_custkey").alias("user_id")).agg(F.sum("n").alias("positions"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    both = logins.join(users, "user_id").join(taken, "user_id", "left")
    positions = F.coalesce("positions", F.lit(0)).cast("double")
    return both.groupBy("segment").agg(
        F.count("*").alias("users"), F.round(F.corr(F.col("logins").cast("double"), positions), 6).alias("correlation")
    )


@query(
    """WITH u AS (SELECT c_custkey AS user_id, c_acctbal, count(event_id) AS logins FROM customer
LEFT JOIN events ON user_id = c_custkey AND event_type = 'view' GROUP BY ALL)
SELECT user_id, CASE WHEN logins >= 15 THEN 'High' WHEN logins >= 4 THEN 'Moderate' ELSE 'Low' END || '_Engagement_' ||
CASE WHEN c_acctbal >= 5000 THEN 'High' ELSE 'Low' END || '_Balance' AS segment FROM u"""
)
def metric_segmentation(t):
    logins = t.events.filter(F.col("event_type") == "view").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("logins")
    )
    users = t.customer.join(logins, "c_custkey", "left")
    label = finance.segment(F.coalesce("logins", F.lit(0)), F.col("c_acctbal"))
    return users.select(F.col("c_custkey").alias("user_id"), label.alias("segment"))


@query(
    """WITH u AS (SELECT o_custkey AS user_id, max(o_orderdate) AS last_at, count(*) AS frequency,
CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS monetary FROM orders GROUP BY 1)
SELECT user_id, CAST(DATE '2001-08-02' - CAST(last_at AS DATE) AS INTEGER) AS recency_days, frequency, monetary,
CAST(ntile(5) OVER (ORDER BY last_at, user_id) AS INTEGER) AS r, CAST(ntile(5) OVER (ORDER BY frequency, user_id) AS INTEGER) AS f,
CAST(ntile(5) OVER (ORDER BY monetary, user_id) AS INTEGER) AS m FROM u"""
)
def metric_rfm(t):
    users = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.max("o_orderdate").alias("last_at"),
        F.count("*").alias("frequency"),
        total(money(F.col("o_totalprice"))).alias("monetary"),
    )
    users = keys.ntiles(users, "user_id", {"last_at": "r", "frequency": "f", "monetary": "m"}, 5)
    recency = F.datediff(F.lit(dt.date(2001, 8, 2)), "last_at")
    return users.select("user_id", recency.alias("recency_days"), "frequency", "monetary", "r", "f", "m")


@query(
    """WITH n AS (SELECT 'fact_user_event' AS table_name, CAST(ts AS DATE) AS load_date, count(*) AS row_count FROM events GROUP BY ALL
UNION ALL SELECT 'fact_transaction', CAST(o_orderdate AS DATE), count(*) FROM orders GROUP BY ALL
UNION ALL SELECT 'fact_investment_position', CAST(l_shipdate AS DATE), count(*) FROM lineitem GROUP BY ALL)
SELECT table_name, load_date, row_count, row_count BETWEEN lo AND hi AS in_band FROM n JOIN (VALUES ('fact_user_event', 4000, 8000),
('fact_transaction', 2500, 6000), ('fact_investment_position', 200, 800)) b(table_name, lo, hi) USING (table_name)"""
)
def metric_operational_daily(t):
    days = [
        df.groupBy(F.to_date(ts).alias("load_date")).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "load_date", "row_count"
        )
        for name, df, ts in (
            ("fact_user_event", t.events, "ts"),
            ("fact_transaction", t.orders, "o_orderdate"),
            ("fact_investment_position", t.lineitem, "l_shipdate"),
        )
    ]
    bands = fixed_rows(t.spark, DAILY_BANDS, "table_name string, lo bigint, hi bigint")
    counted = days[0].unionByName(days[1]).unionByName(days[2])
    in_band = F.col("row_count").between(F.col("lo"), F.col("hi"))
    return counted.join(F.broadcast(bands), "table_name").select("table_name", "load_date", "row_count", in_band.alias("in_band"))


@query(
    with_views("positions", "cash_flow")
    + _CLOSED
    + _NET
    + """, mm AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
mau AS (SELECT month, count(*) AS active_users FROM mm GROUP BY 1),
su AS (SELECT month, count(*) AS signups FROM (SELECT o_custkey, min(month) AS month FROM mm GROUP BY 1) GROUP BY 1),
ad AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS month, count(DISTINCT user_id) AS investors FROM positions GROUP BY 1),
ch AS (SELECT CAST(p.month + INTERVAL 1 MONTH AS DATE) AS month, round(CAST(count(*) FILTER (WHERE n.month IS NULL) AS DOUBLE) / count(*), 6) AS churn_rate
 FROM mm p LEFT JOIN mm n ON n.o_custkey = p.o_custkey AND n.month = CAST(p.month + INTERVAL 1 MONTH AS DATE) GROUP BY 1),
mv AS (SELECT start_date AS date, amount_invested AS delta FROM held UNION ALL SELECT closed_on, -amount_invested FROM held WHERE closed_on IS NOT NULL),
au AS (SELECT mau.month, CAST(coalesce(sum(delta), 0) AS DECIMAL(18,2)) AS aum FROM mau LEFT JOIN mv ON mv.date <= last_day(mau.month) GROUP BY 1)
SELECT mau.month, coalesce(signups, 0) AS signups, active_users, coalesce(investors, 0) AS investors, aum, net_deposits, churn_rate FROM mau
LEFT JOIN su USING (month) LEFT JOIN ad USING (month) LEFT JOIN au USING (month) LEFT JOIN net USING (month) LEFT JOIN ch USING (month)"""
)
def metric_executive_summary(t):
    """One row per month; every part is reduced to months before the parts are joined."""
    months = growth.active_months(t.orders, "o_custkey", "o_orderdate")
    active = months.groupBy("month").agg(F.count("*").alias("active_users"))
    first = months.groupBy("o_custkey").agg(F.min("month").alias("month"))
    signups = first.groupBy("month").agg(F.count("*").alias("signups"))
    starts = standin.positions(t, owner=True, plan=False)
    investors = starts.groupBy(month_start(F.col("start_date")).alias("month")).agg(
        F.count_distinct("user_id").alias("investors")
    )
    month_end = finance.aum_month_end(_held(t, started=None), active.select("month"))
    churn = growth.retention_churn(t.orders, "o_custkey", "o_orderdate").select("month", "churn_rate")
    summary = active
    for part in (signups, investors, month_end, finance.net_deposits(standin.cash_flow(t)), churn):
        summary = summary.join(part, "month", "left")
    return summary.fillna(0, ["signups", "investors"])
