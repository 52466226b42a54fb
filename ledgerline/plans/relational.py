"""Queries over projections, filters, joins, aggregates, windows, order and sets."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.draws import uniform
from ledgerline.functions.money import money, ratio, signed, total
from ledgerline.operators import keys, lifecycle, positions, sampling, skew
from ledgerline.plans.registry import query
from ledgerline.plans.views import draw, with_views
from ledgerline.schemas import ACQUISITION_CHANNELS, event_type_rows
from ledgerline.sources import standin
from ledgerline.sources.standin import EVENTS_AS_OF, ORDERS_AS_OF

# --- projections and filters ---------------------------------------------------------


@query("SELECT c_mktsegment, c_custkey, c_acctbal FROM customer")
def project_columns(t):
    return t.customer.select("c_mktsegment", "c_custkey", "c_acctbal")


@query("SELECT c_custkey AS wallet_id, 'GBP' AS wallet_currency, 'success' AS status FROM customer")
def project_constant(t):
    return t.customer.select(
        F.col("c_custkey").alias("wallet_id"), F.lit("GBP").alias("wallet_currency"), F.lit("success").alias("status")
    )


@query(
    """SELECT event_id, user_id, ts FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 23:59:59.999999'"""
)
def filter_timestamp_range(t):
    first, last = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12, 23, 59, 59, 999999)
    return t.events.select("event_id", "user_id", "ts").filter(F.col("ts").between(cal.ntz(first), cal.ntz(last)))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def filter_lower_bound(t):
    return t.orders.select("o_orderkey", "o_orderdate").filter(F.col("o_orderdate") >= cal.ntz(dt.date(2000, 1, 1)))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def filter_boolean(t):
    flagged = t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("is_success"))
    return flagged.filter("is_success").select("o_orderkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_equals_string(t):
    return t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


def _customers_with_late_order(t) -> DataFrame:
    late = (
        t.orders.filter(F.col("o_orderdate") >= cal.ntz(dt.date(2001, 1, 1)))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderdate").alias("last_order_at"))
    )
    return t.customer.select("c_custkey", "c_name").join(late, "c_custkey", "left")


_LATE = """WITH late AS (SELECT c_custkey, c_name, max(o_orderdate) AS last_order_at FROM customer
LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY ALL)
"""


@query(_LATE + "SELECT c_custkey, c_name FROM late WHERE last_order_at IS NULL")
def filter_null(t):
    return _customers_with_late_order(t).filter(F.col("last_order_at").isNull()).select("c_custkey", "c_name")


@query(_LATE + "SELECT c_custkey, last_order_at FROM late WHERE last_order_at IS NOT NULL")
def filter_not_null(t):
    found = _customers_with_late_order(t).filter(F.col("last_order_at").isNotNull())
    return found.select("c_custkey", "last_order_at")


@query("SELECT event_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def filter_cast_date_equals(t):
    on_day = t.events.filter(cal.within_day(F.col("ts"), dt.date(2024, 1, 15)))
    return on_day.select("event_id", "event_type", "value")


@query(
    """SELECT event_id, user_id FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-31' - 7 AND DATE '2024-01-31' - 1"""
)
def filter_relative_date_window(t):
    first = EVENTS_AS_OF - dt.timedelta(days=7)
    recent = t.events.filter((F.col("ts") >= cal.ntz(first)) & (F.col("ts") < cal.ntz(EVENTS_AS_OF)))
    return recent.select("event_id", "user_id")


@query(
    """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
)
def filter_in_set(t):
    overdrawn = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(overdrawn, "o_custkey", "left_semi")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY'")
def filter_disjunction(t):
    return t.customer.select("c_custkey", "c_mktsegment").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '2000-06-01'"""
)
def filter_conjunction(t):
    rows = t.lineitem.filter(
        F.col("l_returnflag").isNotNull()
        & (F.col("l_linestatus") == "O")
        & (F.col("l_shipdate") >= cal.ntz(dt.date(2000, 6, 1)))
    )
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS size_class,
CASE WHEN l_returnflag = 'R' THEN TRUE ELSE FALSE END AS is_returned FROM lineitem"""
)
def case_when(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") > 25, "large").otherwise("small").alias("size_class"),
        F.when(F.col("l_returnflag") == "R", True).otherwise(False).alias("is_returned"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN 'X' ELSE o_orderstatus END
AS o_orderstatus FROM orders"""
)
def masked_update(t):
    mask = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 100000)
    status = F.when(mask, F.lit("X")).otherwise(F.col("o_orderstatus"))
    return t.orders.withColumn("o_orderstatus", status).select("o_orderkey", "o_orderstatus")


@query(
    """SELECT user_id, coalesce(max(ts) FILTER (WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-03'), min(ts))
AS reference_at FROM events GROUP BY user_id"""
)
def coalesce_fallback(t):
    early_login = F.when((F.col("event_type") == "view") & (F.col("ts") < cal.ntz(dt.date(2024, 1, 3))), F.col("ts"))
    return t.events.groupBy("user_id").agg(F.coalesce(F.max(early_login), F.min("ts")).alias("reference_at"))


# --- joins ----------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders JOIN
(SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON c_custkey = o_custkey"""
)
def join_inner_key_restrict(t):
    wanted = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(wanted.distinct(), "o_custkey")


@query(
    with_views("positions")
    + "SELECT position_key, user_id, plan_name, amount_invested, start_date, maturity_date FROM positions"
)
def join_star_three_way(t):
    return standin.positions(t, owner=True).select(
        "position_key", "user_id", "plan_name", "amount_invested", "start_date", "maturity_date"
    )


@query(
    with_views("positions")
    + """SELECT DISTINCT p.user_id, c.c_mktsegment AS segment FROM positions p JOIN customer c ON c.c_custkey = p.user_id
WHERE NOT is_redeemed AND NOT is_withdrawn_early AND (maturity_date IS NULL OR maturity_date >= DATE '2001-06-30')"""
)
def join_active_positions_user(t):
    still_on = F.col("maturity_date").isNull() | (F.col("maturity_date") >= F.lit(ORDERS_AS_OF))
    active = standin.positions(t, owner=True).filter(
        ~F.col("is_redeemed") & ~F.col("is_withdrawn_early") & still_on
    )
    users = active.select("user_id").dropDuplicates(["user_id"])
    segments = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return users.join(segments, "user_id")


@query(
    with_views("positions")
    + """SELECT a.user_id, a.plan_id, a.invested, b.early_count FROM
(SELECT user_id, plan_id, CAST(sum(amount_invested) AS DECIMAL(18,2)) AS invested FROM positions GROUP BY ALL) a JOIN
(SELECT user_id, plan_id, count(*) AS early_count FROM positions WHERE is_withdrawn_early GROUP BY ALL) b
ON a.user_id = b.user_id AND a.plan_id = b.plan_id"""
)
def join_multi_key(t):
    held = standin.positions(t, owner=True)
    pair = ["user_id", "plan_id"]
    invested = held.groupBy(*pair).agg(total(F.col("amount_invested")).alias("invested"))
    early = held.filter("is_withdrawn_early").groupBy(*pair).agg(F.count("*").alias("early_count"))
    return invested.join(early, pair)


@query(
    """SELECT o_orderkey, c_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def join_inner_merge(t):
    users = t.customer.select("c_custkey", "c_name")
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return orders.join(users, "c_custkey")


@query(
    """SELECT c_custkey, c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS spent
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey, c_name"""
)
def join_left(t):
    spent = (
        t.orders.filter(F.col("o_orderstatus") == "F")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(total(money(F.col("o_totalprice"))).alias("spent"))
    )
    return t.customer.select("c_custkey", "c_name").join(spent, "c_custkey", "left")


@query(
    """SELECT c_custkey FROM customer LEFT JOIN (SELECT o_custkey FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-06-23' AND o_orderdate < TIMESTAMP '2001-06-30') ON o_custkey = c_custkey
WHERE o_custkey IS NULL"""
)
def join_anti(t):
    week = t.orders.filter(
        (F.col("o_orderdate") >= cal.ntz(ORDERS_AS_OF - dt.timedelta(days=7)))
        & (F.col("o_orderdate") < cal.ntz(ORDERS_AS_OF))
    )
    return t.customer.select("c_custkey").join(week.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def join_semi(t):
    big = t.orders.filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_acctbal").join(big, "c_custkey", "left_semi")


@query(f"SELECT o_orderkey, o_orderdate FROM orders WHERE NOT {draw(7, 'o_orderkey')} < 0.3")
def join_complement_rows(t):
    chosen = sampling.sample_fraction(t.orders.select("o_orderkey"), ["o_orderkey"], 0.3, 7)
    return t.orders.select("o_orderkey", "o_orderdate").join(chosen, "o_orderkey", "left_anti")


@query(
    with_views("event_types")
    + "SELECT event_id, event_type_id, event_type_code FROM events LEFT JOIN event_types USING (event_type)"
)
def join_lookup_broadcast(t):
    dims = F.broadcast(event_type_rows(t.spark).select("event_type_code", "event_type_id"))
    return standin.event_fact(t).select("event_id", "event_type_code").join(dims, "event_type_code", "left")


@query(
    with_views("positions")
    + """SELECT position_key, o_orderdate::DATE AS order_date, year(start_date)::INTEGER AS start_year,
quarter(maturity_date)::INTEGER AS maturity_quarter FROM positions LEFT JOIN orders ON o_orderkey = order_key"""
)
def join_role_playing_date(t):
    """The order, start and maturity dates in their roles; no calendar bounds the years."""
    orders = t.orders.select(F.col("o_orderkey").alias("order_key"), F.to_date("o_orderdate").alias("order_date"))
    return standin.positions(t).join(orders, "order_key", "left").select(
        "position_key",
        "order_date",
        F.year("start_date").alias("start_year"),
        F.quarter("maturity_date").alias("maturity_quarter"),
    )


@query(
    with_views("event_types")
    + """SELECT event_id, user_id, c_mktsegment AS segment, event_type_stage, isodow(ts) IN (6, 7) AS is_weekend
FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN event_types USING (event_type)"""
)
def join_star_enrich(t):
    kinds = F.broadcast(event_type_rows(t.spark).select("event_type_code", "event_type_stage"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    events = standin.event_fact(t).select(
        "event_id", "user_id", "event_type_code", cal.is_weekend(F.to_date("event_time")).alias("is_weekend")
    )
    return (
        events.join(kinds, "event_type_code", "left")
        .join(users, "user_id", "left")
        .select("event_id", "user_id", "segment", "event_type_stage", "is_weekend")
    )


@query(
    """SELECT event_id, user_id, ts, max(CASE WHEN event_type = 'view' THEN ts END)
OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_login_at FROM events"""
)
def join_asof_last_login(t):
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    is_login = F.col("event_type") == "view"
    return lifecycle.with_last_login(events, "user_id", "ts", "event_id", is_login).drop("event_type")


@query(
    f"""WITH w(channel, lo, hi) AS (VALUES ('Organic Search', 0.0, 0.25), ('Paid Social', 0.25, 0.45),
('Referral Program', 0.45, 0.65), ('Direct Traffic', 0.65, 0.8), ('Paid Search', 0.8, 0.9), ('Partnerships', 0.9, 1.0))
SELECT c_custkey, channel FROM customer JOIN w ON {draw('channel', 'c_custkey')} >= CAST(lo AS DOUBLE)
AND {draw('channel', 'c_custkey')} < CAST(hi AS DOUBLE)"""
)
def join_range_weight_bucket(t):
    u = uniform("channel", F.col("c_custkey"))
    return sampling.range_bucket(t.customer.select("c_custkey"), u, ACQUISITION_CHANNELS, "channel")


# --- aggregates -----------------------------------------------------------------------


@query("SELECT coalesce(max(o_orderkey), 0) AS max_o_orderkey FROM orders")
def agg_global_max_default(t):
    return keys.high_water_mark(t.orders, "o_orderkey")


@query("SELECT count(*) AS purchases FROM events WHERE event_type = 'purchase' AND value > 50")
def agg_count_where(t):
    hit = (F.col("event_type") == "purchase") & (F.col("value") > 50)
    return t.events.agg(F.count_if(hit).alias("purchases"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def agg_value_counts(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT CAST(ts AS DATE) AS day FROM events")
def agg_distinct(t):
    return t.events.select(F.to_date("ts").alias("day")).distinct()


@query(
    _LATE
    + """SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey, count(*) FILTER (WHERE c_name IS NULL) AS c_name,
count(*) FILTER (WHERE last_order_at IS NULL) AS last_order_at FROM late"""
)
def agg_null_count(t):
    df = _customers_with_late_order(t)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


@query(
    """SELECT o_orderstatus, o_orderpriority, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6)
AS share FROM orders GROUP BY o_orderstatus, o_orderpriority"""
)
def agg_group_share(t):
    counted = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("o_orderstatus"))
    return counted.select("o_orderstatus", "o_orderpriority", ratio(F.col("n"), whole).alias("share"))


@query(
    """SELECT o_custkey AS wallet_id, max(o_orderdate) AS last_at, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_id
FROM orders GROUP BY o_custkey"""
)
def agg_min_max_by(t):
    return t.orders.groupBy(F.col("o_custkey").alias("wallet_id")).agg(
        F.max("o_orderdate").alias("last_at"),
        F.max(F.struct("o_orderdate", "o_orderkey"))["o_orderkey"].alias("last_id"),
    )


@query(
    """SELECT r_name, n_name, CAST(grouping(r_name, n_name) AS INTEGER) AS level, count(*) AS orders,
CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS volume
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name)"""
)
def agg_rollup_executive(t):
    # Orders are summed per customer, then per nation, before any name is joined.
    per_user = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.sum(money(F.col("o_totalprice"))).alias("v")
    )
    per_nation = per_user.join(t.customer, "c_custkey").groupBy("c_nationkey").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    named = per_nation.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return named.rollup("r_name", "n_name").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n").alias("orders"), total(F.col("v")).alias("volume")
    )


# --- windows --------------------------------------------------------------------------


@query(
    with_views("positions")
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY maturity_date ASC NULLS LAST, position_key) AS rn
FROM positions WHERE NOT is_withdrawn_early AND NOT is_redeemed AND start_date <= DATE '1995-06-30')
SELECT user_id, position_key, maturity_date, CAST(maturity_date - DATE '1995-06-30' AS INTEGER) AS days_left FROM ranked
WHERE rn = 1 AND maturity_date - DATE '1995-06-30' BETWEEN 0 AND 30"""
)
def window_first_per_user_maturity(t):
    # Early in the history: later on nearly every user has an overdue position.
    near = positions.near_maturity(standin.positions(t, owner=True), dt.date(1995, 6, 30), 30)
    return near.select("user_id", "position_key", "maturity_date", "days_left")


@query(
    with_views("positions")
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_date, position_key) AS rn
FROM positions WHERE NOT is_withdrawn_early AND NOT is_redeemed AND start_date <= DATE '2001-06-30')
SELECT user_id, position_key, start_date, CAST(DATE '2001-06-30' - start_date AS INTEGER) AS days_held FROM ranked
WHERE rn = 1 AND DATE '2001-06-30' - start_date > 180"""
)
def window_first_per_user_start(t):
    # Neither rank nor filter needs the plan, so the part table is never read.
    held = positions.long_held(standin.positions(t, owner=True, plan=False), ORDERS_AS_OF, 180)
    return held.select("user_id", "position_key", "start_date", "days_held")


@query("SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id FROM orders")
def surrogate_key_dense(t):
    return keys.dense_key(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "order_id", bare=True)


@query(
    """SELECT event_id AS source_id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 0
ELSE (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-20') END
+ row_number() OVER (PARTITION BY coalesce(ts < TIMESTAMP '2024-01-20', false) ORDER BY ts NULLS FIRST, event_id) AS event_key FROM events"""
)
def surrogate_key_continue(t):
    """Events without a time are keyed with the arrivals, before them."""
    events = t.events.select(F.col("event_id").alias("source_id"), "ts")
    cut = cal.ntz(dt.date(2024, 1, 20))
    early = F.coalesce(F.col("ts") < cut, F.lit(False))
    stored = keys.dense_key(events.filter(early), ["ts", "source_id"], "event_key", bare=True)
    added = keys.continue_keys(stored, events.filter(~early), ["ts", "source_id"], "event_key", bare=True)
    return stored.unionByName(added).select("source_id", "event_key")


@query(
    """SELECT event_id, CASE WHEN event_type IN ('purchase', 'error') THEN 967 + row_number() OVER
(PARTITION BY event_type IN ('purchase', 'error') ORDER BY ts, event_id) END AS transaction_id FROM events"""
)
def surrogate_key_conditional(t):
    moves = F.col("event_type").isin("purchase", "error")
    keyed = keys.conditional_key(t.events.select("event_id", "ts", "event_type"), moves, ["ts", "event_id"], "transaction_id", after=967)
    return keyed.select("event_id", "transaction_id")


@query(
    """SELECT event_id, user_id AS wallet_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2))
ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS balance
FROM events WHERE event_type IN ('purchase', 'error')"""
)
def running_wallet_balance(t):
    moves = signed(F.col("amount"), F.col("direction"), F.col("status"))
    ledger = skew.running(
        standin.wallet_transactions(t), ["wallet_id"], ["event_time", "event_id"], {"balance": ("sum", moves, True)}
    )
    return ledger.select("event_id", "wallet_id", "balance")


# --- order, limit, sets ------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def sort_total(t):
    return t.orders.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey")


@query("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 10")
def limit_n(t):
    return t.events.select("event_id", "ts").orderBy("ts", "event_id").limit(10)


@query("SELECT o_orderkey FROM orders ORDER BY md5(concat('42:', o_orderkey)), o_orderkey LIMIT 15")
def random_top_k(t):
    return sampling.top_k_random(t.orders.select("o_orderkey"), "o_orderkey", 15, 42)


@query(
    """SELECT user_id, CAST(date_trunc('month', ts) AS DATE) AS month, string_agg(strftime(ts, '%Y%m%d%H%M%S'), ',' ORDER BY ts) AS times
FROM events WHERE event_type = 'view' GROUP BY ALL"""
)
def array_sorted(t):
    """Sorted login times per user and month: what one list holds is bounded by the month."""
    logins = t.events.filter(F.col("event_type") == "view")
    months = logins.groupBy("user_id", cal.month_start(F.col("ts")).alias("month")).agg(
        F.array_sort(F.collect_list("ts")).alias("sorted")
    )
    text = F.transform("sorted", lambda ts: F.date_format(ts, "yyyyMMddHHmmss"))
    return months.select("user_id", "month", F.array_join(text, ",").alias("times"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def union_all_frames(t):
    """Frames of three listed statuses and of all other rows, the null ones too, put back together."""
    orders, status = t.orders.select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus")
    listed = ("F", "O", "P")
    other = orders.filter(~F.coalesce(status.isin(*listed), F.lit(False)))
    return reduce(DataFrame.unionByName, [*(orders.filter(status == s) for s in listed), other])


@query(
    """SELECT 'login' AS block, user_id, ts AS event_time, CAST(NULL AS DECIMAL(18,2)) AS amount FROM events WHERE event_type = 'view'
UNION ALL SELECT 'funding', user_id, ts, CAST(value AS DECIMAL(18,2)) FROM events WHERE event_type IN ('purchase', 'error')
UNION ALL SELECT 'plan_created', o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) FROM orders"""
)
def union_event_streams(t):
    events, orders = t.events, t.orders
    who = [F.col("user_id"), F.col("ts").alias("event_time")]
    blocks = [
        events.filter(F.col("event_type") == "view").select(F.lit("login").alias("block"), *who),
        events.filter(F.col("event_type").isin("purchase", "error")).select(
            F.lit("funding").alias("block"), *who, money(F.col("value")).alias("amount")
        ),
        orders.select(
            F.lit("plan_created").alias("block"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("event_time"),
            money(F.col("o_totalprice")).alias("amount"),
        ),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), blocks)


@query(
    """SELECT o_orderkey, s.step, o_orderdate + to_minutes(CAST(s.offset_min AS INTEGER)) AS event_time FROM orders,
(VALUES ('review_plan_options', 5), ('plan_selected', 12), ('savings_plan_created', 20)) s(step, offset_min)"""
)
def explode_actions(t):
    """One funding becomes review, selection and creation, each some minutes after the one before."""
    steps = [("review_plan_options", 5), ("plan_selected", 7), ("savings_plan_created", 8)]
    reached, actions = 0, []
    for step, minutes in steps:
        reached += minutes
        at = cal.plus(F.col("o_orderdate"), minutes=reached)
        actions.append(F.struct(F.lit(step).alias("step"), at.alias("event_time")))
    return t.orders.select("o_orderkey", F.inline(F.array(*actions)))


@query(
    """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders EXCEPT ALL
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'"""
)
def except_rows(t):
    # The row key takes part, so that no group of equal rows can grow large.
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    done = orders.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus")
    return orders.drop("o_orderstatus").exceptAll(done)
