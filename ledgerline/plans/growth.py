"""Growth and product metric queries."""

from __future__ import annotations


from pyspark.sql import functions as F

from ledgerline.functions.calendar import month_start
from ledgerline.functions.money import ratio
from ledgerline.metrics import growth
from ledgerline.plans.registry import query
from ledgerline.plans.views import with_views
from ledgerline.schemas import EVENT_TYPES, PLANS
from ledgerline.sources import standin
from ledgerline.sources.standin import EVENT_CODES, EVENTS_AS_OF, ORDERS_AS_OF, choose


@query(
    """SELECT day, count(*) AS signups FROM (SELECT user_id, CAST(min(ts) AS DATE) AS day FROM events
WHERE event_type = 'signup' GROUP BY user_id) GROUP BY day"""
)
def metric_signups(t):
    first = t.events.filter(F.col("event_type") == "signup").groupBy("user_id").agg(F.to_date(F.min("ts")).alias("day"))
    return first.groupBy("day").agg(F.count("*").alias("signups"))


@query(
    with_views("milestones")
    + """SELECT count(*) AS signups, count(funded_at) AS activated, round(CAST(count(funded_at) AS DOUBLE) / count(*), 6) AS activation_rate
FROM milestones WHERE signup_at IS NOT NULL"""
)
def metric_activation_rate(t):
    return growth.activation(standin.user_milestones(t, kyc=False))


def _segments(t):
    return t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))


@query(
    with_views("milestones")
    + """SELECT c_mktsegment AS channel, count(*) AS signups, count(funded_at) AS activated,
round(CAST(count(funded_at) AS DOUBLE) / count(*), 6) AS activation_rate
FROM milestones JOIN customer ON c_custkey = user_id WHERE signup_at IS NOT NULL GROUP BY 1"""
)
def metric_activation_by_channel(t):
    users = standin.user_milestones(t, kyc=False).join(_segments(t).withColumnRenamed("segment", "channel"), "user_id")
    return growth.activation(users, ["channel"])


@query(
    with_views("milestones")
    + """, m AS (SELECT datesub('minute', signup_at, funded_at) AS minutes FROM milestones WHERE funded_at IS NOT NULL)
SELECT count(*) AS users, quantile_cont(minutes::DOUBLE, 0.25) AS p25_minutes, quantile_cont(minutes::DOUBLE, 0.5) AS median_minutes,
quantile_cont(minutes::DOUBLE, 0.75) AS p75_minutes FROM m"""
)
def metric_time_to_first_funding(t):
    return growth.time_to_first_funding(standin.user_milestones(t, kyc=False))


@query(
    """SELECT 'events' AS source, CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS active_users FROM events GROUP BY ALL
UNION ALL SELECT 'orders', CAST(date_trunc('month', o_orderdate) AS DATE), count(DISTINCT o_custkey) FROM orders GROUP BY ALL"""
)
def metric_mau(t):
    events = growth.monthly_active(t.events, "user_id", "ts").withColumn("source", F.lit("events"))
    orders = growth.monthly_active(t.orders, "o_custkey", "o_orderdate").withColumn("source", F.lit("orders"))
    return events.unionByName(orders).select("source", "month", "active_users")


@query(
    """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), n AS (SELECT day, count(*) AS dau FROM d GROUP BY day)
SELECT n.day, n.dau, count(DISTINCT d.user_id) AS wau, round(CAST(n.dau AS DOUBLE) / count(DISTINCT d.user_id), 6) AS stickiness
FROM n JOIN d ON d.day BETWEEN n.day - 6 AND n.day GROUP BY n.day, n.dau"""
)
def metric_dau_wau(t):
    return growth.daily_weekly_active(t.events, "user_id", "ts")


@query(
    """WITH m AS (SELECT user_id, date_trunc('month', ts) AS month, count(*) AS logins FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT c_mktsegment AS segment, CAST(sum(logins) AS BIGINT) AS logins, count(*) AS user_months,
round(CAST(sum(logins) AS DOUBLE) / count(*), 6) AS logins_per_user_month FROM m JOIN customer ON c_custkey = user_id GROUP BY 1"""
)
def metric_login_frequency(t):
    per_month = (
        t.events.filter(F.col("event_type") == "view")
        .groupBy("user_id", month_start(F.col("ts")).alias("month"))
        .agg(F.count("*").alias("n"))
    )
    per_user = per_month.groupBy("user_id").agg(F.sum("n").alias("n"), F.count("*").alias("months"))
    return (
        per_user.join(_segments(t), "user_id")
        .groupBy("segment")
        .agg(F.sum("n").alias("logins"), F.sum("months").alias("user_months"))
        .withColumn("logins_per_user_month", ratio(F.col("logins"), F.col("user_months")))
    )


def _signup_days(t):
    signups = t.events.filter(F.col("event_type") == "signup")
    return signups.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("signup_day"))


def _order_cohort(t):
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ts"))
    return orders, orders.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("signup_day"))


_RETENTION_SQL = """SELECT h.h::INTEGER AS horizon_days{by}, count(*) AS eligible_users, count(a.day) AS retained_users,
round(CAST(count(a.day) AS DOUBLE) / count(*), 6) AS retention_rate FROM s CROSS JOIN (VALUES {horizons}) h(h)
LEFT JOIN (SELECT DISTINCT {user} AS user_id, CAST({ts} AS DATE) AS day FROM {table}) a ON a.user_id = s.user_id AND a.day = s.day + h.h
{join} WHERE s.day + h.h < DATE '{as_of}' GROUP BY ALL"""

_EVENT_SIGNUPS = "WITH s AS (SELECT user_id, CAST(min(ts) AS DATE) AS day FROM events WHERE event_type = 'signup' GROUP BY 1) "


@query(
    "WITH s AS (SELECT user_id, CAST(min(ts) AS DATE) AS day FROM events WHERE event_type = 'signup' GROUP BY 1),"
    " o AS (SELECT o_custkey AS user_id, CAST(min(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1),"
    " e AS ("
    + _RETENTION_SQL.format(
        by="", horizons="(1), (7), (29)", user="user_id", ts="ts", table="events", join="", as_of="2024-01-31"
    )
    + "), r AS ("
    + _RETENTION_SQL.format(
        by="", horizons="(30), (90)", user="o_custkey", ts="o_orderdate", table="orders", join="", as_of="2001-06-30"
    ).replace("FROM s CROSS", "FROM o s CROSS")
    + ") SELECT 'events' AS source, * FROM e UNION ALL SELECT 'orders', * FROM r"
)
def metric_retention_day_n(t):
    """Events reach to day 29, the longer horizons come from the orders."""
    events = growth.retention(_signup_days(t), t.events, "user_id", "ts", [1, 7, 29], EVENTS_AS_OF)
    activity, cohort = _order_cohort(t)
    orders = growth.retention(cohort, activity, "user_id", "ts", [30, 90], ORDERS_AS_OF)
    return events.withColumn("source", F.lit("events")).unionByName(orders.withColumn("source", F.lit("orders")))


@query(
    _EVENT_SIGNUPS
    + _RETENTION_SQL.format(
        by=", c_mktsegment AS segment", horizons="(7), (14)", user="user_id", ts="ts", table="events",
        join="JOIN customer ON c_custkey = s.user_id", as_of="2024-01-31",
    )
)
def metric_retention_by_segment(t):
    signups = _signup_days(t).join(_segments(t), "user_id")
    return growth.retention(signups, t.events, "user_id", "ts", [7, 14], EVENTS_AS_OF, by=["segment"])


@query(
    """WITH m AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
f AS (SELECT o_custkey, min(month) AS cohort_month FROM m GROUP BY 1), z AS (SELECT cohort_month, count(*) AS cohort_size FROM f GROUP BY 1)
SELECT *, round(CAST(active_users AS DOUBLE) / cohort_size, 6) AS share FROM (SELECT cohort_month,
CAST(datediff('month', cohort_month, month) AS INTEGER) AS months_since, count(*) AS active_users
FROM m JOIN f USING (o_custkey) GROUP BY ALL) JOIN z USING (cohort_month)"""
)
def metric_cohort_matrix(t):
    return growth.cohorts(t.orders, "o_custkey", "o_orderdate")


@query(
    """WITH m AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
j AS (SELECT CAST(p.month + INTERVAL 1 MONTH AS DATE) AS month, n.month IS NOT NULL AS back FROM m p
LEFT JOIN m n ON n.o_custkey = p.o_custkey AND n.month = CAST(p.month + INTERVAL 1 MONTH AS DATE))
SELECT month, count(*) AS previous_users, count(*) FILTER (WHERE back) AS retained_users, count(*) FILTER (WHERE NOT back) AS churned_users,
round(CAST(count(*) FILTER (WHERE back) AS DOUBLE) / count(*), 6) AS retention_rate,
round(CAST(count(*) FILTER (WHERE NOT back) AS DOUBLE) / count(*), 6) AS churn_rate
FROM j WHERE month <= (SELECT max(month) FROM m) GROUP BY month"""
)
def metric_retention_churn_rate(t):
    return growth.retention_churn(t.orders, "o_custkey", "o_orderdate")


_FUNNEL_TAIL = """, c AS (SELECT {counts} FROM f), r AS ({rows})
SELECT step_no, step, users, round(CAST(users AS DOUBLE) / nullif(lag(users, 1, users) OVER (ORDER BY step_no), 0), 6) AS step_rate,
round(CAST(users AS DOUBLE) / nullif(first(users) OVER (ORDER BY step_no), 0), 6) AS total_rate FROM r"""


def funnel_sql(times: str, steps: list[tuple[str, str]]) -> str:
    """Oracle of a funnel: ``times`` defines view f, each step is (name, condition)."""
    counts = ", ".join(f"count(*) FILTER (WHERE {condition}) AS s{i}" for i, (_, condition) in enumerate(steps))
    rows = " UNION ALL ".join(
        f"SELECT {i + 1}::INTEGER AS step_no, '{name}' AS step, s{i} AS users FROM c" for i, (name, _) in enumerate(steps)
    )
    return times + _FUNNEL_TAIL.format(counts=counts, rows=rows)


@query(
    funnel_sql(
        "WITH " + """f AS (SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS a, min(ts) FILTER (WHERE event_type = 'click') AS b,
min(ts) FILTER (WHERE event_type = 'purchase') AS c, min(ts) FILTER (WHERE event_type = 'view') AS d FROM events GROUP BY 1)""",
        [("Acquisition", "a IS NOT NULL"), ("Onboarding", "b >= a"), ("Activation", "b >= a AND c >= b"),
         ("Engagement", "b >= a AND c >= b AND d >= c")],
    )
)
def metric_funnel_lifecycle(t):
    """First times in the order of the lifecycle; a user out of order drops out of the funnel."""
    kinds = {"signup": "a", "click": "b", "purchase": "c", "view": "d"}
    times = t.events.groupBy("user_id").agg(
        *[F.min(F.when(F.col("event_type") == k, F.col("ts"))).alias(n) for k, n in kinds.items()]
    )
    steps = [("Acquisition", F.col("a")), ("Onboarding", F.col("b")), ("Activation", F.col("c")), ("Engagement", F.col("d"))]
    return growth.ordered_funnel(times, steps)


def _adoption_times(t, plan_ids: list[int]):
    """Milestones per user with the first position in the given plans.

    Positions date from years before the events, so their first start is moved by 29 years to
    fall among the events.
    """
    parts = t.part.select(
        F.col("p_partkey").alias("l_partkey"), choose(F.col("p_type"), standin.PLAN_OF_TYPE).alias("plan_id")
    ).filter(F.col("plan_id").isin(plan_ids))
    first = (
        t.lineitem.join(parts, "l_partkey")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("start_at"))
        .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")), "l_orderkey")
        .groupBy("user_id")
        .agg((F.min("start_at") + F.expr("interval 29 year")).alias("adopted_at"))
    )
    return standin.user_milestones(t).join(first, "user_id", "left")


def _adoption_sql(plan_ids: str, last: str) -> str:
    return funnel_sql(
        with_views("positions", "milestones")
        + f""", f AS (SELECT m.*, p.adopted_at FROM milestones m LEFT JOIN (SELECT user_id, min(start_date)::TIMESTAMP + INTERVAL 29 YEAR AS adopted_at
FROM positions WHERE plan_id IN ({plan_ids}) GROUP BY 1) p ON p.user_id = m.user_id)""",
        [
            ("signup", "signup_at IS NOT NULL"),
            ("kyc_completed", "kyc_at >= signup_at"),
            ("wallet_funded", "kyc_at >= signup_at AND funded_at >= kyc_at"),
            (last, "kyc_at >= signup_at AND funded_at >= kyc_at AND adopted_at >= funded_at"),
        ],
    )


def _adoption_funnel(t, plan_ids: list[int], last: str):
    steps = [
        ("signup", F.col("signup_at")),
        ("kyc_completed", F.col("kyc_at")),
        ("wallet_funded", F.col("funded_at")),
        (last, F.col("adopted_at")),
    ]
    return growth.ordered_funnel(_adoption_times(t, plan_ids), steps)


@query(_adoption_sql("101, 102", "savings_plan_created"))
def metric_funnel_savings(t):
    return _adoption_funnel(t, [101, 102], "savings_plan_created")


@query(_adoption_sql("103, 104", "investment_plan_created"))
def metric_funnel_investment(t):
    return _adoption_funnel(t, [103, 104], "investment_plan_created")


@query(
    funnel_sql(
        with_views("event_types")
        + ", f AS (SELECT user_id, list(DISTINCT event_type_stage) AS stages FROM events JOIN event_types USING (event_type) GROUP BY 1)",
        [(s, f"list_contains(stages, '{s}')") for s in ("Acquisition", "Activation", "Consideration", "Engagement")],
    )
)
def metric_funnel_unordered(t):
    stage_of_code = {row[1]: row[3] for row in EVENT_TYPES}
    stages = {kind: stage_of_code[code] for kind, code in EVENT_CODES.items()}
    stage = choose(F.col("event_type"), stages)
    names = ["Acquisition", "Activation", "Consideration", "Engagement"]
    flags = t.events.groupBy("user_id").agg(*[F.max(stage == n).alias(n) for n in names])
    return growth.reach_funnel(flags, [(n, F.col(n)) for n in names])


@query(
    with_views("positions", "milestones")
    + """, a AS (SELECT user_id, bool_or(plan_category = 'Savings') AS s, bool_or(plan_category = 'Investments') AS i FROM positions GROUP BY 1), u AS (SELECT m.user_id, coalesce(s, FALSE) AS s, coalesce(i, FALSE) AS i FROM milestones m
LEFT JOIN a ON a.user_id = m.user_id WHERE funded_at IS NOT NULL)
SELECT count(*) AS activated_users, count(*) FILTER (WHERE s OR i) AS adopters, count(*) FILTER (WHERE s AND NOT i) AS savings_only,
count(*) FILTER (WHERE i AND NOT s) AS investment_only, count(*) FILTER (WHERE s AND i) AS both,
round(CAST(count(*) FILTER (WHERE s OR i) AS DOUBLE) / count(*), 6) AS adoption_rate FROM u"""
)
def metric_adoption_rate(t):
    """Activated users with a position, by kind of product."""
    category = F.col("plan_category")
    held = standin.positions(t, owner=True).groupBy("user_id").agg(
        F.bool_or(category == "Savings").alias("s"), F.bool_or(category == "Investments").alias("i")
    )
    activated = standin.user_milestones(t, kyc=False).filter(F.col("funded_at").isNotNull()).select("user_id")
    users = activated.join(held, "user_id", "left").fillna(False, ["s", "i"])
    s, i = F.col("s"), F.col("i")
    return users.agg(
        F.count("*").alias("activated_users"),
        F.count_if(s | i).alias("adopters"),
        F.count_if(s & ~i).alias("savings_only"),
        F.count_if(i & ~s).alias("investment_only"),
        F.count_if(s & i).alias("both"),
    ).withColumn("adoption_rate", ratio(F.col("adopters"), F.col("activated_users")))


@query(
    with_views("positions")
    + """SELECT products, count(*) AS users FROM (SELECT user_id, string_agg(DISTINCT plan_name, '+' ORDER BY plan_name) AS products
FROM positions GROUP BY 1) GROUP BY 1"""
)
def metric_cross_product(t):
    """Users by the set of plans they started: at most four names per user."""
    names = sorted(plan[2] for plan in PLANS)
    flags = standin.positions(t, owner=True).groupBy("user_id").agg(*[F.bool_or(F.col("plan_name") == n).alias(n) for n in names])
    per_user = flags.select(F.concat_ws("+", *[F.when(F.col(n), n) for n in names]).alias("products"))
    return per_user.groupBy("products").agg(F.count("*").alias("users"))
