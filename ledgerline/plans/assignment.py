"""Queries over repeatable samples and assignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.calendar import month_start
from ledgerline.functions.draws import uniform
from ledgerline.functions.money import ratio
from ledgerline.operators import sampling
from ledgerline.plans.registry import query
from ledgerline.plans.views import draw, with_views
from ledgerline.sources import standin


# Market segment -> sampling share, and its usual range of monthly logins.
SHARES = {"BUILDING": 0.6, "MACHINERY": 0.3, "HOUSEHOLD": 0.1}
LOGIN_RANGES = {
    "BUILDING": (20, 40),
    "MACHINERY": (15, 30),
    "HOUSEHOLD": (8, 15),
    "FURNITURE": (4, 10),
    "AUTOMOBILE": (0, 2),
}


@query(f"SELECT c_custkey, c_mktsegment FROM customer WHERE {draw(42, 'c_custkey')} < 0.25")
def sample_fraction(t):
    return sampling.sample_fraction(t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"], 0.25, 42)


@query(
    f"""SELECT c_custkey, c_mktsegment FROM customer WHERE {draw(42, 'c_custkey')} <
CASE c_mktsegment WHEN 'BUILDING' THEN 0.6 WHEN 'MACHINERY' THEN 0.3 WHEN 'HOUSEHOLD' THEN 0.1 END"""
)
def sample_stratified(t):
    customers = t.customer.select("c_custkey", "c_mktsegment")
    return sampling.sample_stratified(customers, ["c_custkey"], F.col("c_mktsegment"), SHARES, 42)


@query(
    f"""SELECT c_custkey, CASE WHEN {draw('plan', 'c_custkey')} < 0.3 THEN 'flex_save'
WHEN {draw('plan', 'c_custkey')} < 0.65 THEN 'fixed_save' WHEN {draw('plan', 'c_custkey')} < 0.85 THEN 'treasury_bills'
ELSE 'mutual_funds' END AS plan_name FROM customer"""
)
def assign_weighted(t):
    weights = [("flex_save", 0.3), ("fixed_save", 0.35), ("treasury_bills", 0.2), ("mutual_funds", 0.15)]
    u = uniform("plan", F.col("c_custkey"))
    return sampling.range_bucket(t.customer.select("c_custkey"), u, weights, "plan_name")


@query(
    """SELECT c_custkey, r_name AS region, n_name AS country FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey"""
)
def assign_hierarchical(t):
    """Each customer's recorded place at both levels; one without a known nation keeps nulls."""
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"), F.col("n_regionkey").alias("r_regionkey"))
    places = nations.join(t.region.select("r_regionkey", F.col("r_name").alias("region")), "r_regionkey", "left")
    return t.customer.select("c_custkey", "c_nationkey").join(places, "c_nationkey", "left").select("c_custkey", "region", "country")


@query(
    with_views("positions")
    + """SELECT plan_id, count(*) AS positions, count(*) FILTER (WHERE is_withdrawn_early) AS withdrawn_early,
round(CAST(count(*) FILTER (WHERE is_withdrawn_early) AS DOUBLE) / count(*), 6) AS share FROM positions GROUP BY 1"""
)
def assign_bernoulli(t):
    """The odds of an early withdrawal as recorded, per plan."""
    early = F.count_if("is_withdrawn_early")
    return standin.positions(t).groupBy("plan_id").agg(
        F.count("*").alias("positions"), early.alias("withdrawn_early"), ratio(early, F.count("*")).alias("share")
    )


@query(
    """SELECT c_custkey, CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS monthly_logins FROM customer
JOIN events ON user_id = c_custkey AND event_type = 'view' GROUP BY ALL"""
)
def assign_uniform_int(t):
    """Logins per customer and month as recorded."""
    logins = t.events.filter(F.col("event_type") == "view").groupBy(
        F.col("user_id").alias("c_custkey"), month_start(F.col("ts")).alias("month")
    ).agg(F.count("*").alias("monthly_logins"))
    return logins.join(t.customer.select("c_custkey"), "c_custkey")


@query(
    with_views("positions")
    + """SELECT position_key, plan_id, CAST(maturity_date - early_withdrawal_date AS INTEGER) AS lead_days FROM positions
WHERE early_withdrawal_date IS NOT NULL"""
)
def assign_triangular(t):
    """Days from an early withdrawal to the maturity it gave up, as recorded."""
    lead = F.datediff("maturity_date", "early_withdrawal_date")
    early = standin.positions(t).filter(F.col("early_withdrawal_date").isNotNull())
    return early.select("position_key", "plan_id", lead.alias("lead_days"))


@query(
    """SELECT user_id, day, event_id FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_id, row_number() OVER
(PARTITION BY user_id, CAST(ts AS DATE) ORDER BY md5(concat('11:', event_id)), event_id) AS rn FROM events
WHERE event_type = 'view') WHERE rn <= 2"""
)
def choose_without_replacement(t):
    logins = t.events.filter(F.col("event_type") == "view").select("user_id", F.to_date("ts").alias("day"), "event_id")
    return sampling.first_k(logins, ["user_id", "day"], "event_id", 2, 11)
