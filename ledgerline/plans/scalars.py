"""Queries over calendar, text and money functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions import money as m
from ledgerline.functions import text
from ledgerline.plans import views
from ledgerline.plans.assignment import LOGIN_RANGES
from ledgerline.plans.registry import query
from ledgerline.plans.views import with_views
from ledgerline.schemas import INPUT
from ledgerline.sources import readers, standin
from ledgerline.sources.standin import EVENTS_AS_OF, ORDERS_AS_OF


@query(f"SELECT event_id, {views.date_id('ts')} AS event_date_id FROM events")
def fn_date_id(t):
    return t.events.select("event_id", cal.date_id(F.col("ts")).alias("event_date_id"))


@query(
    """SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter,
month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day FROM orders"""
)
def fn_date_parts(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
    )


@query("SELECT o_orderkey, monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_name FROM orders")
def fn_month_day_names(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"))


@query("SELECT o_orderkey, week(o_orderdate)::INTEGER AS week_of_year FROM orders")
def fn_iso_week(t):
    return t.orders.select("o_orderkey", F.weekofyear("o_orderdate").alias("week_of_year"))


@query("SELECT o_orderkey, dayofweek(o_orderdate)::INTEGER AS day_of_week FROM orders")
def fn_day_of_week(t):
    return t.orders.select("o_orderkey", cal.day_of_week(F.col("o_orderdate")).alias("day_of_week"))


@query("SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders")
def fn_is_weekend(t):
    return t.orders.select("o_orderkey", cal.is_weekend(F.col("o_orderdate")).alias("is_weekend"))


@query(
    """SELECT o_orderkey, day(o_orderdate) = 1 AS is_month_start,
CAST(o_orderdate AS DATE) = last_day(CAST(o_orderdate AS DATE)) AS is_month_end FROM orders"""
)
def fn_month_boundaries(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", cal.is_month_start(d).alias("is_month_start"), cal.is_month_end(d).alias("is_month_end")
    )


@query(
    """SELECT CAST(d AS DATE) AS date, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = CAST(d AS DATE)) AS orders
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)"""
)
def fn_date_series(t):
    """A day spine from the first to the last order with the orders of each day, so that empty days show."""
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("n"))
    bounds = daily.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    spine = bounds.select(F.explode(F.sequence("first", "last")).alias("date"))
    return spine.join(daily, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("orders"))


@query("SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('month', ts) AS DATE) AS month_start FROM events")
def fn_truncate_date(t):
    ts = F.col("ts")
    return t.events.select("event_id", F.to_date(ts).alias("day"), cal.month_start(ts).alias("month_start"))


@query(
    """SELECT o_orderkey, o_orderdate + INTERVAL 90 SECOND AS plus_seconds, o_orderdate + INTERVAL 30 MINUTE AS plus_minutes,
o_orderdate - INTERVAL 3 HOUR AS minus_hours, o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS plus_row_days FROM orders"""
)
def fn_interval_add(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        cal.plus(d, seconds=90).alias("plus_seconds"),
        cal.plus(d, minutes=30).alias("plus_minutes"),
        cal.plus(d, hours=-3).alias("minus_hours"),
        cal.plus(d, days=(F.col("o_orderkey") % 30).cast("int")).alias("plus_row_days"),
    )


@query("SELECT o_orderkey, o_orderdate + INTERVAL 1 MONTH AS next_month, o_orderdate + INTERVAL 7 MONTH AS later FROM orders")
def fn_month_add(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", cal.plus(d, months=1).alias("next_month"), cal.plus(d, months=7).alias("later"))


@query(
    """WITH r AS (SELECT o_orderkey, o_orderdate AS s, TIMESTAMP '2001-06-30' AS e,
 CAST((year(TIMESTAMP '2001-06-30') - year(o_orderdate)) * 12 + month(TIMESTAMP '2001-06-30') - month(o_orderdate) AS INTEGER) AS n FROM orders)
SELECT o_orderkey, greatest(1, n - CASE WHEN s + to_months(n) > e THEN 1 ELSE 0 END)::INTEGER AS months_active FROM r"""
)
def fn_complete_months_between(t):
    months = cal.complete_months(F.col("o_orderdate"), cal.ntz(ORDERS_AS_OF))
    return t.orders.select("o_orderkey", F.greatest(F.lit(1), months).alias("months_active"))


@query(
    """SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER)
AS month_length FROM orders"""
)
def fn_days_in_month(t):
    return t.orders.select("o_orderkey", cal.month_length(F.col("o_orderdate")).alias("month_length"))


@query(
    with_views("positions")
    + """SELECT position_key, CAST(DATE '2001-06-30' - start_date AS INTEGER) AS days_held,
CAST(maturity_date - DATE '2001-06-30' AS INTEGER) AS days_left FROM positions"""
)
def fn_days_between(t):
    today = F.lit(ORDERS_AS_OF)
    return standin.positions(t).select(
        "position_key",
        F.datediff(today, "start_date").alias("days_held"),
        F.datediff("maturity_date", today).alias("days_left"),
    )


BIRTH_SQL = "CAST(o_orderdate AS DATE) - CAST(6000 + o_orderkey % 9000 AS INTEGER)"


def date_of_birth():
    """A birth date for an order's owner: 6,000 to 15,000 days before the order."""
    return F.date_sub(F.to_date("o_orderdate"), (F.lit(6000) + F.col("o_orderkey") % 9000).cast("int"))


@query(
    f"""SELECT o_orderkey, {BIRTH_SQL} AS date_of_birth,
CAST({BIRTH_SQL} + INTERVAL 18 YEAR AS DATE) <= CAST(o_orderdate AS DATE) AS is_adult FROM orders"""
)
def fn_age_gate(t):
    dob = date_of_birth()
    return t.orders.select(
        "o_orderkey", dob.alias("date_of_birth"), text.is_adult(dob, F.to_date("o_orderdate")).alias("is_adult")
    )


@query(
    """SELECT p_partkey, CASE WHEN p_size + 17 BETWEEN 18 AND 24 THEN '18-24' WHEN p_size + 17 BETWEEN 25 AND 34 THEN '25-34'
WHEN p_size + 17 BETWEEN 35 AND 44 THEN '35-44' WHEN p_size + 17 BETWEEN 45 AND 54 THEN '45-54'
WHEN p_size + 17 BETWEEN 55 AND 65 THEN '55-65' END AS age_bucket FROM part"""
)
def fn_age_bucket(t):
    return t.part.select("p_partkey", text.age_bucket(F.col("p_size") + 17).alias("age_bucket"))


@query(
    """SELECT event_type, min(ts) AS first_at, max(ts) AS last_at, count(*) AS events FROM events
WHERE ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31' GROUP BY event_type"""
)
def fn_current_date_bounds(t):
    """Yesterday's events as seen from ``as_of``: a parameter, never the clock."""
    yesterday = EVENTS_AS_OF - dt.timedelta(days=1)
    return (
        t.events.filter(cal.within_day(F.col("ts"), yesterday))
        .groupBy("event_type")
        .agg(F.min("ts").alias("first_at"), F.max("ts").alias("last_at"), F.count("*").alias("events"))
    )


@query("SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z]', '', 'g') AS handle FROM customer")
def fn_lower_strip(t):
    return t.customer.select("c_custkey", text.letters_only(F.col("c_name")).alias("handle"))


@query(
    """SELECT c_custkey, concat(regexp_replace(lower(c_name), '[^a-z]', '', 'g'), '.',
regexp_replace(lower(c_mktsegment), '[^a-z]', '', 'g'), c_custkey, '@example.com') AS email_address FROM customer"""
)
def fn_string_concat(t):
    email = text.email(F.col("c_name"), F.col("c_mktsegment"), F.col("c_custkey"), "@example.com")
    return t.customer.select("c_custkey", email.alias("email_address"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def fn_case_insensitive_name(t):
    mixed = t.supplier.select(*[F.col(c).alias(c.title()) for c in reversed(t.supplier.columns)])
    return readers.conform(mixed, INPUT["supplier"])


@query("SELECT p_partkey, greatest(1, p_size - 10)::INTEGER AS at_least_one, least(30, p_size)::INTEGER AS at_most_30, greatest(p_size - 25, 0)::INTEGER AS excess FROM part")
def fn_greatest_least(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.greatest(F.lit(1), size - 10).alias("at_least_one"),
        F.least(F.lit(30), size).alias("at_most_30"),
        F.greatest(size - 25, F.lit(0)).alias("excess"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS whole,
CAST(trunc(-l_extendedprice / 7) AS INTEGER) AS negative_whole FROM lineitem"""
)
def fn_truncate_int(t):
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", price.cast("int").alias("whole"), (-price / 7).cast("int").alias("negative_whole")
    )


@query(
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.95 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS after_fee,
CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS share FROM orders"""
)
def fn_scaled_amount(t):
    amount = m.money(F.col("o_totalprice"))
    return t.orders.select("o_orderkey", m.scaled(amount, "0.95").alias("after_fee"), m.scaled(amount, "0.125").alias("share"))


@query("SELECT p_partkey, (p_size + p_retailprice) / 2 AS midpoint FROM part")
def fn_midpoint(t):
    return t.part.select("p_partkey", ((F.col("p_size") + F.col("p_retailprice")) / 2).alias("midpoint"))


@query(
    """SELECT event_id, CAST(CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(value AS DECIMAL(18,2))
ELSE -CAST(value AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS signed_amount FROM events"""
)
def fn_signed_amount(t):
    direction = F.when(F.col("event_type").isin("signup", "purchase"), "credit").otherwise("debit")
    return t.events.select("event_id", m.signed(m.money(F.col("value")), direction).alias("signed_amount"))


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 20 WHEN 'MACHINERY' THEN 15 WHEN 'HOUSEHOLD' THEN 8
WHEN 'FURNITURE' THEN 4 WHEN 'AUTOMOBILE' THEN 0 END::INTEGER AS fewest_logins FROM customer"""
)
def fn_map_lookup(t):
    lows = F.create_map(*[F.lit(x) for s, (lo, _) in LOGIN_RANGES.items() for x in (s, lo)])
    return t.customer.select("c_custkey", F.element_at(lows, F.col("c_mktsegment")).alias("fewest_logins"))
