"""Queries over scans, sinks and layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import contracts, incremental
from ledgerline.plans import views
from ledgerline.plans.registry import query
from ledgerline.plans.views import with_views
from ledgerline.schemas import INPUT, STAR, event_type_rows
from ledgerline.session import scratch
from ledgerline.sources import catalog, readers, sinks
from ledgerline.sources.standin import event_fact


@query("SELECT * FROM orders")
def scan_parquet(t):
    return t.orders


@query("SELECT * FROM nation")
def scan_csv(t):
    path = sinks.overwrite_csv(t.nation, scratch(t.spark, "nation_csv"))
    return readers.read_csv(t.spark, path, INPUT["nation"])


@query("SELECT r_name, r_regionkey FROM region")
def scan_csv_projected(t):
    path = sinks.overwrite_csv(t.region, scratch(t.spark, "region_csv"))
    return readers.read_csv(t.spark, path, INPUT["region"]).select("r_name", "r_regionkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0")
def scan_table_as_frame(t):
    t.customer.createOrReplaceTempView("customer_rows")
    return t.spark.sql("SELECT c_custkey, c_mktsegment FROM customer_rows WHERE c_acctbal >= 0")


@query("SELECT event_type, count(*) AS event_count FROM events GROUP BY event_type")
def register_frame(t):
    readers.register(t.spark, {"event_rows": t.events})
    counted = t.spark.sql("SELECT event_type, count(*) AS event_count FROM event_rows GROUP BY event_type")
    readers.unregister(t.spark, ["event_rows"])
    return counted


@query(
    with_views("event_types")
    + f"""
SELECT e.event_id, e.user_id, CAST(d.event_type_id AS INTEGER) AS event_type_id, e.user_id AS wallet_id,
       CAST(NULL AS INTEGER) AS plan_id, e.ts AS event_time, {views.date_id('e.ts')} AS event_date_id,
       CAST(NULL AS VARCHAR) AS device_type, e.event_type IN ('purchase', 'error') AS is_money_movement_activity,
       CAST(NULL AS INTEGER) AS transaction_type_id, CAST(NULL AS BIGINT) AS transaction_id,
       CAST(NULL AS BIGINT) AS investment_id
FROM events e LEFT JOIN event_types d USING (event_type)"""
)
def conform_schema(t):
    dims = event_type_rows(t.spark).select("event_type_code", "event_type_id")
    typed = event_fact(t).join(F.broadcast(dims), "event_type_code", "left")
    return readers.conform(typed, STAR["fact_user_event"])


@query("SELECT * FROM part")
def sink_parquet_overwrite(t):
    path = scratch(t.spark, "part")
    sinks.overwrite(t.part.filter(F.col("p_retailprice") < 1000), path)
    return sinks.overwrite(t.part, path)


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def sink_projected_export(t):
    return sinks.export_public(t.customer, ["c_acctbal", "c_mktsegment"], scratch(t.spark, "customer"))


@query("SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS load_date FROM events")
def sink_daily_partition(t):
    day = F.to_date("ts")
    path = scratch(t.spark, "events_by_day")
    sinks.land_by_day(t.events, day, path)
    # Landing two days again must replace these days and leave the others alone.
    again = t.events.filter((F.col("ts") >= "2024-01-05") & (F.col("ts") < "2024-01-07"))
    return sinks.land_by_day(again, day, path).select("event_id", "user_id", "event_type", "load_date")


@query("SELECT event_id, value, CAST(ts AS DATE) AS event_date FROM events")
def sink_event_date_partition(t):
    landed = sinks.land_by_day(t.events, F.to_date("ts"), scratch(t.spark, "lake"), "event_date")
    return landed.select("event_id", "value", "event_date")


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def append_rows(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    path = scratch(t.spark, "orders_appended")
    early = F.coalesce(F.col("o_orderdate") < "1998-01-01", F.lit(False))
    orders.filter(early).write.parquet(path)
    later = orders.filter(~early)  # orders without a date come with the second delivery
    # Another column order: rows are appended by name.
    later.select("o_orderdate", "o_custkey", "o_orderkey").write.mode("append").parquet(path)
    return t.spark.read.schema(orders.schema).parquet(path)


@query(
    """SELECT c_custkey AS wallet_id, CAST(0 AS DECIMAL(15,2)) AS current_balance, CAST(NULL AS BIGINT) AS last_event_id
FROM customer
UNION ALL SELECT s_suppkey, CAST(s_acctbal AS DECIMAL(15,2)), s_suppkey FROM supplier"""
)
def insert_named_columns(t):
    supplied = t.supplier.select(
        F.col("s_acctbal").cast("decimal(15,2)").alias("current_balance"),
        F.col("s_suppkey").alias("last_event_id"),
        F.col("s_suppkey").alias("wallet_id"),
    )
    both = readers.append_by_name(supplied, t.customer.select(F.col("c_custkey").alias("wallet_id")))
    zero = F.lit(0).cast("decimal(15,2)")
    return both.withColumn("current_balance", F.coalesce("current_balance", zero))


@query("SELECT * FROM supplier")
def truncate_and_load(t):
    shouting = t.supplier.select(*[F.col(c).alias(c.upper()) for c in reversed(t.supplier.columns)])
    staged, target = scratch(t.spark, "stage"), scratch(t.spark, "supplier")
    shouting.write.parquet(staged)
    sinks.overwrite(t.supplier.filter(F.col("s_acctbal") < 0), target)
    contract = contracts.Contract(INPUT["supplier"], key=("s_suppkey",))
    return contracts.load(t.spark.read.parquet(staged), contract, target, scratch(t.spark, "supplier_quarantine")).table


_ALL = list(INPUT)


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows_loaded FROM {n}" for n in _ALL))
def load_report(t):
    return sinks.load_report({n: t.read(n) for n in _ALL}, scratch(t.spark, "loaded"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS published_rows FROM {n}" for n in _ALL))
def object_store_sink(t):
    """Every table published under one URI, and the rows found there."""
    published = sinks.publish({n: t.read(n) for n in _ALL}, scratch(t.spark, "bucket"))
    counts = [df.agg(F.lit(n).alias("table_name"), F.count("*").alias("published_rows")) for n, df in published.items()]
    return reduce(DataFrame.unionByName, counts)


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{text}' AS description, count(*) AS row_count FROM {n}"
        for n, text in catalog.BRONZE.items()
    )
)
def bronze_catalog(t):
    return catalog.bronze_counts(t)


def cleansed_customers(t) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.initcap("c_mktsegment").alias("segment"),
        F.greatest(F.col("c_acctbal").cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias("balance"),
    )


@query(
    """SELECT c_custkey AS user_id, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment,
greatest(CAST(c_acctbal AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2))) AS balance FROM customer"""
)
def silver_table_materialize(t):
    return sinks.materialize_table(cleansed_customers(t), "silver_customer", scratch(t.spark, "silver"))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def gold_view_materialize(t):
    """Errors are landed late; only the days they fall on are aggregated again."""
    lake, held, day = scratch(t.spark, "gold_lake"), scratch(t.spark, "gold_state"), F.to_date("ts")
    late = F.col("event_type").eqNullSafe("error")
    landed = sinks.land_by_day(t.events.filter(~late).select("user_id", "ts"), day, lake)
    incremental.refresh(landed, held, "user_id", {})
    delayed = t.events.filter(late).select("user_id", "ts")
    days = incremental.days_of(delayed.select(day.alias(incremental.DAY)))
    landed = sinks.append_by_day(delayed, day, lake)
    current = incremental.refresh(landed, held, "user_id", {}, days)
    daily = incremental.rolled_up(current, F.col(incremental.DAY), "day", "user_id", "users", {incremental.ROWS: "events"})
    return sinks.gold_view(daily, "gold_daily_events")
