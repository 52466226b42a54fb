"""Rows outside what the test tables hold: no query may lose them, and the oracles agree."""

import os
import shutil

import duckdb
import pytest
from check import compare, oracle_connection

from ledgerline.plans.registry import load_all

CATALOG = load_all()
SOURCE = "/root/testdata/sf0.001"

CHANGES = {
    "events": "SELECT * REPLACE (CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 5 YEAR WHEN event_id % 10 = 1 THEN ts + INTERVAL 90 DAY ELSE ts END AS ts, "
    "CASE WHEN event_id % 13 = 0 THEN 'mystery' ELSE event_type END AS event_type) FROM t",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 12 YEAR WHEN o_orderkey % 10 = 1 THEN "
    "o_orderdate - INTERVAL 9 YEAR ELSE o_orderdate END AS o_orderdate, CASE WHEN o_orderkey % 11 = 0 THEN 'X' WHEN o_orderkey % 11 = 1 THEN NULL "
    "ELSE o_orderstatus END AS o_orderstatus) FROM t",
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 5 = 0 THEN 'UNKNOWN' ELSE p_type END AS p_type) FROM t",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_orderkey % 10 = 0 THEN l_shipdate + INTERVAL 12 YEAR ELSE l_shipdate END AS l_shipdate) FROM t",
}


@pytest.fixture(scope="module")
def outside(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("outside"))
    for name in os.listdir(SOURCE):
        table = name.removesuffix(".parquet")
        if table in CHANGES:
            sql = CHANGES[table].replace("FROM t", f"FROM '{SOURCE}/{name}'")
            duckdb.sql(f"COPY ({sql}) TO '{folder}/{name}' (FORMAT parquet)")
        else:
            shutil.copy(f"{SOURCE}/{name}", f"{folder}/{name}")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "join_star_enrich", "join_role_playing_date", "join_star_three_way", "fn_date_series", "metric_executive_summary", "metric_adoption_rate",
        "metric_cross_product", "activated_without_position", "union_all_frames", "event_stage_enrich", "conform_schema", "incremental_daily_load",
        "array_sorted", "running_wallet_balance", "join_asof_last_login", "session_login_review", "withdrawal_retry_pairs", "dq_sufficient_balance",
        "dq_failed_no_balance_change", "dq_degenerate_key_match", "load_report", "object_store_sink", "withdrawal_after_redemption", "position_maturity",
    ],
)
def test_still_equal(spark, outside, name):
    assert compare(CATALOG[name](spark, outside), oracle_connection(outside), CATALOG[name].oracle) == []


def test_positions_of_unknown_plans_stay(spark, outside):
    held = CATALOG["join_star_three_way"](spark, outside)
    assert held.count() == spark.read.parquet(f"{outside}/lineitem.parquet").count()
    assert held.filter("plan_name IS NULL").count() > 0


def test_no_row_is_lost_in_the_enrichments(spark, outside):
    n = spark.read.parquet(f"{outside}/events.parquet").count()
    for name in ("join_star_enrich", "event_stage_enrich", "conform_schema"):
        assert CATALOG[name](spark, outside).count() == n


@pytest.mark.parametrize("name", ["dq_failed_no_balance_change", "dq_degenerate_key_match"])
def test_the_check_finds_bad_rows(spark, outside, name):
    row = CATALOG[name](spark, outside).first()
    assert 0 < row.n_bad < row.n_rows


@pytest.fixture(scope="module")
def undated(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("undated"))
    for name, column, key in (("events", "ts", "event_id"), ("orders", "o_orderdate", "o_orderkey")):
        sql = f"SELECT * REPLACE (CASE WHEN {key} % 9 = 0 THEN NULL ELSE {column} END AS {column}) FROM '{SOURCE}/{name}.parquet'"
        duckdb.sql(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", ["append_rows", "surrogate_key_continue", "incremental_daily_load", "stream_failed_then_success", "stream_late_data"])
def test_rows_without_a_time_are_kept(spark, undated, name):
    assert compare(CATALOG[name](spark, undated), oracle_connection(undated), CATALOG[name].oracle) == []


# Scans and dense keys store a layout when they are built; other queries only plan.
@pytest.mark.parametrize("name", ["metric_dau_wau", "join_star_enrich", "join_inner_key_restrict"])
def test_building_a_query_runs_no_job(spark, folder, name):
    spark.sparkContext.setJobGroup("build", name)
    try:
        CATALOG[name](spark, folder)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
