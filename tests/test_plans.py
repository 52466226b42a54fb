"""What the physical plans must look like."""

import pytest

from ledgerline.plans.registry import load_all

CATALOG = load_all()


def plan(spark, folder, name) -> str:
    return CATALOG[name](spark, folder)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_timestamp_range", "GreaterThanOrEqual(ts"),
        ("filter_cast_date_equals", "LessThan(ts"),
        ("filter_lower_bound", "GreaterThanOrEqual(o_orderdate"),
        ("filter_equals_string", "EqualTo(c_mktsegment,BUILDING)"),
        ("metric_signups", "EqualTo(event_type,signup)"),
        ("wallet_topup", "In(event_type"),
    ],
)
def test_filters_reach_the_scan(spark, folder, name, pushed):
    assert pushed in plan(spark, folder, name)


@pytest.mark.parametrize("name, absent", [("metric_signups", "props"), ("agg_value_counts", "user_id"), ("metric_mau", "o_totalprice")])
def test_unused_columns_are_not_read(spark, folder, name, absent):
    scans = [line for line in plan(spark, folder, name).splitlines() if "ReadSchema" in line]
    assert scans and all(absent not in line.split("ReadSchema")[1] for line in scans)


@pytest.mark.parametrize("name", ["window_first_per_user_maturity", "window_first_per_user_start", "choose_without_replacement"])
def test_ranks_are_cut_before_the_shuffle(spark, folder, name):
    assert "WindowGroupLimit" in plan(spark, folder, name)


@pytest.mark.parametrize("name", ["random_top_k", "limit_n"])
def test_top_k_needs_no_sort_of_everything(spark, folder, name):
    assert "TakeOrderedAndProject" in plan(spark, folder, name)


@pytest.mark.parametrize("name", [n for n in CATALOG if n.startswith(("join_", "metric_", "assign_", "position_", "dq_", "agg_"))])
def test_no_cross_join_and_no_python_worker(spark, folder, name):
    text = plan(spark, folder, name)
    assert "CartesianProduct" not in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    assert "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["running_wallet_balance", "session_login_review", "metric_cohort_matrix", "position_maturity", "metric_rfm"])
def test_no_window_over_the_whole_table(spark, folder, name):
    for line in plan(spark, folder, name).splitlines():
        # The one global window allowed runs over the per-partition counts of the key builder.
        if "Exchange SinglePartition" in line:
            assert "metric_rfm" == name


@pytest.mark.parametrize("name", ["running_wallet_balance", "join_asof_last_login", "withdrawal_retry_pairs"])
def test_a_scan_exchanges_its_rows_once(spark, folder, name):
    """Besides the stored layout: one exchange of rows by part and key, two of a row per part and key."""
    text = plan(spark, folder, name)
    assert text.count("FileScan parquet") == 2 and text.count("Exchange hashpartitioning") == 3
