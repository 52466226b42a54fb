"""Every query next to its SQL oracle on the same files."""

import pytest
from check import compare, oracle_connection

from ledgerline.plans.registry import load_all

CATALOG = load_all()


@pytest.fixture(scope="module")
def con(folder):
    return oracle_connection(folder)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.oracle])
def test_matches_sql(spark, folder, con, name):
    assert compare(CATALOG[name](spark, folder), con, CATALOG[name].oracle) == []


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if not q.oracle])
def test_gives_rows(spark, folder, name):
    assert CATALOG[name](spark, folder).count() > 0


@pytest.mark.parametrize("name", ["surrogate_key_dense", "metric_rfm", "running_wallet_balance", "session_login_review", "metric_aum_daily"])
def test_partition_count_changes_nothing(spark, folder, con, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert compare(CATALOG[name](spark, folder), con, CATALOG[name].oracle) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
