"""The corpus queries that SQL can express, next to it on the same files."""

import pytest
from check import compare, oracle_connection

from ledgerline.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), oracle_connection(folder), ORACLES[name]) == []
