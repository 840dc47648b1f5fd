from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_entry(spark):
    df = contract.entry(spark)
    assert "median_price" in df.columns
    assert not df.isEmpty()


def test_sql_belongs_to_queries():
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert {"daily_rollup", "rollup_refresh"} <= contract.oracle_sql().keys()
