"""Each query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

pytest.importorskip("duckdb")

from acceptance import feeds, flat, keyed, nested  # noqa: E402,F401
from acceptance.compare import difference, oracle  # noqa: E402
from acceptance.registry import QUERIES, SQL  # noqa: E402

SF_DIR = os.environ.get("ACCEPTANCE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test tables in {SF_DIR}")
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None
