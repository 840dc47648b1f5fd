"""The queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedmart.session import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(pin(spark), sf_dir)

        QUERIES[run.__name__] = pinned
        SQL[run.__name__] = sql
        return run

    return add
