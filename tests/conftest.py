from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from feedmart.session import pin


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "4")
        .config("spark.sql.streaming.noDataProgressEventInterval", "200")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield pin(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted([tuple(r) for r in chosen.collect()], key=repr)

    return collect
