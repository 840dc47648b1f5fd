from __future__ import annotations

import gzip
import json

from pyspark.sql import functions as F

from acceptance.views import as_json, trips
from tests import fixtures as fx


def test_a_large_feed_is_compressed_and_not_sorted_by_folder(spark, tmp_path, rows):
    """One task gets the folders in turn. Sorted by folder, the rows of a file would not alternate with others'."""
    kept = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    docs = spark.range(0, 60, 1, 1).select(F.col("id"), (F.col("id") % 3).alias("day"))
    seen = []
    listened = docs.withColumn("at", F.monotonically_increasing_id())
    as_json(listened, str(tmp_path / "feed"), "trip", "day", gzip=True)
    files = sorted((tmp_path / "feed").rglob("trip-*"))
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)
    for f in files:
        seen += [json.loads(line)["id"] for line in gzip.open(f, "rt")]
    assert sorted(seen) == list(range(60))
    back = spark.read.schema("id long, day long").json(str(tmp_path / "feed"))
    assert rows(back, "id", "day") == sorted([(k, k % 3) for k in range(60)], key=repr)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == kept


def test_small_feeds_stay_plain_text(spark, tmp_path):
    as_json(spark.range(3), str(tmp_path / "feed"), "events")
    assert all(f.suffix == ".json" for f in (tmp_path / "feed").rglob("events-*"))


def test_an_orders_legs_are_put_together_in_one_shuffle(spark, tmp_path, rows):
    more = ["id AS l_partkey", "id AS l_suppkey", "1d AS l_quantity", "2d AS l_extendedprice", "0d AS l_tax"]
    more += ["'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp'1996-01-01' AS l_shipdate"]
    lines = spark.range(12).selectExpr("id % 2 AS l_orderkey", "cast(id % 3 AS int) AS l_linenumber", *more)
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = trips(spark, str(tmp_path))
    assert len(fx.shuffles(found)) == 1
    assert rows(found, "full_air_id", "legs.l_partkey") == [("0-0+0-1+0-2", [6, 10, 8]), ("1-0+1-1+1-2", [9, 7, 11])]
