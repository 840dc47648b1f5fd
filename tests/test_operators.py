from __future__ import annotations

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from feedmart.functions import keys, labels, money, times
from feedmart.operators import dedupe, keyed, lookup, rollup


def test_price_stats_against_brute_force(spark, rows):
    """One group holds a third of the rows; some rows have no price, one group has none at all."""
    pick = random.Random(7)
    data = []
    for i in range(3000):
        group = "hot" if i < 1000 else f"g{pick.randrange(300)}"
        price = None if pick.random() < 0.1 else pick.randrange(-50, 50) * 7
        data.append((group, price))
    data += [("none", None)] * 3
    df = spark.createDataFrame(data, "g string, adult_fare int").repartition(8)
    expected = []
    for group in {g for g, _ in data}:
        prices = [p for g, p in data if g == group and p is not None]
        count = sum(g == group for g, _ in data)
        mean = int(sum(prices) / len(prices)) if prices else None
        expected.append((group, mean, statistics.median_low(prices) if prices else None, count))
    exact = rows(rollup.price_stats(df, ["g"]))
    assert exact == sorted(expected, key=repr)
    assert rows(rollup.price_stats_sketch(df, ["g"])) == exact


def test_price_stats_groups_null_keys(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 5), ("a", 3)], "g string, adult_fare int")
    assert rows(rollup.price_stats(df, ["g"])) == [("a", 3, 3, 1), (None, 3, 1, 2)]


def test_a_large_group_is_counted_before_it_meets(spark):
    """The first shuffle is by group and price, and each task counts before it."""
    df = spark.range(10).select(F.lit("g").alias("g"), F.col("id").cast("int").alias("adult_fare"))
    plan = rollup.price_stats(df, ["g"])._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert re.search(r"hashpartitioning\(g#\d+, \w+#\d+L, \d+\)", first)
    assert "partial_count" in plan


def test_newest_is_the_same_for_any_spread(spark, rows):
    pick = random.Random(3)
    data = [(pick.randrange(5), pick.randrange(3), pick.randrange(100), str(i % 9)) for i in range(400)]
    df = spark.createDataFrame(data, "k int, day int, x int, s string")
    one = rows(dedupe.newest(df.coalesce(1), ["k"], ["day"]))
    assert one == rows(dedupe.newest(df.repartition(7), ["k"], ["day"]))
    best = {}
    for row in data:
        best[row[0]] = max(best.get(row[0], row), row, key=lambda r: r[1:])
    assert one == sorted(best.values(), key=repr)


def test_newest_limits_each_task_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    plan = dedupe.newest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    shuffle = next(i for i, line in enumerate(lines) if line.startswith("Exchange"))
    assert any(line.startswith("WindowGroupLimit") for line in lines[shuffle:])


def test_lookup(spark, rows):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "code string")
    dim = spark.createDataFrame([("a", "A/B")], "c string, tz string")
    out = lookup.lookup(df, dim, "code", "c", {"tz": "zone"}, {"zone": F.lit("UTC")}, "known")
    assert rows(out) == [("a", "A/B", True), ("z", "UTC", False), (None, "UTC", False)]


def test_lookup_without_broadcast(spark, rows):
    """A dimension above the broadcast limit is joined by key, with the same rows."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = spark.createDataFrame([("a",), ("z",), (None,)], "code string")
    dim = spark.createDataFrame([("a", "A/B")], "c string, tz string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup.lookup(df, dim, "code", "c", {"tz": "zone"}, known="known")
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert rows(out) == [("a", "A/B", True), ("z", None, False), (None, None, False)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_both_ends(spark, rows):
    df = spark.createDataFrame([("a", "b"), ("a", "z"), ("z", "b"), (None, "a")], "x string, y string")
    dim = spark.createDataFrame([("a",), ("b",)], "c string")
    assert rows(lookup.both_ends(df, dim, "c", "x", "y")) == [("a", "b")]


def test_keyed_sets_are_null_safe(spark, rows):
    left = spark.createDataFrame([("a", None), ("a", 1), (None, None)], "k string, n int")
    right = spark.createDataFrame([("a", None), (None, None)], "k string, n int")
    assert rows(keyed.within(left, right, ["k", "n"])) == [("a", None), (None, None)]
    assert rows(keyed.without(left, right, ["k", "n"])) == [("a", 1)]


@pytest.mark.parametrize(
    "url, part",
    [
        ("http://x/?FareRuleItnInfo=a/b/K&y=1", "K"),
        ("http://x/?FareRuleItnInfo=a/b/K/L", "K"),
        ("http://x/?FareRuleItnInfo=a/b", "n"),
        ("http://x/?FareRuleItnInfo=&y=1", "n"),
        ("http://x/?y=1", "n"),
        (None, "n"),
    ],
)
def test_url_param_part(spark, rows, url, part):
    df = spark.createDataFrame([(url,)], "url string")
    assert rows(df.select(keys.url_param_part("url"))) == [(part,)]


def test_path_parts(spark, rows):
    paths = [
        "/feeds/2025-05-29/abroad/trip_AAA_BBB_C_7.json",
        "/x/day=2025-05-29/part-0.json",
        "/x/2025-13-29/a_Q_b.json",
        "/x/none/a.json",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [tuple(r) for r in df.select(keys.path_date("p").cast("string"), keys.path_cabin("p")).collect()] == [
        ("2025-05-29", "C"), ("2025-05-29", ""), (None, ""), (None, "")
    ]


def test_durations(spark, rows):
    df = spark.createDataFrame([("01:10", "0110", ["01", "10"]), ("x", "", ["01"]), (None, None, None)],
                               "a string, b string, c array<string>")
    out = df.select(times.minutes_hh_mm("a"), times.minutes_hhmm("b"), times.minutes_pair("c"),
                    times.minutes_any("a"), times.minutes_any("b"))
    assert [tuple(r) for r in out.collect()] == [
        (70, 70, 70, 70, 70), (None,) * 5, (None,) * 5
    ]


def test_leg_ids(spark, rows):
    df = spark.createDataFrame([("A+B", 0), ("A+B", 1), ("A+B", 2), ("A", 0)], "id string, n int")
    assert [tuple(r) for r in df.select(keys.leg_id("id", "n"), keys.is_connection("id")).collect()] == [
        ("A", True), ("B", True), (None, True), ("A", False)
    ]


def test_labels(spark):
    df = spark.createDataFrame([("Y", "a%20b+c"), ("?", "%zz"), (None, None)], "c string, t string")
    out = df.select(labels.label(F.col("c"), labels.DOMESTIC_SEATS), labels.decoded(F.col("t")))
    assert [tuple(r) for r in out.collect()] == [("일반석", "a b c"), (None, None), (None, None)]


def test_total(spark):
    df = spark.createDataFrame([("1", 2), ("x", 2), (None, 2), ("2147483647", 1)], "a string, b int")
    assert [r[0] for r in df.select(money.total(F.col("a"), F.col("b"))).collect()] == [
        3, None, None, None
    ]


def test_split_by_key(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), (None, 1, 6), (None, 1, 6), ("b", None, 7), (None, None, 8)], "k string, d int, v int")
    whole, keyless = dedupe.split_by_key(df, ["k", "d"])
    assert rows(whole, "v") == [(5,), (5,)]
    assert rows(keyless, "v", "lacks") == [(6, ["k"]), (6, ["k"]), (7, ["d"]), (8, ["k", "d"])]
    assert whole.columns == df.columns


def test_the_tenth_path_follows_the_ninth(spark):
    names = ["a/file-9.json", "a/file-10.json", "a/file-8.json", "a/file-2.json", None]
    df = spark.createDataFrame([(n, 1) for n in names], "file_path string, k int")
    for count, expected in ((5, "a/file-10.json"), (1, "a/file-9.json")):
        some = df if count == 5 else df.where("file_path is null or file_path <> 'a/file-10.json'")
        assert dedupe.newest(some, ["k"], dedupe.by_version(["file_path"])).first()["file_path"] == expected
