from __future__ import annotations

import datetime as dt

from feedmart.operators.rollup import daily_rollup
from feedmart.plans import domestic
from feedmart.sources import feeds
from tests import fixtures as fx


def raw(spark, folder):
    return feeds.records(
        feeds.scan(spark, folder, domestic.read_schema(), files=feeds.DOMESTIC_FILES)
    )


def build(spark, tmp_path, *docs, day="2025-05-29"):
    for i, doc in enumerate(docs):
        folder = fx.write(tmp_path, day, "domestic", f"{i}_domestic.json", doc)
    return domestic.tables(raw(spark, folder), fx.airports(spark))


def test_flight_and_fare_rows(spark, tmp_path, rows):
    out = build(spark, tmp_path, fx.domestic_doc(fx.schedule()))
    key = "202505300600GMPCJUSASA101Y"
    assert rows(
        out["flight_info"], "air_id", "airline", "depart_timestamp", "arrival_timestamp",
        "journey_time", "is_layover", "depart_date", "tz_known",
    ) == [
        (key, "Sky Air", dt.datetime(2025, 5, 29, 21, 0), dt.datetime(2025, 5, 29, 22, 10), 70,
         False, dt.date(2025, 5, 30), True)
    ]
    assert rows(
        out["fare_info"], "air_id", "seat_class", "agt_code", "adult_fare", "fetched_date",
        "fare_class",
    ) == [(key, "일반석", "A1", 62700, dt.date(2025, 5, 29), "n")]


def test_null_and_empty_fares_leave_the_flight(spark, tmp_path):
    docs = fx.domestic_doc(
        fx.schedule(number="1", fares=[]), {**fx.schedule(number="2"), "fare": None}
    )
    out = build(spark, tmp_path, docs)
    assert out["flight_info"].count() == 2
    assert out["fare_info"].count() == 0


def test_unknown_seat_code_and_unknown_airport(spark, tmp_path, rows):
    out = build(spark, tmp_path, fx.domestic_doc(fx.schedule(seat="Z", dep="XXX")))
    assert rows(out["fare_info"], "seat_class") == [(None,)]
    assert rows(out["flight_info"], "depart_timestamp", "tz_known") == [
        (dt.datetime(2025, 5, 30, 6, 0), False)
    ]


def test_schedules_without_a_key_are_kept_apart(spark, tmp_path, rows):
    nameless = [{**fx.schedule(dep=dep), "fitName": None} for dep in ("GMP", "ICN", "NRT")]
    folder = fx.write(tmp_path, "2025-05-29", "domestic", "0_domestic.json", fx.domestic_doc(*nameless))
    base = domestic.schedules(raw(spark, folder))
    out = domestic.tables_of(base, fx.airports(spark))
    assert rows(out["flight_info"], "air_id") == []
    assert rows(out["fare_info"], "air_id") == []
    assert domestic.unkeyed(base).select("record").distinct().count() == 3


def test_times_do_not_follow_the_session_zone(spark, tmp_path, rows):
    docs = fx.domestic_doc(fx.schedule(at="202505300030", until="202505300140"))
    wanted = ("unix_micros(depart_timestamp)", "cast(depart_date as string)", "cast(depart_local_ts as string)")
    found = []
    for zone in ("UTC", "Asia/Seoul", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found.append(build(spark, tmp_path, docs)["flight_info"].selectExpr(*wanted).collect())
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found[0] == found[1] == found[2]
    assert found[0][0][1] == "2025-05-30"


def test_missing_and_impossible_zones_count_as_utc(spark, tmp_path, rows):
    folder = fx.write(
        tmp_path, "2025-05-29", "domestic", "0_domestic.json",
        fx.domestic_doc(fx.schedule(number="1", dep="AAA"), fx.schedule(number="2", dep="BBB")),
    )
    more = spark.createDataFrame(
        [("AAA", "A", "X", None), ("BBB", "B", "X", "Mars/Olympus")], fx.airports(spark).schema
    )
    out = domestic.tables(raw(spark, folder), fx.airports(spark).union(more))
    assert rows(out["flight_info"], "depart_timestamp", "tz_known") == [
        (dt.datetime(2025, 5, 30, 6, 0), False)
    ] * 2


def test_bad_text_gives_null_and_does_not_fail(spark, tmp_path, rows):
    doc = fx.domestic_doc(
        fx.schedule(at="soon", journey="?", fares=[fx.fare(adult=None), fx.fare(agent="B", tax="no")])
    )
    out = build(spark, tmp_path, doc)
    assert rows(out["flight_info"], "depart_timestamp", "journey_time") == [(None, None)]
    assert rows(out["fare_info"], "agt_code", "adult_fare") == [("A1", None), ("B", None)]


def test_large_total_gives_null(spark, tmp_path, rows):
    out = build(spark, tmp_path, fx.domestic_doc(fx.schedule(fares=[fx.fare(adult=2147483647)])))
    assert rows(out["fare_info"], "adult_fare") == [(None,)]


def test_repeated_flight_counts_once_and_the_last_file_wins(spark, tmp_path, rows):
    out = build(
        spark, tmp_path,
        fx.domestic_doc(fx.schedule(journey="01:10")),
        fx.domestic_doc(fx.schedule(journey="01:20", fares=[fx.fare(adult=60000)])),
    )
    assert rows(out["flight_info"], "journey_time") == [(80,)]
    assert rows(out["fare_info"], "adult_fare") == [(72700,)]
    rollup = daily_rollup(out["flight_info"], out["fare_info"])
    assert rows(rollup, "mean_price", "median_price", "ticket_count") == [(72700, 72700, 1)]


def test_path_without_a_day(spark, tmp_path, rows):
    folder = fx.write(tmp_path, "someday", "domestic", "a_domestic.json",
                      fx.domestic_doc(fx.schedule()))
    out = domestic.tables(raw(spark, folder), fx.airports(spark))
    assert rows(out["fare_info"], "fetched_date") == [(None,)]


def test_return_legs_are_read_on_request(spark, tmp_path, rows):
    doc = fx.domestic_doc(arrivals=[fx.schedule(dep="CJU", arr="GMP")])
    folder = fx.write(tmp_path, "2025-05-29", "domestic", "a_domestic.json", doc)
    scanned = feeds.records(feeds.scan(spark, folder, domestic.read_schema("arrivals")))
    out = domestic.tables(scanned, fx.airports(spark), "arrivals")
    assert rows(out["flight_info"], "depart_airport") == [("CJU",)]


def test_repeated_and_missing_local_times(spark, tmp_path, rows):
    doc = fx.domestic_doc(
        fx.schedule(dep="JFK", at="202511020130", number="autumn"),
        fx.schedule(dep="JFK", at="202503090230", number="spring"),
    )
    out = build(spark, tmp_path, doc)
    assert rows(out["flight_info"], "depart_timestamp") == [
        (dt.datetime(2025, 11, 2, 5, 30),),
        (dt.datetime(2025, 3, 9, 7, 30),),
    ]


def test_documents_may_be_parsed_once_for_all_tables(spark, tmp_path, rows):
    folder = fx.write(tmp_path, "2025-05-29", "domestic", "0_domestic.json", fx.domestic_doc(fx.schedule(), fx.schedule(number="SA2")))
    plain = domestic.tables(raw(spark, folder), fx.airports(spark))
    once = domestic.tables(raw(spark, folder), fx.airports(spark), parsed=str(tmp_path / "parsed"))
    for name in plain:
        assert rows(plain[name]) == rows(once[name])
        assert "json" not in once[name]._jdf.queryExecution().executedPlan().toString().split("Scan ", 1)[1][:20]


def test_fares_are_shuffled_once_and_by_flight(spark, tmp_path):
    fares = build(spark, tmp_path, fx.domestic_doc(fx.schedule()))["fare_info"]
    (by,) = fx.shuffles(fares)
    assert by.startswith("air_id") and "agt_code" not in by
