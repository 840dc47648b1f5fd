from __future__ import annotations

import datetime as dt

from feedmart.functions.labels import SEVERAL_AIRLINES
from feedmart.operators.rollup import daily_rollup
from feedmart.plans import international
from feedmart.sources import feeds
from tests import fixtures as fx

DIRECT = fx.itinerary(fx.leg("ICN", "NRT", "202506010900", "202506011120"), journey=("02", "20"))
LEG1 = fx.leg("ICN", "NRT", "202506010900", "202506011120", jt="02:20")
LEG2 = fx.leg("NRT", "JFK", "202506011400", "202506011330", av="OA", ct="0240", jt="1230")
LEG3 = fx.leg("JFK", "CDG", "202506011700", "202506020630", av="SA", ct="0330", jt="?")
THREE = fx.itinerary(LEG1, LEG2, LEG3, journey=("28", "30"))


def scanned(spark, tmp_path, *docs, day="2025-05-29", cabin="C"):
    for i, doc in enumerate(docs):
        name = f"2025-06-01_ICN_CDG_{cabin}_{i}_international.json"
        folder = fx.write(tmp_path, day, "international", name, doc)
    return feeds.records(
        feeds.scan(
            spark, folder, international.read_schema(), files=feeds.INTERNATIONAL_FILES
        )
    )


def build(spark, tmp_path, *docs, **more):
    return international.tables(scanned(spark, tmp_path, *docs, **more), fx.airports(spark))


def doc(itineraries, fares=None, **more):
    return fx.international_doc([itineraries], fares or {}, **more)


def test_same_direct_flight_in_two_files(spark, tmp_path, rows):
    out = build(spark, tmp_path, doc({"K1": DIRECT}), doc({"K1": DIRECT}))
    assert rows(out["flight_info"], "air_id", "airline", "is_layover", "journey_time") == [
        ("K1", "Sky Air", False, 140)
    ]
    assert out["layover_info"].count() == 0


def test_three_legs_two_airlines(spark, tmp_path, rows):
    out = build(
        spark, tmp_path,
        doc({"K1+K2+K3": THREE}, {"K1+K2+K3": fx.fares_of(fx.price())}),
    )
    flights = out["flight_info"]
    assert rows(
        flights.where("is_layover"), "air_id", "airline", "depart_airport", "arrival_airport",
        "depart_timestamp", "arrival_timestamp", "arrival_local_ts", "journey_time",
    ) == [
        ("K1+K2+K3", None, "ICN", "CDG", dt.datetime(2025, 6, 1, 0, 0),
         dt.datetime(2025, 6, 2, 4, 30), dt.datetime(2025, 6, 2, 6, 30), 1710)
    ]
    assert rows(flights.where("not is_layover"), "air_id", "airline", "journey_time") == [
        ("K1", "Sky Air", 140), ("K2", "Ocean Air", 750), ("K3", "Sky Air", None)
    ]
    assert rows(out["layover_info"].drop("fetched_date", "file_path")) == [
        ("K1+K2+K3", "K1", 0, 0), ("K1+K2+K3", "K2", 1, 160), ("K1+K2+K3", "K3", 2, 210)
    ]
    rollup = daily_rollup(flights, out["fare_info"])
    assert rows(rollup, "airline", "seat_class", "fare_class", "mean_price", "ticket_count") == [
        (SEVERAL_AIRLINES, "비즈니스석", "K", 120500, 1)
    ]


def test_unknown_airport_drops_the_itinerary_or_only_the_leg(spark, tmp_path, rows):
    strange = fx.itinerary(LEG1, fx.leg("NRT", "ZZZ", "202506011400", "202506011500"))
    raw = scanned(
        spark, tmp_path,
        doc({"K1+K9": strange, "K1": DIRECT}, {"K1+K9": fx.fares_of(fx.price()), "K1": fx.fares_of(fx.price())}),
    )
    out = international.tables(raw, fx.airports(spark))
    assert rows(out["flight_info"], "air_id") == [("K1",)]
    assert rows(out["fare_info"], "air_id") == [("K1",)]
    base = international.results(raw)
    trips = international.trips(base, fx.airports(spark), whole=False)
    assert rows(international.legs(trips), "full_air_id", "ord") == [("K1", 0), ("K1+K9", 0)]


def test_fares(spark, tmp_path, rows):
    listed = {
        "K1": {
            "sch": ["K1"],
            "fare": {
                "A01": [
                    fx.price(),
                    fx.price(agent="A2", url=None),
                    fx.price(agent="A3", url="FareRuleItnInfo=a/b"),
                    fx.price(agent="A4", fare="much"),
                    fx.price(agent="A5", url="x=1"),
                ],
                "A02": [fx.price(agent="card")],
                "A03": [fx.price(agent="unknown option")],
            },
        },
        "K7": fx.fares_of(fx.price(agent="no such flight")),
    }
    out = build(spark, tmp_path, doc({"K1": DIRECT}, listed))
    assert rows(out["fare_info"], "agt_code", "adult_fare", "fare_class") == [
        ("A1", 120500, "K"), ("A2", 120500, "n"), ("A3", 120500, "n"), ("A4", None, "K"),
        ("A5", 120500, "n"),
    ]
    assert rows(out["fare_info"].select("fetched_date", "seat_class").distinct()) == [
        (dt.date(2025, 5, 29), "비즈니스석")
    ]


def test_fares_of_a_leg_are_kept(spark, tmp_path, rows):
    out = build(spark, tmp_path, doc({"K1+K2+K3": THREE}, {"K2": fx.fares_of(fx.price())}))
    assert rows(out["fare_info"], "air_id") == [("K2",)]


def test_leg_listed_as_itinerary_too(spark, tmp_path, rows):
    out = build(spark, tmp_path, doc({"K1+K2+K3": THREE, "K3": fx.itinerary(LEG3, journey=("07", "30"))}))
    assert rows(out["flight_info"].where("air_id = 'K3'"), "journey_time") == [(450,)]


def test_broken_encoding_and_missing_names(spark, tmp_path, rows):
    out = build(spark, tmp_path, doc({"K1": DIRECT}, airlines={"SA": "%zz"}))
    assert rows(out["flight_info"], "airline") == [(None,)]


def test_other_cabins_and_unknown_cabin(spark, tmp_path, rows):
    for i, (cabin, name) in enumerate({"Y": "일반석", "P": "이코노미", "F": "일등석", "Q": None}.items()):
        raw = scanned(
            spark, tmp_path / str(i), doc({"K1": DIRECT}, {"K1": fx.fares_of(fx.price())}), cabin=cabin
        )
        base = international.results(raw)
        assert rows(base, "seat_class") == [(name,)]


def test_order_of_files_does_not_matter(spark, tmp_path, rows):
    docs = [
        doc({"K1": DIRECT, "K1+K2+K3": THREE}, {"K1": fx.fares_of(fx.price())}),
        doc({"K1": fx.itinerary(LEG1, journey=("09", "09"))}, {"K1": fx.fares_of(fx.price(fare="1"))}),
    ]
    raw = scanned(spark, tmp_path, *docs)
    one = international.tables(raw, fx.airports(spark))
    two = international.tables(raw.repartition(3, "file_path"), fx.airports(spark))
    for name in one:
        assert rows(one[name]) == rows(two[name])


def test_documents_may_be_parsed_once_for_all_tables(spark, tmp_path, rows):
    doc = fx.international_doc([{"K1": DIRECT, "K1+K2+K3": THREE}], {"K1": fx.fares_of(fx.price())})
    folder = fx.write(tmp_path, "2025-05-29", "international", "a_Y_0_international.json", doc)
    raw = feeds.records(feeds.scan(spark, folder, international.read_schema()))
    plain = international.tables(raw, fx.airports(spark))
    once = international.tables(raw, fx.airports(spark), str(tmp_path / "parsed"))
    for name in plain:
        assert rows(plain[name]) == rows(once[name])


def test_fares_are_shuffled_once_and_by_id(spark, tmp_path):
    fares = build(spark, tmp_path, doc({"K1": DIRECT}, {"K1": fx.fares_of(fx.price())}))["fare_info"]
    by = fx.shuffles(fares)
    assert by and not [b for b in by if "agt_code" in b]
