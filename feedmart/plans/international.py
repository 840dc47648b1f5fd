"""International feed: itineraries of one or more legs, with fares listed apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedmart.functions import keys, labels, money, times
from feedmart.operators import itinerary
from feedmart.operators.dedupe import by_version, having_key, newest, split_by_key
from feedmart.operators.nested import elements, entries, positioned
from feedmart.plans.domestic import FARE_KEYS, NEWEST, rejected, with_utc
from feedmart.session import written
from feedmart.sources import feeds, schemas

# What a fare cannot do without. Only its crawl day may be unknown.
FARE_PARTS = ["air_id", "seat_class", "agt_code", "fare_class"]

_RESULTS = "data.internationalList.results"
_READ = [
    "airlines",
    "fareTypes",
    *[f"schedules.detail.{f}" for f in ("sa", "ea", "av", "sdt", "edt", "jt", "ct")],
    "schedules.journeyTime",
    *[f"fares.fare.Adult.{f}" for f in ("Fare", "NaverFare", "Tax", "QCharge")],
    "fares.fare.AgtCode",
    "fares.fare.priceTransparencyUrl",
]


def read_schema() -> StructType:
    """The fields the jobs use."""
    whole = schemas.struct(schemas.INTERNATIONAL)
    return feeds.prune(whole, [f"{_RESULTS}.{f}" for f in _READ])


def results(raw: DataFrame) -> DataFrame:
    """One row per document, with the crawl day and the cabin from its path."""
    cabin = labels.label(keys.path_cabin("file_path"), labels.INTERNATIONAL_SEATS)
    return raw.select(
        *[f"{_RESULTS}.{f}" for f in ("airlines", "fareTypes", "fares", "schedules")],
        keys.path_date("file_path").alias("fetched_date"),
        cabin.alias("seat_class"),
        "file_path",
    )


def itineraries(base: DataFrame) -> DataFrame:
    """One row per itinerary id, from the newest document that lists it.

    Airline names are looked up inside the row, so that the documents' maps stay out of the
    shuffle, and all legs of an itinerary come from one document.
    """
    context = ["airlines", "fetched_date", "file_path"]
    listed = entries(
        elements(base, "schedules", "listed", context), "listed", "full_air_id", "itinerary", context
    )
    named = listed.select(
        "full_air_id",
        F.transform(
            "itinerary.detail",
            lambda leg: F.struct(
                leg["sa"].alias("depart_airport"),
                leg["ea"].alias("arrival_airport"),
                times.local_time(leg["sdt"]).alias("depart_local_ts"),
                times.local_time(leg["edt"]).alias("arrival_local_ts"),
                labels.decoded(F.col("airlines")[leg["av"]]).alias("airline"),
                times.minutes_any(leg["jt"]).alias("leg_time"),
                times.minutes_hhmm(leg["ct"]).alias("connect_time"),
            ),
        ).alias("detail"),
        times.minutes_pair("itinerary.journeyTime").alias("journey_time"),
        "fetched_date",
        "file_path",
    )
    return newest(named, ["full_air_id"], by_version(NEWEST))


_CARRY = ["journey_time", "fetched_date", "file_path"]


def trips(base: DataFrame, airports: DataFrame, whole: bool = True) -> DataFrame:
    """One row per itinerary, with its legs in order and their times in UTC.

    A leg from or to an unknown airport takes its whole itinerary along; with ``whole=False`` only
    that leg is dropped. The legs are still partitioned by itinerary when they are put together
    again, so the only shuffle is that of the newest itineraries.
    """
    gathered = gathered_trips(base, airports, whole)
    return gathered.where("known").drop("known")


def gathered_trips(base: DataFrame, airports: DataFrame, whole: bool = True) -> DataFrame:
    """As ``trips``, with the itineraries that drop out too: ``known`` tells."""
    rows = positioned(itineraries(base), "detail", "ord", "leg", ["full_air_id", *_CARRY])
    flat = rows.select("full_air_id", *_CARRY, "ord", "leg.*")
    zoned = with_utc(flat, airports).select(
        *flat.columns,
        times.to_utc("depart_local_ts", "dep_zone").alias("depart_ts"),
        times.to_utc("arrival_local_ts", "arr_zone").alias("arrival_ts"),
        (F.col("dep_known") & F.col("arr_known")).alias("known"),
    )
    if not whole:
        return itinerary.gather(zoned.where("known"), _CARRY).withColumn("known", F.lit(True))
    return itinerary.gather(zoned, _CARRY).withColumn("known", F.forall("legs", lambda leg: leg["known"]))


def legs(known_trips: DataFrame) -> DataFrame:
    """One row per itinerary and leg position."""
    return known_trips.select("full_air_id", *_CARRY, F.inline("legs")).drop("known")


def flights(known_trips: DataFrame) -> DataFrame:
    """One row per itinerary and per leg of a connection. Where a leg is also listed as an
    itinerary, the newest report counts, and of equally new ones the itinerary."""
    reports = itinerary.flights(known_trips, ["fetched_date", "file_path"])
    return newest(
        reports.where(F.col("air_id").isNotNull()), ["air_id"], by_version(["fetched_date", "listed", "file_path"])
    ).withColumn("depart_date", F.to_date("depart_local_ts"))


def fares(
    base: DataFrame, known_trips: DataFrame, option_label: str = labels.ADULT_ANY_PAYMENT
) -> DataFrame:
    """One row per id, class, agent, crawl day and fare class, for one payment option.

    The fares travel once, by id: they are made unique, and joined with their flights, where they are."""
    keyed, _ = split_by_key(_priced(base, option_label), FARE_PARTS)
    single = newest(keyed.repartition("air_id"), FARE_KEYS, by_version(["file_path"]))
    return having_key(single, itinerary.air_ids(known_trips), "air_id")


def _priced(base: DataFrame, option_label: str = labels.ADULT_ANY_PAYMENT) -> DataFrame:
    """All fares of one payment option."""
    context = ["fareTypes", "seat_class", "fetched_date", "file_path"]
    priced = entries(base, "fares", "air_id", "priced", context)
    options = entries(priced, "priced.fare", "option", "fare_list", ["air_id", *context])
    wanted = options.where(
        labels.decoded(F.col("fareTypes")[F.col("option")]) == F.lit(option_label)
    )
    kept = ["air_id", "seat_class", "fetched_date", "file_path"]
    return elements(wanted, "fare_list", "fare", kept).select(
        "air_id",
        "seat_class",
        F.col("fare.AgtCode").alias("agt_code"),
        money.total(
            *[F.col(f"fare.Adult.{p}") for p in ("Fare", "NaverFare", "Tax", "QCharge")]
        ).alias("adult_fare"),
        "fetched_date",
        keys.url_param_part("fare.priceTransparencyUrl.`#cdata-section`").alias("fare_class"),
        "file_path",
    )


def layovers(known_trips: DataFrame) -> DataFrame:
    return itinerary.layovers(known_trips, ["fetched_date", "file_path"])


def unkeyed(base: DataFrame, known_trips: DataFrame) -> DataFrame:
    """The fares that lack a part of their key, and the legs whose position is beyond the parts of their
    itinerary's id, one by one."""
    found = legs(known_trips).where(keys.is_connection("full_air_id"))
    _, leg = split_by_key(found.withColumn("air_id", keys.leg_id("full_air_id", "ord")), ["air_id"])
    _, fare = split_by_key(_priced(base), FARE_PARTS)
    return rejected(leg, "flight_info").unionByName(rejected(fare, "fare_info"))


def tables(raw: DataFrame, airports: DataFrame, parsed: str | None = None) -> dict[str, DataFrame]:
    """The output tables of one batch of documents. ``parsed`` names a folder for documents and trips, so
    that both are worked out once for all tables."""
    base = results(raw)
    if parsed:
        base = written(base, f"{parsed}/results")
    known = trips(base, airports)
    return tables_of(base, written(known, f"{parsed}/trips") if parsed else known)


def tables_of(base: DataFrame, known_trips: DataFrame) -> dict[str, DataFrame]:
    return {
        "flight_info": flights(known_trips),
        "fare_info": fares(base, known_trips),
        "layover_info": layovers(known_trips),
    }
