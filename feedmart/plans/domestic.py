"""Domestic feed: one schedule per flight, with its fares inside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedmart.functions import keys, labels, money, times
from feedmart.operators.dedupe import by_version, newest, split_by_key
from feedmart.operators.lookup import lookup
from feedmart.operators.nested import elements
from feedmart.session import written
from feedmart.sources import feeds, schemas

# The crawl day and the file decide which of several reports of a flight or a fare counts.
NEWEST = ["fetched_date", "file_path"]

FARE_KEYS = ["air_id", "seat_class", "agt_code", "fetched_date", "fare_class"]

# What a fare cannot do without. Its seat class may be unknown, as the code is part of the flight's id and
# keeps such fares apart; and files without a day count as crawled on one unknown day.
FARE_PARTS = ["air_id", "agt_code", "fare_class"]

_READ = [
    "airlineCode",
    "airlineName",
    "fitName",
    "depCity",
    "arrCity",
    "departureDate",
    "arrivalDate",
    "seatClass",
    "journeyTime",
    "fare.agtCode",
    "fare.adultFare",
    "fare.aFuel",
    "fare.aTax",
    "fare.publishFee",
]


def read_schema(direction: str = "departures") -> StructType:
    """The fields the jobs use."""
    top = f"data.domesticFlights.{direction}"
    return feeds.prune(schemas.struct(schemas.DOMESTIC), [f"{top}.{f}" for f in _READ])


def schedules(raw: DataFrame, direction: str = "departures") -> DataFrame:
    """One row per schedule, with its key, its labels and its local times."""
    rows = elements(
        raw,
        F.col(f"data.domesticFlights.{direction}"),
        "sch",
        ["file_path", keys.path_date("file_path").alias("fetched_date")],
    ).select("sch.*", "file_path", "fetched_date")
    return rows.select(
        keys.composite_key(
            "departureDate", "depCity", "arrCity", "airlineCode", "fitName", "seatClass"
        ).alias("air_id"),
        F.col("airlineName").alias("airline"),
        F.col("depCity").alias("depart_airport"),
        F.col("arrCity").alias("arrival_airport"),
        times.local_time("departureDate").alias("depart_local_ts"),
        times.local_time("arrivalDate").alias("arrival_local_ts"),
        times.minutes_hh_mm("journeyTime").alias("journey_time"),
        labels.label(F.col("seatClass"), labels.DOMESTIC_SEATS).alias("seat_class"),
        "fare",
        "fetched_date",
        "file_path",
    )


def flights(base: DataFrame, airports: DataFrame) -> DataFrame:
    """One row per flight, with its times in UTC. An unknown airport counts as UTC; ``tz_known``
    tells."""
    keyed = base.where(F.col("air_id").isNotNull())
    single = newest(keyed.drop("fare", "seat_class"), ["air_id"], by_version(NEWEST))
    return with_utc(single, airports).select(
        "air_id",
        "airline",
        "depart_airport",
        times.to_utc("depart_local_ts", "dep_zone").alias("depart_timestamp"),
        "depart_local_ts",
        "arrival_airport",
        times.to_utc("arrival_local_ts", "arr_zone").alias("arrival_timestamp"),
        "arrival_local_ts",
        "journey_time",
        F.lit(False).alias("is_layover"),
        F.to_date("depart_local_ts").alias("depart_date"),
        (F.col("dep_known") & F.col("arr_known")).alias("tz_known"),
        "fetched_date",
        F.lit(True).alias("listed"),
        "file_path",
    )


def with_utc(df: DataFrame, airports: DataFrame) -> DataFrame:
    """Add the zones of both airports, with UTC for an unknown airport and for a zone that is missing
    or does not exist."""
    airports = airports.withColumn("time_zone", times.real_zone("time_zone"))
    for end, code in (("dep", "depart_airport"), ("arr", "arrival_airport")):
        df = lookup(
            df,
            airports,
            code,
            "airport_code",
            {"time_zone": f"{end}_zone"},
            {f"{end}_zone": F.lit("UTC")},
            known=f"{end}_known",
        )
    return df


def fares(base: DataFrame) -> DataFrame:
    """One row per flight, class, agent and crawl day. Flights without fares give none.

    The schedules travel once, by flight and with their fares inside: a flight's fares are then made
    unique, and joined with it, where they are."""
    by_flight = base.where(F.col("air_id").isNotNull()).repartition("air_id")
    keyed, _ = split_by_key(_priced(by_flight), FARE_PARTS)
    return newest(keyed, FARE_KEYS, by_version(["file_path"]))


def _priced(base: DataFrame) -> DataFrame:
    """All fares of the flights that have an id."""
    keyed = base.where(F.col("air_id").isNotNull())
    rows = elements(keyed, "fare", "f", ["air_id", "seat_class", "fetched_date", "file_path"])
    return rows.select(
        "air_id",
        "seat_class",
        F.col("f.agtCode").alias("agt_code"),
        money.total(*[F.col(f"f.{p}") for p in ("adultFare", "aTax", "aFuel", "publishFee")]).alias(
            "adult_fare"
        ),
        "fetched_date",
        F.lit("n").alias("fare_class"),
        "file_path",
    )


def unkeyed(base: DataFrame) -> DataFrame:
    """The schedules and fares that lack a part of their key, one by one. They go to no table: without
    the key nothing tells them apart. A schedule without an id takes its fares along."""
    _, schedule = split_by_key(base, ["air_id"])
    _, fare = split_by_key(_priced(base), FARE_PARTS)
    return rejected(schedule, "flight_info").unionByName(rejected(fare, "fare_info"))


def rejected(rows: DataFrame, goes_to: str) -> DataFrame:
    """Rows that ``split_by_key`` parted, as records of the reject output."""
    record = F.to_json(F.struct(*[c for c in rows.columns if c != "lacks"]))
    return rows.select("file_path", F.lit(goes_to).alias("goes_to"), "lacks", record.alias("record"))


def tables(
    raw: DataFrame, airports: DataFrame, direction: str = "departures", parsed: str | None = None
) -> dict[str, DataFrame]:
    """The output tables of one batch of documents. ``parsed`` names a folder for the schedules, so that
    the documents are parsed once for all tables."""
    base = schedules(raw, direction)
    return tables_of(written(base, parsed) if parsed else base, airports)


def tables_of(base: DataFrame, airports: DataFrame) -> dict[str, DataFrame]:
    return {"flight_info": flights(base, airports), "fare_info": fares(base)}
