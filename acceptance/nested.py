"""Nested JSON feeds, written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.views import (
    LEG,
    as_json,
    domestic_feed,
    events_feed,
    international_feed,
    table,
    written,
)
from feedmart.functions import keys, labels
from feedmart.operators.nested import elements, entries, positioned
from feedmart.plans import domestic, international
from feedmart.sources import feeds, schemas
from feedmart.sources.tables import append_batch
from feedmart.session import work_dir
from feedmart.streaming import ingest

_SEAT = "CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'D' ELSE 'Z' END"
_PLACES = """orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _domestic(spark, sf_dir):
    scanned = feeds.scan(
        spark, domestic_feed(spark, sf_dir), domestic.read_schema(), files="domestic-*.json.gz"
    )
    return feeds.records(scanned)


def _schedules(spark, sf_dir):
    return elements(
        _domestic(spark, sf_dir), "data.domesticFlights.departures", "sch", []
    ).select("sch.*")


def _international(spark, sf_dir):
    scanned = feeds.scan(
        spark, international_feed(spark, sf_dir), international.read_schema(), files="trip-*.json.gz"
    )
    return international.results(feeds.records(scanned))


@query(
    f"""
SELECT 'F' || o_orderkey || '|F' || o_orderkey AS flights,
  o_orderpriority || '|' || o_orderpriority AS airlines, {_SEAT} || '|C' AS seats,
  n_name || '|' || n_name AS cities
FROM {_PLACES}"""
)
def json_scan(spark, sf_dir):
    """Every schedule of a document, with deep paths into the array."""

    def all_of(field):
        return F.array_join(f"data.domesticFlights.departures.{field}", "|")

    return _domestic(spark, sf_dir).select(
        all_of("fitName").alias("flights"),
        all_of("airlineName").alias("airlines"),
        all_of("seatClass").alias("seats"),
        all_of("depCity").alias("cities"),
    )


@query(
    f"""
SELECT 'F' || o_orderkey AS flight, unnest([{_SEAT}, 'C']) AS seat, n_name AS dep, r_name AS arr
FROM {_PLACES}"""
)
def explode_array(spark, sf_dir):
    return _schedules(spark, sf_dir).select(
        F.col("fitName").alias("flight"),
        F.col("seatClass").alias("seat"),
        F.col("depCity").alias("dep"),
        F.col("arrCity").alias("arr"),
    )


@query(
    f"""
WITH {LEG}
SELECT 'F' || o_orderkey AS flight, unnest([{_SEAT}, 'C']) AS seat, 'A' || l_linenumber AS agent,
  CAST(p AS INTEGER) AS adult_fare, CAST(l_quantity AS INTEGER) AS fuel
FROM orders JOIN leg ON o_orderkey = l_orderkey"""
)
def explode_nested(spark, sf_dir):
    rows = elements(_schedules(spark, sf_dir), "fare", "f", ["fitName", "seatClass"])
    return rows.select(
        F.col("fitName").alias("flight"),
        F.col("seatClass").alias("seat"),
        F.col("f.agtCode").alias("agent"),
        F.col("f.adultFare").alias("adult_fare"),
        F.col("f.aFuel").alias("fuel"),
    )


_PLACED = f"""
WITH {LEG}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS n,
    string_agg(l_orderkey || '-' || l_linenumber, '+') OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS air_id,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'n/a' ELSE CAST(p AS VARCHAR) END
      AS fare_text
  FROM leg)"""


@query(
    _PLACED
    + """
SELECT air_id, CAST(n AS INTEGER) AS ord, s.n_name AS sa, c.n_name AS ea,
  strftime(l_shipdate + to_hours(6 + l_linenumber), '%Y%m%d%H%M') AS sdt
FROM placed JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation c ON c_nationkey = c.n_nationkey"""
)
def posexplode_legs(spark, sf_dir):
    listed = elements(_international(spark, sf_dir), "schedules", "listed", [])
    trips = entries(listed, "listed", "air_id", "trip", [])
    return positioned(trips, "trip.detail", "ord", "leg", ["air_id"]).select(
        "air_id", "ord", "leg.sa", "leg.ea", "leg.sdt"
    )


def _prices(spark, sf_dir):
    priced = entries(_international(spark, sf_dir), "fares", "air_id", "priced", ["fareTypes"])
    options = entries(priced, "priced.fare", "option", "listed", ["air_id", "fareTypes"])
    return elements(options, "listed", "fare", ["air_id", "fareTypes", "option"])


@query(
    _PLACED
    + """
SELECT air_id, unnest(['A01', 'A02']) AS option, 'G' || l_linenumber AS agent, fare_text
FROM placed"""
)
def explode_map(spark, sf_dir):
    return _prices(spark, sf_dir).select(
        "air_id",
        "option",
        F.col("fare.AgtCode").alias("agent"),
        F.col("fare.Adult.Fare").alias("fare_text"),
    )


@query(
    _PLACED
    + """
SELECT air_id, '성인/모든 결제수단' AS option_label, 'G' || l_linenumber AS agent, fare_text
FROM placed"""
)
def map_code_filter(spark, sf_dir):
    label = labels.decoded(F.col("fareTypes")[F.col("option")])
    return (
        _prices(spark, sf_dir)
        .withColumn("option_label", label)
        .where(F.col("option_label") == labels.ADULT_ANY_PAYMENT)
        .select(
            "air_id",
            "option_label",
            F.col("fare.AgtCode").alias("agent"),
            F.col("fare.Adult.Fare").alias("fare_text"),
        )
    )


@query(
    _PLACED
    + """
SELECT air_id, 'G' || l_linenumber AS agent, 'http://f.example/r?k=1' ||
  CASE WHEN l_linestatus = 'F' THEN '&FareRuleItnInfo=a/b/' || l_returnflag ELSE '' END AS url, option
FROM placed, (VALUES ('A01'), ('A02')) AS o(option)"""
)
def quoted_field(spark, sf_dir):
    return _prices(spark, sf_dir).select(
        "air_id",
        F.col("fare.AgtCode").alias("agent"),
        F.col("fare.priceTransparencyUrl.`#cdata-section`").alias("url"),
        "option",
    )


@query(
    f"""
SELECT 'F' || o_orderkey || '|F' || o_orderkey AS flights, 'domestic' AS kind,
  strftime(date_trunc('year', o_orderdate), 'day=%Y-%m-%d') AS folder
FROM {_PLACES}"""
)
def file_provenance(spark, sf_dir):
    parts = F.regexp_extract("file_path", "/([^/]+)/([a-z]+)-[^/]*$", 1), F.regexp_extract(
        "file_path", "/([^/]+)/([a-z]+)-[^/]*$", 2
    )
    return _domestic(spark, sf_dir).select(
        F.array_join("data.domesticFlights.departures.fitName", "|").alias("flights"),
        parts[1].alias("kind"),
        parts[0].alias("folder"),
    )


@query(
    """
SELECT event_id, user_id, 'wanted' AS kind FROM events WHERE event_type IN ('click', 'view')"""
)
def file_select(spark, sf_dir):
    def write(path):
        events = table(spark, sf_dir, "events")
        wanted = F.col("event_type").isin("click", "view")
        as_json(events.where(wanted), path, "wanted")
        as_json(events.where(~wanted), path, "other")

    folder = written(spark, sf_dir, "two-kinds", write)
    found = feeds.scan(spark, folder, schemas.struct("event_id bigint,user_id bigint"), files="wanted-*.json")
    return feeds.records(found).select(
        "event_id", "user_id", F.regexp_extract("file_path", "/([a-z]+)-[^/]*$", 1).alias("kind")
    )


@query(
    _PLACED
    + """
SELECT air_id, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS fetched_date,
  CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'C' END AS cabin
FROM placed JOIN orders ON l_orderkey = o_orderkey WHERE n = 0"""
)
def path_parts(spark, sf_dir):
    scanned = feeds.scan(
        spark, international_feed(spark, sf_dir), international.read_schema(), files="trip-*.json.gz"
    )
    trip = elements(scanned, "data.internationalList.results.schedules", "t", ["file_path"])
    return trip.select(
        F.explode(F.map_keys("t")).alias("air_id"),
        keys.path_date("file_path").cast("string").alias("fetched_date"),
        keys.path_cabin("file_path").alias("cabin"),
    )


@query(
    """
SELECT o_orderkey, o_orderstatus = 'P' AS truncated,
  CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey
FROM orders"""
)
def quarantine_corrupt(spark, sf_dir):
    def write(path):
        text = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderpriority"))
        cut = F.when(F.col("o_orderstatus") == "P", F.expr("left(text, length(text) - 4)"))
        lines = table(spark, sf_dir, "orders").select("o_orderstatus", text.alias("text"))
        lines.select(F.coalesce(cut, F.col("text")).alias("value")).write.text(path)

    folder = written(spark, sf_dir, "truncated", write)
    schema = schemas.struct("o_orderkey bigint,o_custkey bigint,o_orderpriority string")
    scanned = feeds.scan(spark, folder, schema)
    good = (
        feeds.records(scanned)
        .where("o_orderkey is not null")
        .select("o_orderkey", F.lit(False).alias("truncated"), "o_custkey")
    )
    number = F.regexp_extract("record", r'"o_orderkey":(\d+)', 1).try_cast("bigint")
    bad = feeds.quarantine(scanned).select(
        number.alias("o_orderkey"),
        F.lit(True).alias("truncated"),
        F.lit(None).cast("bigint").alias("o_custkey"),
    )
    return good.unionByName(bad)


_EVENTS = "SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us, props FROM events"


def _events_stream(spark, sf_dir, **limits):
    fields = "event_id bigint,user_id bigint,ts_us bigint,props string,event_type string"
    stream = feeds.scan_stream(
        spark,
        events_feed(spark, sf_dir),
        schemas.struct(fields),
        files="events-*.json",
        **(limits or {"max_files": 4}),
    )
    return feeds.records(stream).select("event_id", "user_id", "event_type", "ts_us", "props")


@query(_EVENTS)
def stream_ingest(spark, sf_dir):
    """Through the file sink, which records each trigger's files and so writes none twice."""
    folder = work_dir(spark, "stream-ingest")
    stream = _events_stream(spark, sf_dir)
    started = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/events")
    )
    ingest.wait(started)
    return spark.read.schema(stream.schema).parquet(f"{folder}/events")


@query(_EVENTS)
def chunked_ingest(spark, sf_dir):
    """A bounded number of files at a time, each chunk under its own batch id."""
    folder = work_dir(spark, "chunked-ingest")
    stream = _events_stream(spark, sf_dir)

    def append(batch, batch_id):
        append_batch(batch, f"{folder}/events", batch_id)

    ingest.run_to_end(stream, append, f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/events").drop("batch_id")


@query(_EVENTS)
def chunked_by_bytes(spark, sf_dir):
    """As ``chunked_ingest``, with chunks of about a megabyte; files of finished chunks may be archived."""
    folder = work_dir(spark, "chunked-by-bytes")
    stream = _events_stream(spark, sf_dir, max_bytes=1_000_000)
    ingest.run_to_end(
        stream, lambda batch, batch_id: append_batch(batch, f"{folder}/events", batch_id), f"{folder}/checkpoint"
    )
    return spark.read.parquet(f"{folder}/events").drop("batch_id")
