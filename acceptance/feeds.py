"""Both feeds from documents to tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.nested import _PLACES
from acceptance.registry import query
from acceptance.views import LEG, ZONE, airports, domestic_feed, international_feed, repeat_feed
from feedmart.operators.rollup import daily_rollup
from feedmart.plans import domestic, international, runs
from feedmart.plans.warehouse import Warehouse
from feedmart.session import work_dir
from feedmart.sources import feeds

#: Files per trigger.
CHUNK = 8

_VERSION = ("fetched_date", "listed", "file_path")
_DATES = ("depart_date", "fetched_date")
_TIMES = {"depart_timestamp": "depart_us", "arrival_timestamp": "arrival_us"}


def _plain(df):
    """Days as text and instants as microseconds."""
    for name in df.columns:
        if name in _DATES:
            df = df.withColumn(name, F.col(name).cast("string"))
        elif name in _TIMES:
            df = df.withColumn(name, F.unix_micros(name)).withColumnRenamed(name, _TIMES[name])
    return df.drop("depart_local_ts", "arrival_local_ts")


def _domestic(spark, sf_dir, parsed=None):
    scanned = feeds.scan(
        spark, domestic_feed(spark, sf_dir), domestic.read_schema(), files="domestic-*.json.gz"
    )
    return domestic.tables(feeds.records(scanned), airports(spark, sf_dir), parsed=parsed)


def _international(spark, sf_dir, parsed=None):
    scanned = feeds.scan(
        spark, international_feed(spark, sf_dir), international.read_schema(), files="trip-*.json.gz"
    )
    return international.tables(feeds.records(scanned), airports(spark, sf_dir), parsed)


_DOMESTIC = f"""
WITH {LEG}, {ZONE}, schedule AS (
  SELECT o_orderkey, o_orderdate, o_orderpriority, n_name, r_name,
    o_orderdate + to_hours(6) + to_minutes(o_orderkey % 600) AS dep, unnest([
      CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'D' ELSE 'Z' END, 'C']) AS seat
  FROM {_PLACES}),
flight AS (
  SELECT strftime(dep, '%Y%m%d%H%M') || n_name || r_name || 'A' || substr(o_orderpriority, 1, 1)
      || 'F' || o_orderkey || seat AS air_id,
    o_orderkey, o_orderpriority AS airline, schedule.n_name AS depart_airport,
    r_name AS arrival_airport, dep, tz,
    CASE seat WHEN 'Y' THEN '일반석' WHEN 'D' THEN '할인석' WHEN 'C' THEN '비즈니스석' END
      AS seat_class,
    strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS fetched_date
  FROM schedule LEFT JOIN zone USING (n_name)),
fare AS (
  SELECT air_id, seat_class, 'A' || l_linenumber AS agt_code,
    CAST(p + CAST(round(l_tax * 100) AS INTEGER) + CAST(l_quantity AS INTEGER) + l_linenumber
      AS INTEGER) AS adult_fare, fetched_date, 'n' AS fare_class
  FROM flight JOIN leg ON o_orderkey = l_orderkey)"""


@query(
    _DOMESTIC
    + """
SELECT air_id, airline, depart_airport, epoch_us(timezone(coalesce(tz, 'UTC'), dep)) AS depart_us,
  arrival_airport, epoch_us(dep + to_minutes(90)) AS arrival_us, CAST(90 AS INTEGER) AS journey_time,
  false AS is_layover, strftime(dep, '%Y-%m-%d') AS depart_date, false AS tz_known
FROM flight"""
)
def domestic_flights(spark, sf_dir):
    return _plain(_domestic(spark, sf_dir)["flight_info"].drop(*_VERSION))


@query(_DOMESTIC + "SELECT * FROM fare")
def domestic_fares(spark, sf_dir):
    return _plain(_domestic(spark, sf_dir)["fare_info"].drop("file_path"))


_DOMESTIC_ROLLUP = (
    _DOMESTIC
    + """
SELECT depart_airport, arrival_airport, strftime(dep, '%Y-%m-%d') AS depart_date,
  false AS is_layover, airline, fare.seat_class, fare_class, fare.fetched_date,
  CAST(sum(adult_fare) // count(adult_fare) AS INTEGER) AS mean_price,
  CAST(quantile_disc(adult_fare, 0.5) AS INTEGER) AS median_price, count(*) AS ticket_count
FROM flight JOIN fare USING (air_id) GROUP BY ALL"""
)


@query(_DOMESTIC_ROLLUP)
def domestic_rollup(spark, sf_dir):
    tables = _domestic(spark, sf_dir)
    return _plain(daily_rollup(tables["flight_info"], tables["fare_info"]))


@query(_DOMESTIC_ROLLUP)
def stream_to_rollup(spark, sf_dir):
    """The same through the stored tables, some files at a time."""
    warehouse = Warehouse(work_dir(spark, "streamed"), slots=8)
    runs.run_folder(
        spark,
        runs.DOMESTIC,
        domestic_feed(spark, sf_dir),
        airports(spark, sf_dir),
        warehouse,
        work_dir(spark, "streamed-checkpoint"),
        max_files=CHUNK,
        files="domestic-*.json.gz",
    )
    return _plain(warehouse.daily.read(spark))


_REPEATS = f"""
WITH {ZONE}, known AS (
  SELECT o_orderkey, o_orderpriority, d.n_name AS depart_airport, a.n_name AS arrival_airport, dz.tz AS dep_zone,
    az.tz AS arr_zone, o_orderdate + to_hours(6) + to_minutes(o_orderkey % 600) AS dep, o_orderkey % 3 = 0 AS again,
    60 + o_orderkey % 240 + CASE WHEN o_orderkey % 3 = 0 THEN 30 ELSE 0 END AS minutes,
    CAST(round(o_totalprice * 100) AS BIGINT) + o_orderkey % 7 AS price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation d ON c_nationkey = d.n_nationkey
    JOIN nation a ON a.n_nationkey = (d.n_nationkey + o_orderkey) % 25
    LEFT JOIN zone dz ON dz.n_name = d.n_name LEFT JOIN zone az ON az.n_name = a.n_name),
flight AS (
  SELECT *, strftime(dep, '%Y%m%d%H%M') || depart_airport || arrival_airport || 'AAF' || o_orderkey || 'Y' AS air_id,
    CASE WHEN again THEN 'Late ' ELSE '' END || o_orderpriority AS airline
  FROM known)"""


def _repeats(spark, sf_dir):
    return feeds.scan(spark, repeat_feed(spark, sf_dir), domestic.read_schema(), files="domestic-*.json.gz")


@query(
    _REPEATS
    + """
SELECT air_id, airline, depart_airport, epoch_us(timezone(coalesce(dep_zone, 'UTC'), dep)) AS depart_us, arrival_airport,
  epoch_us(timezone(coalesce(arr_zone, 'UTC'), dep + to_minutes(CAST(minutes AS INTEGER)))) AS arrival_us,
  CAST(minutes AS INTEGER) AS journey_time, false AS is_layover, strftime(dep, '%Y-%m-%d') AS depart_date,
  dep_zone IS NOT NULL AND arr_zone IS NOT NULL AS tz_known
FROM flight"""
)
def repeated_flights(spark, sf_dir):
    """Flights that occur in documents of two days, with both ends in zones: the newest one counts."""
    tables = domestic.tables(feeds.records(_repeats(spark, sf_dir)), airports(spark, sf_dir))
    return _plain(tables["flight_info"].drop(*_VERSION))


@query(
    _REPEATS
    + """
SELECT depart_airport, arrival_airport, strftime(dep, '%Y-%m-%d') AS depart_date, false AS is_layover, airline,
  '일반석' AS seat_class, 'n' AS fare_class, day AS fetched_date,
  CAST(sum(price + late + fee) // count(*) AS INTEGER) AS mean_price,
  CAST(quantile_disc(price + late + fee, 0.5) AS INTEGER) AS median_price, count(*) AS ticket_count
FROM flight, (VALUES ('2025-03-01', 0), ('2025-03-02', 100)) AS d(day, late), (VALUES (1), (2)) AS f(fee)
WHERE late = 0 OR again GROUP BY ALL"""
)
def repeated_rollup(spark, sf_dir):
    """Through the stored tables, day by day: the second day moves a third of the flights to groups of another
    airline, with the fares of the first day, and brings fares without an agent, which go to the rejects."""
    warehouse = Warehouse(work_dir(spark, "repeats"), slots=8)
    raw = _repeats(spark, sf_dir)
    for day in ("2025-03-01", "2025-03-02"):
        documents = raw.where(F.col("file_path").contains(f"day={day}"))
        runs.run_domestic(documents, airports(spark, sf_dir), warehouse)
    return _plain(warehouse.daily.read(spark))


_INTERNATIONAL = f"""
WITH {LEG}, {ZONE}, placed AS (
  SELECT *, row_number() OVER trip - 1 AS n, count(*) OVER trip_all AS legs,
    string_agg(l_orderkey || '-' || l_linenumber, '+') OVER trip_all AS full_air_id
  FROM leg WINDOW trip AS (PARTITION BY l_orderkey ORDER BY l_linenumber),
    trip_all AS (PARTITION BY l_orderkey ORDER BY l_linenumber
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
zoned AS (
  SELECT placed.*, l_shipdate + to_hours(6 + l_linenumber) AS dep, s.n_name AS sa, c.n_name AS ea,
    sz.tz AS dep_zone, cz.tz AS arr_zone, o_orderstatus,
    strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS fetched_date,
    bool_and(sz.tz IS NOT NULL AND cz.tz IS NOT NULL) OVER (PARTITION BY l_orderkey) AS known
  FROM placed JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation c ON c_nationkey = c.n_nationkey
    LEFT JOIN zone sz ON sz.n_name = s.n_name LEFT JOIN zone cz ON cz.n_name = c.n_name),
hop AS (
  SELECT *, l_orderkey || '-' || l_linenumber AS leg_id, 'Air ' || l_returnflag AS airline,
    epoch_us(timezone(dep_zone, dep)) AS depart_us,
    epoch_us(timezone(arr_zone, dep + to_hours(2))) AS arrival_us
  FROM zoned WHERE known),
flight AS (
  SELECT full_air_id AS air_id,
    CASE WHEN count(DISTINCT airline) = 1 THEN min(airline) END AS airline,
    arg_min(sa, n) AS depart_airport, min(depart_us) AS depart_us, arg_max(ea, n) AS arrival_airport,
    max(arrival_us) AS arrival_us, CAST(max(legs) * 60 + 30 AS INTEGER) AS journey_time,
    max(legs) > 1 AS is_layover, strftime(arg_min(dep, n), '%Y-%m-%d') AS depart_date
  FROM hop GROUP BY full_air_id
  UNION ALL
  SELECT leg_id, airline, sa, depart_us, ea, arrival_us,
    CAST(120 + l_quantity AS INTEGER), false, strftime(dep, '%Y-%m-%d')
  FROM hop WHERE legs > 1),
fare AS (
  SELECT full_air_id AS air_id,
    CASE WHEN o_orderstatus = 'F' THEN '일반석' ELSE '비즈니스석' END AS seat_class,
    'G' || l_linenumber AS agt_code,
    CASE WHEN l_returnflag <> 'R' OR l_linestatus <> 'F' THEN CAST(p
      + CAST(round(l_tax * 100) AS INTEGER) + CAST(l_quantity AS INTEGER) AS INTEGER) END
      AS adult_fare,
    fetched_date, CASE WHEN l_linestatus = 'F' THEN l_returnflag ELSE 'n' END AS fare_class
  FROM hop)"""


@query(_INTERNATIONAL + "SELECT * FROM flight")
def international_flights(spark, sf_dir):
    return _plain(_international(spark, sf_dir)["flight_info"].drop(*_VERSION))


@query(_INTERNATIONAL + "SELECT * FROM fare")
def international_fares(spark, sf_dir):
    return _plain(_international(spark, sf_dir)["fare_info"].drop("file_path"))


_LAYOVERS = (
    _INTERNATIONAL
    + """
SELECT full_air_id AS air_id, leg_id AS segment_id, CAST(n AS INTEGER) AS layover_order,
  CAST(60 + l_quantity AS INTEGER) AS connect_time
FROM hop WHERE legs > 1"""
)


@query(_LAYOVERS)
def international_layovers(spark, sf_dir):
    return _international(spark, sf_dir)["layover_info"].drop(*_VERSION)


_INTERNATIONAL_ROLLUP = (
    _INTERNATIONAL
    + """
SELECT depart_airport, arrival_airport, depart_date, is_layover,
  coalesce(airline, 'airline 여러개') AS airline, seat_class, fare_class, fetched_date,
  CAST(sum(adult_fare) // count(adult_fare) AS INTEGER) AS mean_price,
  CAST(quantile_disc(adult_fare, 0.5) AS INTEGER) AS median_price, count(*) AS ticket_count
FROM flight JOIN fare USING (air_id) GROUP BY ALL"""
)


@query(_INTERNATIONAL_ROLLUP)
def international_rollup(spark, sf_dir):
    tables = _international(spark, sf_dir)
    return _plain(daily_rollup(tables["flight_info"], tables["fare_info"]))


def _streamed_international(spark, sf_dir, rollup):
    warehouse = Warehouse(work_dir(spark, "streamed"), slots=8)
    runs.run_folder(
        spark,
        runs.INTERNATIONAL,
        international_feed(spark, sf_dir),
        airports(spark, sf_dir),
        warehouse,
        work_dir(spark, "streamed-checkpoint"),
        max_files=4 * CHUNK,
        files="trip-*.json.gz",
        rollup=rollup,
    )
    return warehouse


@query(_INTERNATIONAL_ROLLUP)
def international_stream_to_rollup(spark, sf_dir):
    """The same through the stored tables, some files at a time."""
    return _plain(_streamed_international(spark, sf_dir, runs.REFRESH).daily.read(spark))


_appending: dict[tuple[str, str], Warehouse] = {}


def _appended(spark, sf_dir):
    """The tables after a run that appends each batch's rollup, made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _appending:
        _appending[key] = _streamed_international(spark, sf_dir, runs.APPEND)
    return _appending[key]


@query(_LAYOVERS)
def stored_layovers(spark, sf_dir):
    """Layovers from the stored table, next to an append-only rollup."""
    return _appended(spark, sf_dir).layovers.read(spark).drop(*_VERSION)


@query(
    _INTERNATIONAL
    + """
SELECT depart_airport, arrival_airport, depart_date, is_layover,
  coalesce(airline, 'airline 여러개') AS airline, seat_class, fare_class, fetched_date,
  min(adult_fare // 1) IS NOT NULL AS priced, count(*) AS ticket_count
FROM flight JOIN fare USING (air_id) GROUP BY ALL"""
)
def appended_rollup(spark, sf_dir):
    """The append-only rollup: the batches' tickets of a group add up to all of them."""
    rows = _plain(_appended(spark, sf_dir).daily_by_batch(spark))
    group = [c for c in rows.columns if c not in ("mean_price", "median_price", "ticket_count", "batch_id")]
    return rows.groupBy(*group).agg(
        F.min("median_price").isNotNull().alias("priced"), F.sum("ticket_count").alias("ticket_count")
    )


@query(
    _INTERNATIONAL
    + """
SELECT 'international' AS feed, (SELECT count(DISTINCT l_orderkey) FROM zoned) AS records,
  CAST(0 AS BIGINT) AS bad, CAST(0 AS BIGINT) AS unkeyed,
  (SELECT count(DISTINCT l_orderkey) FROM zoned WHERE NOT known) AS dropped,
  (SELECT count(*) FROM flight) AS flight_info, (SELECT count(*) FROM fare) AS fare_info,
  (SELECT count(*) FROM hop WHERE legs > 1) AS layover_info"""
)
def batch_metrics(spark, sf_dir):
    """What was counted while the batches were written, over all batches."""
    seen = _appended(spark, sf_dir).batches(spark)
    counts = [c for c in seen.columns if c not in ("feed", "batch_id")]
    return seen.groupBy("feed").agg(*[F.sum(c).alias(c) for c in counts])
