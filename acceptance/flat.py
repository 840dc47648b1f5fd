"""Columns, joins and aggregates over the flat tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.views import LEG, cents, instant, itineraries, leg, places, table, trips
from feedmart.functions import keys, labels, money, times
from feedmart.operators import dedupe, itinerary, rollup
from feedmart.operators.lookup import both_ends, lookup
from feedmart.session import work_dir
from feedmart.sources.colocated import bucketed

_SALES = """
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""


@query(
    f"""
WITH sale AS (
  SELECT n_name AS depart_airport, r_name AS arrival_airport,
    strftime(o_orderdate, '%Y-%m-%d') AS depart_date, o_orderstatus = 'P' AS is_layover,
    coalesce(nullif(o_orderpriority, '5-LOW'), 'airline 여러개') AS airline,
    l_returnflag AS seat_class, l_linestatus AS fare_class,
    strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS fetched_date,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS p
  {_SALES})
SELECT depart_airport, arrival_airport, depart_date, is_layover, airline, seat_class, fare_class,
  fetched_date, CAST(sum(p) // count(p) AS INTEGER) AS mean_price,
  CAST(quantile_disc(p, 0.5) AS INTEGER) AS median_price, count(*) AS ticket_count
FROM sale GROUP BY ALL"""
)
def daily_rollup(spark, sf_dir):
    flights = places(spark, sf_dir).select(
        F.col("o_orderkey").alias("air_id"),
        F.col("n_name").alias("depart_airport"),
        F.col("r_name").alias("arrival_airport"),
        F.to_date("o_orderdate").alias("depart_date"),
        (F.col("o_orderstatus") == "P").alias("is_layover"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("airline"),
    )
    fares = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("air_id"),
        F.col("l_returnflag").alias("seat_class"),
        F.col("l_linestatus").alias("fare_class"),
        F.date_trunc("year", "l_shipdate").cast("date").alias("fetched_date"),
        cents("l_extendedprice").alias("adult_fare"),
    )
    daily = rollup.daily_rollup(flights, fares)
    return daily.withColumns({c: F.col(c).cast("string") for c in ("depart_date", "fetched_date")})


def _priced_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("p", cents("l_extendedprice"))


@query(
    """
SELECT l_returnflag, l_linestatus,
  CAST(trunc(avg(CAST(round(l_extendedprice * 100) AS BIGINT))) AS BIGINT) AS mean_price,
  count(*) AS ticket_count
FROM lineitem GROUP BY ALL"""
)
def mean_trunc(spark, sf_dir):
    return rollup.price_means(_priced_lines(spark, sf_dir), ["l_returnflag", "l_linestatus"], "p")


@query(
    """
SELECT l_returnflag, l_linestatus,
  CAST(quantile_disc(CAST(round(l_extendedprice * 100) AS BIGINT), 0.5) AS BIGINT) AS median_price
FROM lineitem GROUP BY ALL"""
)
def median_lower(spark, sf_dir):
    return rollup.price_medians(_priced_lines(spark, sf_dir), ["l_returnflag", "l_linestatus"], "p")


@query(
    f"""
WITH {LEG}
SELECT o_orderkey, o_orderstatus, l_linenumber, p FROM orders JOIN leg ON o_orderkey = l_orderkey"""
)
def fact_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.join(leg(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_orderstatus", "l_linenumber", "p"
    )


@query(
    """
SELECT o_orderpriority, l_returnflag, l_linenumber, count(*) AS n,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS p
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL"""
)
def colocated_join(spark, sf_dir):
    """Orders and line items bucketed by order: the join below the counts reads bucket by bucket."""
    folder, name = work_dir(spark, "colocated"), f"c{uuid.uuid4().hex[:8]}"
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), "l_returnflag", "l_linenumber", cents("l_extendedprice").alias("p")
    )
    sides = [
        bucketed(df, f"{name}_{side}", f"{folder}/{side}", "k", 8) for side, df in (("orders", orders), ("lines", lines))
    ]
    joined = sides[0].hint("merge").join(sides[1], "k")
    return joined.groupBy("o_orderpriority", "l_returnflag", "l_linenumber").agg(
        F.count("*").alias("n"), F.sum("p").alias("p")
    )


_TRIP = f"""
WITH {LEG}, trip AS (
  SELECT string_agg(l_orderkey || '-' || l_linenumber, '+' ORDER BY l_linenumber) AS air_id,
    CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS airline,
    epoch_us(min(l_shipdate)) AS depart_us,
    epoch_us(max(l_shipdate + to_hours(CAST(l_quantity AS INTEGER)))) AS arrival_us,
    count(*) > 1 AS is_layover,
    CAST(arg_min(l_suppkey, l_linenumber) AS VARCHAR) AS depart_airport,
    CAST(arg_max(l_partkey, l_linenumber) AS VARCHAR) AS arrival_airport,
    epoch_us(arg_min(l_shipdate, l_linenumber)) AS depart_local_us,
    epoch_us(arg_max(l_shipdate + to_hours(CAST(l_quantity AS INTEGER)), l_linenumber))
      AS arrival_local_us
  FROM leg GROUP BY l_orderkey)"""


@query(_TRIP + "SELECT air_id, airline, depart_us, arrival_us, is_layover FROM trip")
def itinerary_summary(spark, sf_dir):
    return itinerary.flights(itineraries(spark, sf_dir)).where("listed").select(
        "air_id",
        "airline",
        F.unix_micros("depart_timestamp").alias("depart_us"),
        F.unix_micros("arrival_timestamp").alias("arrival_us"),
        "is_layover",
    )


@query(
    _TRIP
    + "SELECT air_id, depart_airport, arrival_airport, depart_local_us, arrival_local_us FROM trip"
)
def itinerary_endpoints(spark, sf_dir):
    return itinerary.flights(itineraries(spark, sf_dir)).where("listed").select(
        "air_id",
        "depart_airport",
        "arrival_airport",
        F.unix_micros("depart_local_ts").alias("depart_local_us"),
        F.unix_micros("arrival_local_ts").alias("arrival_local_us"),
    )


@query(
    """
SELECT l_orderkey,
  CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS only_flag,
  CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS only_supplier
FROM lineitem GROUP BY l_orderkey"""
)
def unify_or_null(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            itinerary.only_value("l_returnflag").alias("only_flag"),
            itinerary.only_value("l_suppkey").alias("only_supplier"),
        )
    )


@query(
    f"""
WITH {LEG}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p, epoch_us(l_shipdate) AS ship_us FROM leg"""
)
def dedupe_latest(spark, sf_dir):
    return leg(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "p",
        F.unix_micros(instant("l_shipdate")).alias("ship_us"),
    )


@query("SELECT o_orderkey AS key FROM orders UNION SELECT l_orderkey FROM lineitem")
def valid_key_set(spark, sf_dir):
    return dedupe.valid_keys(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key")),
        table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key")),
    )


@query(
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def semi_valid_keys(spark, sf_dir):
    valid = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dedupe.having_key(orders, valid, "o_orderkey")


@query(
    """
WITH near AS (
  SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name IN ('ASIA', 'EUROPE'))
SELECT l_orderkey, l_linenumber, s_nationkey, c_nationkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
WHERE s_nationkey IN (SELECT n_nationkey FROM near)
  AND c_nationkey IN (SELECT n_nationkey FROM near)"""
)
def both_ends_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    supplier = table(spark, sf_dir, "supplier")
    near = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").where(F.col("r_name").isin("ASIA", "EUROPE")),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    routes = (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("l_orderkey", "l_linenumber", "s_nationkey", "c_nationkey")
    )
    return both_ends(routes, near, "n_nationkey", "s_nationkey", "c_nationkey")


def _zoned_events(spark, sf_dir):
    zones = {"click": "Asia/Seoul", "view": "America/New_York", "purchase": "Europe/Paris"}
    events = table(spark, sf_dir, "events")
    dim = (
        events.select(F.col("event_type").alias("code"))
        .distinct()
        .withColumn("zone", labels.label(F.col("code"), zones))
        .where("zone is not null")
    )
    return lookup(
        events, dim, "event_type", "code", {"zone": "zone"}, {"zone": F.lit("UTC")}, "zone_known"
    )


_ZONED = """
WITH zoned AS (
  SELECT *, CASE event_type WHEN 'click' THEN 'Asia/Seoul' WHEN 'view' THEN 'America/New_York'
    WHEN 'purchase' THEN 'Europe/Paris' END AS found
  FROM events)"""


@query(
    _ZONED
    + """
SELECT event_id, event_type, coalesce(found, 'UTC') AS zone, found IS NOT NULL AS zone_known
FROM zoned"""
)
def lookup_default(spark, sf_dir):
    return _zoned_events(spark, sf_dir).select("event_id", "event_type", "zone", "zone_known")


@query(
    _ZONED
    + """
SELECT event_id, epoch_us(timezone(coalesce(found, 'UTC'), ts)) AS utc_us FROM zoned"""
)
def local_to_utc(spark, sf_dir):
    local = instant("ts")
    return _zoned_events(spark, sf_dir).select(
        "event_id", F.unix_micros(times.to_utc(local, "zone")).alias("utc_us")
    )


@query(
    """
SELECT o_orderkey, o_orderstatus,
  CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END AS label
FROM orders"""
)
def code_label_map(spark, sf_dir):
    names = {"F": "done", "O": "open"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", labels.label(F.col("o_orderstatus"), names).alias("label")
    )


@query(
    """
SELECT event_id,
  CASE WHEN event_type <> 'error' THEN epoch_us(date_trunc('minute', ts)) END AS minute_us
FROM events"""
)
def parse_local_time(spark, sf_dir):
    text = F.concat(
        F.when(F.col("event_type") == "error", "about ").otherwise(""),
        F.date_format("ts", "yyyyMMddHHmm"),
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(times.local_time(text).cast("timestamp")).alias("minute_us")
    )


@query(
    """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) + 60 * l_linenumber AS with_colon,
  CAST(l_quantity AS INTEGER) + 60 * l_linenumber AS without_colon,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) + 60 * l_linenumber END AS pair,
  CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INTEGER) + 60 * l_linenumber END AS either
FROM lineitem"""
)
def duration_minutes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    hours = F.lpad("l_linenumber", 2, "0")
    mins = F.lpad(F.col("l_quantity").cast("int"), 2, "0")
    pair = F.when(F.col("l_linestatus") == "F", F.array(hours, mins)).otherwise(F.array(hours))
    either = F.when(F.col("l_returnflag") == "A", F.concat(hours, F.lit(":"), mins)).when(
        F.col("l_returnflag") == "R", F.concat(hours, mins)
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        times.minutes_hh_mm(F.concat(hours, F.lit(":"), mins)).alias("with_colon"),
        times.minutes_hhmm(F.concat(hours, mins)).alias("without_colon"),
        times.minutes_pair(pair).alias("pair"),
        times.minutes_any(F.coalesce(either, F.lit("long"))).alias("either"),
    )


@query(
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || o_custkey || o_orderstatus
  || nullif(o_orderpriority, '5-LOW') AS air_id
FROM orders"""
)
def composite_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        keys.composite_key(
            F.date_format("o_orderdate", "yyyyMMdd"),
            "o_custkey",
            "o_orderstatus",
            F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
        ).alias("air_id"),
    )


@query(
    f"""
WITH {LEG}, trip AS (
  SELECT string_agg(l_orderkey || '-' || l_linenumber, '+' ORDER BY l_linenumber) AS full_air_id
  FROM leg GROUP BY l_orderkey),
part AS (
  SELECT full_air_id, unnest(string_split(full_air_id, '+')) AS segment_id,
    generate_subscripts(string_split(full_air_id, '+'), 1) AS n
  FROM trip WHERE contains(full_air_id, '+'))
SELECT full_air_id, CAST(n - 1 AS INTEGER) AS ord, segment_id FROM part"""
)
def explode_composite_key(spark, sf_dir):
    return (
        trips(spark, sf_dir)
        .where(keys.is_connection("full_air_id"))
        .select("full_air_id", F.explode(F.sequence(F.lit(0), F.size("legs") - 1)).alias("ord"))
        .select("full_air_id", "ord", keys.leg_id("full_air_id", "ord").alias("segment_id"))
    )


@query(
    r"""
WITH link AS (SELECT page_id, regexp_extract(url, '://([^?#]*)', 1) AS place, url FROM pages)
SELECT page_id,
  CASE WHEN len(string_split(place, '/')) >= 3 THEN string_split(place, '/')[3] ELSE 'n' END
    AS third,
  coalesce(nullif(regexp_extract(url, 'utm_source=([^&]+)', 1), ''), 'n') AS source
FROM link"""
)
def url_param_part(spark, sf_dir):
    place = F.regexp_extract("url", "://([^?#]*)", 1)
    rule = F.concat(F.lit("http://f.example/?FareRuleItnInfo="), place, F.lit("&k=1"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        keys.url_param_part(rule).alias("third"),
        keys.url_param_part("url", "utm_source", 0).alias("source"),
    )


@query(
    """
SELECT p_partkey, p_name AS name, CASE WHEN p_type <> 'SMALL' THEN p_name END AS name_or_null
FROM part"""
)
def url_decode_label(spark, sf_dir):
    encoded = F.url_encode("p_name")
    broken = F.when(F.col("p_type") == "SMALL", F.concat(encoded, F.lit("%z"))).otherwise(encoded)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        labels.decoded(encoded).alias("name"),
        labels.decoded(broken).alias("name_or_null"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'N' THEN CAST(round(l_extendedprice * 100) AS INTEGER)
    + CAST(round(l_tax * 100) AS INTEGER) + CAST(l_quantity AS INTEGER) + l_linenumber END AS total
FROM lineitem"""
)
def try_cast_sum(spark, sf_dir):
    price = F.when(F.col("l_returnflag") == "N", "n/a").otherwise(
        cents("l_extendedprice").cast("string")
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        money.total(
            price,
            cents("l_tax").cast("string"),
            F.col("l_quantity").cast("int").cast("string"),
            F.col("l_linenumber"),
        ).alias("total"),
    )


@query(
    _TRIP
    + """
SELECT air_id, airline, depart_airport, arrival_airport, is_layover FROM trip
UNION ALL
SELECT l_orderkey || '-' || l_linenumber, l_returnflag, CAST(l_suppkey AS VARCHAR),
  CAST(l_partkey AS VARCHAR), false
FROM leg WHERE l_orderkey IN (SELECT l_orderkey FROM leg GROUP BY l_orderkey HAVING count(*) > 1)"""
)
def union_itineraries_legs(spark, sf_dir):
    return itinerary.flights(itineraries(spark, sf_dir)).select(
        "air_id", "airline", "depart_airport", "arrival_airport", "is_layover"
    )


@query(
    f"""
WITH {LEG}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS n,
    count(*) OVER (PARTITION BY l_orderkey) AS legs,
    string_agg(l_orderkey || '-' || l_linenumber, '+') OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS air_id
  FROM leg)
SELECT air_id, l_orderkey || '-' || l_linenumber AS segment_id, CAST(n AS INTEGER) AS layover_order,
  CAST(l_quantity AS INTEGER) AS connect_time
FROM placed WHERE legs > 1"""
)
def layovers(spark, sf_dir):
    return itinerary.layovers(itineraries(spark, sf_dir))
