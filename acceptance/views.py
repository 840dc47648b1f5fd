"""The test tables in the shapes that the operators take.

An order stands for an itinerary and a line item for a leg and a fare. Line items repeat, so
``leg`` keeps one per order and line number. An order has at most as many legs as there are line
numbers (seven), which bounds the arrays built here.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.operators.dedupe import newest
from feedmart.session import work_dir

# Time zones by region; the fifth region is left out, so its airports are unknown.
ZONES = {
    "AFRICA": "Africa/Nairobi",
    "AMERICA": "America/New_York",
    "ASIA": "Asia/Seoul",
    "EUROPE": "Europe/Paris",
}

LEG = """leg AS (
  SELECT * FROM (
    SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS p,
      row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
          CAST(round(l_extendedprice * 100) AS BIGINT) DESC) AS rn
    FROM lineitem)
  WHERE rn = 1)"""

ZONE = """zone AS (
  SELECT n_name, CASE r_name WHEN 'AFRICA' THEN 'Africa/Nairobi'
      WHEN 'AMERICA' THEN 'America/New_York' WHEN 'ASIA' THEN 'Asia/Seoul'
      WHEN 'EUROPE' THEN 'Europe/Paris' END AS tz
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'MIDDLE EAST')"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def instant(column: str) -> Column:
    return F.col(column).cast("timestamp")


def leg(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """One row per order and line number. ``by_order`` spreads the line items by order, so that what puts an
    order's legs together or joins them with it needs no further shuffle."""
    lines = table(spark, sf_dir, "lineitem").withColumn("p", cents("l_extendedprice"))
    lines = lines.repartition("l_orderkey") if by_order else lines
    order = ["l_shipdate", "l_partkey", "l_suppkey", "p"]
    return newest(lines, ["l_orderkey", "l_linenumber"], order, total=True)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation and the region of their customer."""
    orders, customer, nation, region = (
        table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")
    )
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations of four regions as airports."""
    from feedmart.functions.labels import label

    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("airport_code"), label(F.col("r_name"), ZONES).alias("time_zone"))
        .where("time_zone is not null")
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has line items: its itinerary id and its legs in order."""
    rows = leg(spark, sf_dir, by_order=True).select(
        "l_orderkey",
        F.struct(
            "l_linenumber",
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("leg_id"),
            *["l_partkey", "l_suppkey", "p", "l_quantity", "l_tax", "l_returnflag", "l_linestatus"],
            "l_shipdate",
        ).alias("leg"),
    )
    return (
        rows.groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list("leg")).alias("legs"))
        .withColumn("full_air_id", F.array_join(F.transform("legs", lambda x: x["leg_id"]), "+"))
    )


def itineraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trips`` in the columns of the itinerary operators."""

    def as_leg(line: Column, position: Column) -> Column:
        at = line["l_shipdate"].cast("timestamp")
        until = at + F.make_dt_interval(hours=line["l_quantity"].cast("int"))
        return F.struct(
            position.alias("ord"),
            line["l_returnflag"].alias("airline"),
            line["l_suppkey"].cast("string").alias("depart_airport"),
            line["l_partkey"].cast("string").alias("arrival_airport"),
            at.alias("depart_ts"),
            until.alias("arrival_ts"),
            at.alias("depart_local_ts"),
            until.alias("arrival_local_ts"),
            (line["l_quantity"] * 60).cast("int").alias("leg_time"),
            line["l_quantity"].cast("int").alias("connect_time"),
        )

    return trips(spark, sf_dir).select(
        "full_air_id",
        F.lit(None).cast("int").alias("journey_time"),
        F.transform("legs", as_leg).alias("legs"),
    )


# -- feeds written from the tables ---------------------------------------------------------------

_written: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The folder of a feed, written once per application into the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = work_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


#: Folders a task writes to at the same time; with more of them it sorts its remaining rows by folder.
OPEN_FOLDERS = 64
#: A compressed file is read by one task, so it must not grow without limit.
RECORDS_PER_FILE = 250_000


def as_json(df: DataFrame, path: str, prefix: str, *by: str, gzip: bool = False) -> None:
    """Write JSON files whose names start with ``prefix``, in one folder per value of ``by``.

    Rows go straight to the file of their folder: documents are wide, and sorting a task's documents by folder
    spilled several times what it wrote. ``gzip`` is for large feeds; their names repeat in every record."""
    writer = df.write.mode("append").option("mapreduce.output.basename", prefix)
    if gzip:
        options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": RECORDS_PER_FILE}
        writer = writer.options(**options)
    with _open_folders(df.sparkSession):
        (writer.partitionBy(*by) if by else writer).json(path)


@contextmanager
def _open_folders(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def events_feed(spark: SparkSession, sf_dir: str) -> str:
    def write(path):
        events = table(spark, sf_dir, "events")
        ts_us = F.unix_micros(instant("ts")).alias("ts_us")
        kept = ["event_id", "user_id", "event_type", "props"]
        as_json(events.select(*kept, ts_us), path, "events", "event_type")

    return written(spark, sf_dir, "events", write)


def domestic_feed(spark: SparkSession, sf_dir: str) -> str:
    """Domestic-shaped documents: one per order, with an economy and a business schedule."""

    def write(path):
        fares = (
            trips(spark, sf_dir)
            .select(
                F.col("l_orderkey").alias("o_orderkey"),
                F.transform(
                    "legs",
                    lambda x: F.struct(
                        F.concat(F.lit("A"), x["l_linenumber"]).alias("agtCode"),
                        x["p"].cast("int").alias("adultFare"),
                        F.round(x["l_tax"] * 100).cast("int").alias("aTax"),
                        x["l_quantity"].cast("int").alias("aFuel"),
                        x["l_linenumber"].alias("publishFee"),
                    ),
                ).alias("fare"),
            )
        )
        orders = places(spark, sf_dir).join(fares, "o_orderkey", "left")
        at = F.col("o_orderdate") + F.make_dt_interval(
            hours=F.lit(6), mins=(F.col("o_orderkey") % 600).cast("int")
        )
        until = at + F.make_dt_interval(mins=F.lit(90))

        def schedule(seat):
            return F.struct(
                F.concat(F.lit("A"), F.substring("o_orderpriority", 1, 1)).alias("airlineCode"),
                F.col("o_orderpriority").alias("airlineName"),
                F.concat(F.lit("F"), "o_orderkey").alias("fitName"),
                F.col("n_name").alias("depCity"),
                F.col("r_name").alias("arrCity"),
                F.date_format(at, "yyyyMMddHHmm").alias("departureDate"),
                F.date_format(until, "yyyyMMddHHmm").alias("arrivalDate"),
                seat.alias("seatClass"),
                F.lit("01:30").alias("journeyTime"),
                F.col("fare"),
            )

        seat = F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "D")
        docs = orders.select(
            F.date_trunc("year", "o_orderdate").cast("date").alias("day"),
            F.struct(
                F.struct(
                    F.array(schedule(F.coalesce(seat, F.lit("Z"))), schedule(F.lit("C"))).alias(
                        "departures"
                    )
                ).alias("domesticFlights")
            ).alias("data"),
        )
        as_json(docs, path, "domestic", "day", gzip=True)

    return written(spark, sf_dir, "domestic", write)


def repeat_feed(spark: SparkSession, sf_dir: str) -> str:
    """Domestic-shaped documents of two crawl days. The second one lists every third order's flight again,
    under another airline name, with a later arrival and other prices, and a fare without an agent. Airports
    are the nations of the customer and of another place, so both ends have zones or lack them."""

    def write(path):
        nation = table(spark, sf_dir, "nation")
        goal = nation.select(F.col("n_nationkey").alias("goal_key"), F.col("n_name").alias("goal"))
        orders = places(spark, sf_dir).withColumn("goal_key", (F.col("n_nationkey") + F.col("o_orderkey")) % 25).join(goal, "goal_key")
        number = F.col("o_orderkey")
        at = F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(6), mins=(number % 600).cast("int"))
        for day, late in (("2025-03-01", 0), ("2025-03-02", 1)):
            minutes = (F.lit(60) + number % 240 + 30 * late).cast("int")
            until = at + F.make_dt_interval(mins=minutes)

            def fare(agent, fee, late=late):
                return F.struct(
                    F.lit(agent).cast("string").alias("agtCode"),
                    cents("o_totalprice").cast("int").alias("adultFare"),
                    F.lit(100 * late).alias("aTax"),
                    (number % 7).cast("int").alias("aFuel"),
                    F.lit(fee).alias("publishFee"),
                )

            agents = [fare("A1", 1), fare("A2", 2)] + [fare(None, 3)] * late
            schedule = F.struct(
                F.lit("AA").alias("airlineCode"),
                F.concat(F.lit("Late " if late else ""), "o_orderpriority").alias("airlineName"),
                F.concat(F.lit("F"), number).alias("fitName"),
                F.col("n_name").alias("depCity"),
                F.col("goal").alias("arrCity"),
                F.date_format(at, "yyyyMMddHHmm").alias("departureDate"),
                F.date_format(until, "yyyyMMddHHmm").alias("arrivalDate"),
                F.lit("Y").alias("seatClass"),
                F.concat_ws(":", F.lpad((minutes / 60).cast("int"), 2, "0"), F.lpad(minutes % 60, 2, "0")).alias("journeyTime"),
                F.array(*agents).alias("fare"),
            )
            docs = orders.where(number % 3 == 0) if late else orders
            docs = docs.select(
                F.lit(day).alias("day"),
                F.struct(F.struct(F.array(schedule).alias("departures")).alias("domesticFlights")).alias("data"),
            )
            as_json(docs, path, f"domestic-{late}", "day", gzip=True)

    return written(spark, sf_dir, "repeats", write)


def international_feed(spark: SparkSession, sf_dir: str) -> str:
    """International-shaped documents: one per order that has line items. Orders with status F go
    to a folder for cabin Y, the others to one for cabin C."""

    def write(path):
        supplier = table(spark, sf_dir, "supplier")
        nation = table(spark, sf_dir, "nation")
        origins = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("sa")
        )
        goals = places(spark, sf_dir).select(
            F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderdate",
            F.col("n_name").alias("ea"),
        )
        rows = (
            leg(spark, sf_dir, by_order=True)
            .join(origins, "l_suppkey")
            .join(goals, "l_orderkey")
            .select(
                "l_orderkey",
                "o_orderstatus",
                "o_orderdate",
                F.struct(
                    *["l_linenumber", "sa", "ea", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity", "l_tax", "p"]
                ).alias("leg"),
            )
        )
        # the texts are made once the legs of an order are together: what is shuffled and sorted stays narrow
        orders = rows.groupBy("l_orderkey", "o_orderstatus", "o_orderdate").agg(
            F.array_sort(F.collect_list("leg")).alias("legs")
        )

        def detail(x):
            at = x["l_shipdate"] + F.make_dt_interval(hours=F.lit(6) + x["l_linenumber"])
            clock = F.lpad(x["l_quantity"].cast("int"), 2, "0")
            return F.struct(
                x["sa"].alias("sa"),
                x["ea"].alias("ea"),
                F.concat(F.lit("V"), x["l_returnflag"]).alias("av"),
                F.date_format(at, "yyyyMMddHHmm").alias("sdt"),
                F.date_format(at + F.make_dt_interval(hours=F.lit(2)), "yyyyMMddHHmm").alias("edt"),
                F.concat(F.lit("01"), clock).alias("ct"),
                F.concat(F.lit("02:"), clock).alias("jt"),
            )

        def fare(x):
            priceless = (x["l_returnflag"] == "R") & (x["l_linestatus"] == "F")
            rule = F.when(x["l_linestatus"] == "F", F.concat(F.lit("&FareRuleItnInfo=a/b/"), x["l_returnflag"]))
            return F.struct(
                F.struct(
                    F.when(priceless, "n/a").otherwise(x["p"].cast("string")).alias("Fare"),
                    F.lit("0").alias("NaverFare"),
                    F.round(x["l_tax"] * 100).cast("int").cast("string").alias("Tax"),
                    x["l_quantity"].cast("int").cast("string").alias("QCharge"),
                ).alias("Adult"),
                F.concat(F.lit("G"), x["l_linenumber"]).alias("AgtCode"),
                F.struct(F.concat(F.lit("http://f.example/r?k=1"), rule.otherwise("")).alias("#cdata-section")).alias(
                    "priceTransparencyUrl"
                ),
            )

        whole_id = F.array_join(F.transform("legs", lambda x: F.concat_ws("-", "l_orderkey", x["l_linenumber"])), "+")
        itinerary = F.struct(
            F.transform("legs", detail).alias("detail"),
            F.array(F.lpad(F.size("legs"), 2, "0"), F.lit("30")).alias("journeyTime"),
        )
        prices = F.transform("legs", fare)
        results = F.struct(
            F.create_map(
                *[F.lit(t) for t in ("VA", "Air%20A", "VN", "Air+N", "VR", "Air%20R")]
            ).alias("airlines"),
            F.create_map(
                F.lit("A01"), F.url_encode(F.lit("성인/모든 결제수단")), F.lit("A02"), F.lit("Card")
            ).alias("fareTypes"),
            F.array(F.create_map(whole_id, itinerary)).alias("schedules"),
            F.create_map(
                whole_id,
                F.struct(
                    F.create_map(F.lit("A01"), prices, F.lit("A02"), prices).alias("fare")
                ),
            ).alias("fares"),
        )
        docs = orders.select(
            F.date_trunc("year", "o_orderdate").cast("date").alias("day"),
            F.when(F.col("o_orderstatus") == "F", "_Y_").otherwise("_C_").alias("cabin"),
            F.struct(F.struct(results.alias("results")).alias("internationalList")).alias("data"),
        )
        as_json(docs, path, "trip", "day", "cabin", gzip=True)

    return written(spark, sf_dir, "international", write)
