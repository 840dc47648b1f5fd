"""Upserts, in batches and from a stream, and the rollup that follows them."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.views import LEG, ZONES, as_json, cents, places, table, written
from feedmart.functions.labels import label
from feedmart.operators.dedupe import newest, split_by_key
from feedmart.plans.warehouse import Warehouse
from feedmart.session import work_dir
from feedmart.session import written as landed
from feedmart.sources import feeds, schemas
from feedmart.sources.tables import KeyedTable, by_hash
from feedmart.streaming import ingest

SLOTS = 8


def _table(spark, name, ddl, keys, version=()):
    return KeyedTable(
        work_dir(spark, name), schemas.struct(ddl), tuple(keys), by_hash(keys, SLOTS), version
    )


@query(
    """
WITH updates AS (
  SELECT o_orderkey, o_custkey, 'done' AS status,
    CAST(round(o_totalprice * 100) AS BIGINT) + 100 AS cents
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT -o_orderkey - 1, o_custkey, 'new', CAST(round(o_totalprice * 100) AS BIGINT)
  FROM orders WHERE o_orderstatus = 'P')
SELECT * FROM updates
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT)
FROM orders WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.o_orderkey = orders.o_orderkey)"""
)
def upsert_single_key(spark, sf_dir):
    target = _table(
        spark, "orders", "o_orderkey bigint,o_custkey bigint,status string,cents bigint", ["o_orderkey"]
    )
    base = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), cents("o_totalprice").alias("cents")
    )
    target.upsert(base)
    done = base.where("status = 'F'").withColumns(
        {"status": F.lit("done"), "cents": F.col("cents") + 100}
    )
    new = base.where("status = 'P'").withColumns(
        {"status": F.lit("new"), "o_orderkey": -F.col("o_orderkey") - 1}
    )
    target.upsert(done.unionByName(new))
    return target.read(spark)


_LINE = "l_orderkey bigint,l_linenumber int,l_partkey bigint,l_suppkey bigint,p bigint,ship_us bigint"
_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = ["ship_us", "l_partkey", "l_suppkey", "p"]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        cents("l_extendedprice").alias("p"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship_us"),
        "l_linestatus",
        "l_returnflag",
    )


@query(
    """
WITH line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS p, epoch_us(l_shipdate) AS ship_us,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_linestatus DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
        CAST(round(l_extendedprice * 100) AS BIGINT) DESC) AS rn
  FROM lineitem)
SELECT * EXCLUDE (rn) FROM line WHERE rn = 1"""
)
def upsert_composite_key(spark, sf_dir):
    """Lines with status F first, then those with status O, which replace them."""
    target = _table(spark, "lines", _LINE, _LINE_KEYS)
    lines = _lines(spark, sf_dir)
    for status in ("F", "O"):
        target.upsert(lines.where(F.col("l_linestatus") == status), order=_LINE_ORDER)
    return target.read(spark)


@query(
    f"""
WITH {LEG}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p, epoch_us(l_shipdate) AS ship_us FROM leg"""
)
def stream_upsert(spark, sf_dir):
    """Line items from a stream of files. The newest version of a line stays, whichever file
    comes first."""

    def write(path):
        as_json(_lines(spark, sf_dir).drop("l_linestatus"), path, "lines", "l_returnflag", gzip=True)

    source = written(spark, sf_dir, "lines-feed", write)
    target = _table(spark, "streamed-lines", _LINE, _LINE_KEYS, tuple(_LINE_ORDER))
    stream = feeds.scan_stream(
        spark,
        source,
        schemas.struct(_LINE),
        files="lines-*.json.gz",
        max_files=4,
    )
    ingest.run_to_end(
        feeds.records(stream),
        target.hold,
        work_dir(spark, "stream-upsert-checkpoint"),
    )
    target.settle_held(spark)
    return target.read(spark)


_BACKFILL = """
WITH own AS (
  SELECT 'K' || o_orderkey AS air_id, o_orderkey, o_orderstatus, o_orderpriority, n_name, r_name, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey),
fare AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, max(CAST(round(l_extendedprice * 100) AS BIGINT)) AS p
  FROM lineitem GROUP BY ALL)
SELECT n_name AS depart_airport, r_name AS arrival_airport, strftime(o_orderdate, '%Y-%m-%d') AS depart_date,
  false AS is_layover, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE 'new' END AS airline,
  l_returnflag AS seat_class, 'n' AS fare_class, fetched_date,
  CAST(sum(p + late) // count(*) AS INTEGER) AS mean_price,
  CAST(quantile_disc(p + late, 0.5) AS INTEGER) AS median_price, count(*) AS ticket_count
FROM fare JOIN own ON l_orderkey = o_orderkey, (VALUES ('2025-02-28', 2), ('2025-02-27', 1)) AS d(fetched_date, late)
WHERE o_orderstatus <> 'P' OR fetched_date = '2025-02-27'
GROUP BY ALL"""


@query(_BACKFILL)
def backfill_order(spark, sf_dir):
    """Newer reports first: a crawl day after the day before it, and a day's second file before its
    first. The airline of the newer day and the prices of the second file stay."""
    daily = _backfilled(spark, sf_dir).daily.read(spark)
    return daily.withColumns({c: F.col(c).cast("string") for c in ("depart_date", "fetched_date")})


def _backfilled(spark, sf_dir):
    warehouse = Warehouse(work_dir(spark, "backfill"), slots=SLOTS)
    orders = places(spark, sf_dir)
    day = F.col("o_orderdate").cast("timestamp")
    prices = _lines(spark, sf_dir).groupBy("l_orderkey", "l_linenumber", "l_returnflag").agg(F.max("p").alias("p"))
    prices = landed(prices, work_dir(spark, "backfill-prices"))  # all three batches read them
    for crawl, file, kept in (("2025-02-28", 2, "P"), ("2025-02-28", 1, "P"), ("2025-02-27", 1, "")):
        known = orders.where(F.col("o_orderstatus") != kept)
        version = [F.lit(crawl).cast("date").alias("fetched_date"), F.lit(f"file-{file}").alias("file_path")]
        newer = F.lit("new") if file == 2 else F.lit("old") if kept else F.col("o_orderpriority")
        air_id = F.concat(F.lit("K"), "o_orderkey").alias("air_id")
        flights = known.select(
            air_id,
            newer.alias("airline"),
            F.col("n_name").alias("depart_airport"),
            day.alias("depart_timestamp"),
            F.col("r_name").alias("arrival_airport"),
            day.alias("arrival_timestamp"),
            F.lit(0).alias("journey_time"),
            F.lit(False).alias("is_layover"),
            F.to_date(day).alias("depart_date"),
            F.lit(True).alias("listed"),
            *version,
        )
        fares = prices.join(known, F.col("l_orderkey") == F.col("o_orderkey")).select(
            air_id,
            F.col("l_returnflag").alias("seat_class"),
            F.col("l_linenumber").cast("string").alias("agt_code"),
            (F.col("p") + file).cast("int").alias("adult_fare"),
            F.lit("n").alias("fare_class"),
            *version,
        )
        warehouse.absorb({"flight_info": flights, "fare_info": fares})
    return warehouse


@query(
    """
WITH fare AS (
  SELECT CASE WHEN l_quantity > 45 THEN NULL ELSE l_orderkey END AS o, CASE WHEN l_returnflag = 'A' THEN NULL
      ELSE l_linenumber END AS agent, l_linestatus AS day, CAST(round(l_extendedprice * 100) AS BIGINT) AS p
  FROM lineitem)
SELECT true AS kept, o, agent, day, max(p) AS p, '' AS lacks FROM fare
WHERE o IS NOT NULL AND agent IS NOT NULL GROUP BY o, agent, day
UNION ALL
SELECT false, o, agent, day, p, concat_ws('+', CASE WHEN o IS NULL THEN 'o' END, CASE WHEN agent IS NULL THEN 'agent' END)
FROM fare WHERE o IS NULL OR agent IS NULL"""
)
def null_keys_kept(spark, sf_dir):
    """Line items as fares: one per whole key, and every one that lacks a part of its key."""
    line = table(spark, sf_dir, "lineitem")
    rows = line.select(
        F.when(F.col("l_quantity") <= 45, F.col("l_orderkey")).alias("o"),
        F.when(F.col("l_returnflag") != "A", F.col("l_linenumber")).alias("agent"),
        F.col("l_linestatus").alias("day"),
        cents("l_extendedprice").alias("p"),
    )
    keys = ["o", "agent", "day"]
    keyed, keyless = split_by_key(rows, keys)
    one = newest(keyed, keys, ["p"]).withColumn("lacks", F.lit(""))
    both = one.withColumn("kept", F.lit(True)).unionByName(
        keyless.withColumns({"lacks": F.array_join("lacks", "+"), "kept": F.lit(False)})
    )
    return both.select("kept", *keys, "p", "lacks")


@query(
    """
WITH fare AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, max(CAST(round(l_extendedprice * 100) AS BIGINT)) AS p
  FROM lineitem GROUP BY ALL)
SELECT n_name AS depart_airport, r_name AS arrival_airport, strftime(o_orderdate, '%Y-%m-%d') AS depart_date,
  false AS is_layover, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE 'new' END AS airline,
  l_returnflag AS seat_class, 'n' AS fare_class, fetched_date, CAST(p + late AS INTEGER) AS adult_fare, count(*) AS n
FROM fare JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey,
  (VALUES ('2025-02-28', 2), ('2025-02-27', 1)) AS d(fetched_date, late)
WHERE o_orderstatus <> 'P' OR fetched_date = '2025-02-27'
GROUP BY ALL"""
)
def price_counts(spark, sf_dir):
    """The rollup's state after the batches of ``backfill_order``: signed changes of three batches, with
    flights that move and prices that an older file must not bring back."""
    counts = _backfilled(spark, sf_dir).counts.read(spark)
    return counts.withColumns({c: F.col(c).cast("string") for c in ("depart_date", "fetched_date")})


@query(
    """
SELECT s_name AS airport_code, CASE WHEN s_acctbal < 0 THEN 'Mars/Base' WHEN s_suppkey % 3 = 0 THEN NULL
    WHEN s_suppkey % 7 = 0 THEN 'Not a zone' ELSE 'Asia/Seoul' END AS time_zone, false AS again,
  NOT (s_acctbal < 0 OR (s_suppkey % 3 <> 0 AND s_suppkey % 7 = 0)) AS stored FROM supplier
UNION ALL
SELECT NULL, 'UTC', true, false FROM supplier WHERE s_acctbal < 0"""
)
def airport_zone_check(spark, sf_dir):
    """Suppliers as airports: those with an impossible zone, or without a code, go to the rejects."""
    root = work_dir(spark, "zones")
    warehouse = Warehouse(root)
    supplier = table(spark, sf_dir, "supplier")
    debt, number = F.col("s_acctbal") < 0, F.col("s_suppkey")
    zone = (
        F.when(debt, "Mars/Base").when(number % 3 == 0, None).when(number % 7 == 0, "Not a zone").otherwise("Asia/Seoul")
    )
    rows = supplier.select(
        F.col("s_name").alias("airport_code"), F.lit("a").alias("name"), F.lit("b").alias("country"), zone.alias("time_zone")
    )
    codeless = supplier.where(debt).select(
        F.lit(None).cast("string").alias("airport_code"), F.lit("a").alias("name"), F.lit("b").alias("country"),
        F.lit("UTC").alias("time_zone"),
    )
    warehouse.load_airports(rows.unionByName(codeless), f"{root}/rejects")
    rejects = spark.read.schema("airport_code string, time_zone string, why string").json(f"{root}/rejects")
    stored = warehouse.airports.read(spark).select("airport_code", "time_zone", F.lit(False).alias("again"), F.lit(True).alias("stored"))
    return stored.unionByName(
        rejects.select("airport_code", "time_zone", (F.col("why") == "no code").alias("again"), F.lit(False).alias("stored"))
    )


@query(
    """
SELECT s_name AS airport_code, n_name AS name, r_name AS country,
  CASE WHEN s_acctbal < 0 THEN 'UTC' ELSE CASE r_name WHEN 'AFRICA' THEN 'Africa/Nairobi'
      WHEN 'AMERICA' THEN 'America/New_York' WHEN 'ASIA' THEN 'Asia/Seoul'
      WHEN 'EUROPE' THEN 'Europe/Paris' END END AS time_zone
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def upsert_dimension(spark, sf_dir):
    """Suppliers as airports; those in debt get another zone in a second step."""
    airports = Warehouse(work_dir(spark, "dimension")).airports
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_name").alias("airport_code"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("country"),
            label(F.col("r_name"), ZONES).alias("time_zone"),
            "s_acctbal",
        )
    )
    airports.upsert(rows)
    airports.upsert(rows.where("s_acctbal < 0").withColumn("time_zone", F.lit("UTC")))
    return airports.read(spark)


@query(
    """
WITH fare AS (
  SELECT * FROM (
    SELECT l_orderkey, l_returnflag AS seat_class, l_linenumber,
      date_trunc('year', l_shipdate) AS fetched, CAST(round(l_extendedprice * 100) AS BIGINT) AS p,
      row_number() OVER (
        PARTITION BY l_orderkey, l_returnflag, l_linenumber, date_trunc('year', l_shipdate)
        ORDER BY l_linestatus DESC, CAST(round(l_extendedprice * 100) AS BIGINT) DESC) AS rn
    FROM lineitem)
  WHERE rn = 1)
SELECT n_name AS depart_airport, r_name AS arrival_airport,
  strftime(o_orderdate, '%Y-%m-%d') AS depart_date, false AS is_layover,
  CASE WHEN o_orderstatus = 'P' THEN 'moved' ELSE o_orderpriority END AS airline, seat_class,
  'n' AS fare_class, strftime(fetched, '%Y-%m-%d') AS fetched_date,
  CAST(sum(p) // count(p) AS INTEGER) AS mean_price,
  CAST(quantile_disc(p, 0.5) AS INTEGER) AS median_price, count(*) AS ticket_count
FROM fare JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL"""
)
def rollup_refresh(spark, sf_dir):
    """Two batches of facts: the second one changes prices, and moves flights to other groups."""
    warehouse = Warehouse(work_dir(spark, "warehouse"), slots=SLOTS)
    orders = places(spark, sf_dir)
    day = F.col("o_orderdate").cast("timestamp")
    fares = (
        _lines(spark, sf_dir)
        .select(
            F.concat(F.lit("K"), "l_orderkey").alias("air_id"),
            F.col("l_returnflag").alias("seat_class"),
            F.col("l_linenumber").cast("string").alias("agt_code"),
            F.col("p").cast("int").alias("adult_fare"),
            F.date_trunc("year", F.timestamp_micros("ship_us")).cast("date").alias("fetched_date"),
            F.lit("n").alias("fare_class"),
            "l_linestatus",
        )
    )
    moved = F.when(F.col("o_orderstatus") == "P", "moved").otherwise(F.col("o_orderpriority"))
    for status, airline in (("F", F.col("o_orderpriority")), ("O", moved)):
        flights = orders.select(
            F.concat(F.lit("K"), "o_orderkey").alias("air_id"),
            airline.alias("airline"),
            F.col("n_name").alias("depart_airport"),
            day.alias("depart_timestamp"),
            F.col("r_name").alias("arrival_airport"),
            day.alias("arrival_timestamp"),
            F.lit(0).alias("journey_time"),
            F.lit(False).alias("is_layover"),
            F.to_date(day).alias("depart_date"),
            F.lit("2025-01-01").cast("date").alias("fetched_date"),
            F.lit(True).alias("listed"),
            F.lit(status).alias("file_path"),
        )
        batch = fares.where(F.col("l_linestatus") == status).drop("l_linestatus")
        single = batch.groupBy(*[c for c in batch.columns if c != "adult_fare"]).agg(
            F.max("adult_fare").alias("adult_fare"), F.lit(status).alias("file_path")
        )
        warehouse.absorb({"flight_info": flights, "fare_info": single})
    daily = warehouse.daily.read(spark)
    return daily.withColumns({c: F.col(c).cast("string") for c in ("depart_date", "fetched_date")})
