"""Daily price rollup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmart.functions import labels

ROLLUP_KEYS = [
    "depart_airport",
    "arrival_airport",
    "depart_date",
    "is_layover",
    "airline",
    "seat_class",
    "fare_class",
    "fetched_date",
]


def price_stats(df: DataFrame, keys: Sequence[str], price: str = "adult_fare") -> DataFrame:
    """Exact ``mean_price`` (truncated), ``median_price`` (lower) and ``ticket_count`` per group.

    Rows are first counted per group and price. That step combines map-side and shuffles by group
    *and* price, so the rows of a large group spread over all tasks, and what reaches the group's
    own task is one narrow row per distinct price. The median is the price at which the running
    count reaches half. Rows without a price count as tickets and do not enter mean or median.
    """
    prices = df.groupBy(*keys, F.col(price).cast("bigint").alias("__price")).agg(
        F.count("*").alias("__n")
    )
    return stats_of_counts(prices, keys, "__price", "__n")


def stats_of_counts(counts: DataFrame, keys: Sequence[str], price: str, n: str) -> DataFrame:
    """The same from rows that are counted per group and price already."""
    prices = counts.select(*keys, F.col(price).cast("bigint").alias("__price"), F.col(n).alias("__n"))
    # Both frames share one order, so that one sort and one window serve them. The hash comes first
    # because the sort mostly decides by the leading column.
    by_price = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(F.col("__price").asc_nulls_last())
    group = by_price.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = by_price.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    priced = F.when(F.col("__price").isNull(), 0).otherwise(F.col("__n"))
    ranked = prices.select(
        *keys,
        "__price",
        priced.alias("__priced"),
        F.sum("__n").over(group).alias("ticket_count"),
        F.sum(priced).over(group).alias("__all_priced"),
        F.sum(F.col("__price") * F.col("__n")).over(group).alias("__sum"),
        F.sum(priced).over(so_far).alias("__reached"),
    )
    median_row = (
        (F.col("__reached") * 2 >= F.col("__all_priced"))
        & ((F.col("__reached") - F.col("__priced")) * 2 < F.col("__all_priced"))
        & F.col("__price").isNotNull()
    )
    return ranked.where(median_row | (F.col("__all_priced") == 0)).select(
        *keys,
        F.expr("__sum div nullif(__all_priced, 0)").alias("mean_price"),
        F.col("__price").alias("median_price"),
        "ticket_count",
    )


def price_means(df: DataFrame, keys: Sequence[str], price: str = "adult_fare") -> DataFrame:
    """``mean_price`` (truncated) and ``ticket_count`` per group, from partial sums in one shuffle."""
    amount = F.col(price).cast("bigint")
    sums = df.groupBy(*keys).agg(
        F.sum(amount).alias("__sum"), F.count(amount).alias("__priced"), F.count("*").alias("ticket_count")
    )
    return sums.select(*keys, F.expr("__sum div nullif(__priced, 0)").alias("mean_price"), "ticket_count")


def price_medians(
    df: DataFrame, keys: Sequence[str], price: str = "adult_fare", range_bits: int = 12
) -> DataFrame:
    """Exact lower ``median_price`` of each group that has a price, for few groups with many prices.

    Two levels: the range of 2 ** ``range_bits`` prices in which the running count reaches half, then
    the price within it. No task sees more of a group than its ranges or the prices of one range.
    """
    prices = (
        df.where(F.col(price).isNotNull())
        .groupBy(F.struct(*keys).alias("__group"), F.col(price).cast("bigint").alias("__price"))
        .agg(F.count("*").alias("__n"))
        .withColumn("__range", F.shiftright("__price", range_bits))
    )
    ranges = prices.groupBy("__group", "__range").agg(F.sum("__n").alias("__in_range"))
    by_range = Window.partitionBy("__group").orderBy("__range")
    upto = F.sum("__in_range").over(by_range.rowsBetween(Window.unboundedPreceding, 0))
    every = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reached = ranges.withColumns(
        {"__before": upto - F.col("__in_range"), "__all": F.sum("__in_range").over(every)}
    ).where(
        ((F.col("__before") + F.col("__in_range")) * 2 >= F.col("__all"))
        & (F.col("__before") * 2 < F.col("__all"))
    )
    inside = prices.join(reached, ["__group", "__range"])
    by_price = Window.partitionBy("__group", "__range").orderBy("__price")
    so_far = F.col("__before") + F.sum("__n").over(by_price.rowsBetween(Window.unboundedPreceding, 0))
    return (
        inside.withColumn("__reached", so_far)
        .where(
            (F.col("__reached") * 2 >= F.col("__all"))
            & ((F.col("__reached") - F.col("__n")) * 2 < F.col("__all"))
        )
        .select("__group.*", F.col("__price").alias("median_price"))
    )


def price_stats_sketch(
    df: DataFrame, keys: Sequence[str], price: str = "adult_fare", accuracy: int = 1_000_000
) -> DataFrame:
    """As ``price_stats``, with a quantile sketch: one shuffle, and a median that is exact up to
    about ``accuracy`` rows per group and within ``1 / accuracy`` of the rank beyond."""
    amount = F.col(price).cast("bigint")
    return df.groupBy(*keys).agg(
        F.try_divide(F.sum(amount), F.count(amount)).cast("bigint").alias("mean_price"),
        F.percentile_approx(amount, 0.5, accuracy).alias("median_price"),
        F.count("*").alias("ticket_count"),
    )


FLIGHT_KEYS = ROLLUP_KEYS[:5]


def flight_groups(flights: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Each flight's part of the rollup key."""
    return flights.select(
        "air_id",
        *[labels.airline_label(F.col(k)).alias(k) if k == "airline" else k for k in FLIGHT_KEYS],
        *carry,
    )


def priced_flights(groups: DataFrame, fares: DataFrame) -> DataFrame:
    """Fares with the whole rollup key. Both sides must be unique by their own keys."""
    return groups.join(fares, "air_id").select(*ROLLUP_KEYS, "adult_fare")


def by_group(priced: DataFrame, exact: bool = True) -> DataFrame:
    return _as_rollup((price_stats if exact else price_stats_sketch)(priced, ROLLUP_KEYS))


def of_counts(counts: DataFrame) -> DataFrame:
    """The rollup of a table of price counts (rollup keys, adult_fare, n)."""
    return _as_rollup(stats_of_counts(counts, ROLLUP_KEYS, "adult_fare", "n"))


def _as_rollup(stats: DataFrame) -> DataFrame:
    return stats.select(
        *ROLLUP_KEYS,
        F.col("mean_price").cast("int").alias("mean_price"),
        F.col("median_price").cast("int").alias("median_price"),
        "ticket_count",
    )


def count_changes(fares: DataFrame, moved_fares: DataFrame | None = None) -> DataFrame:
    """Signed changes of the price counts: (rollup keys, adult_fare, n), n never 0.

    ``fares`` are fares with their flight's group: ``was`` and ``was_price`` (null if they did not count
    before), ``now`` and ``adult_fare``. ``moved_fares`` are further fares whose flight went from ``was`` to
    ``now`` and whose price stays. A fare that stays as it is adds nothing.
    """
    rest = ["seat_class", "fare_class", "fetched_date"]
    if moved_fares is not None:
        one = F.struct(F.col("adult_fare").alias("price"))
        fares = fares.unionByName(moved_fares.withColumn("was_price", one))
    gone = F.struct("was", F.col("was_price.price").alias("price"), F.lit(-1).alias("n"))
    come = F.struct(F.col("now").alias("was"), F.col("adult_fare").alias("price"), F.lit(1).alias("n"))
    counted = F.col("was").isNotNull() & F.col("was_price").isNotNull()
    both = F.when(counted, F.array(gone, come)).otherwise(F.array(come))
    rows = fares.select(*rest, F.inline(both)).select("was.*", *rest, F.col("price").alias("adult_fare"), "n")
    return rows.groupBy(*ROLLUP_KEYS, "adult_fare").agg(F.sum("n").alias("n")).where("n <> 0")


def daily_rollup(flights: DataFrame, fares: DataFrame, exact: bool = True) -> DataFrame:
    """Mean, median and count of fares by route, day, kind, airline, class and crawl day.

    ``flights`` has ``air_id`` as its key and a local ``depart_date``.
    """
    return by_group(priced_flights(flight_groups(flights), fares), exact)
