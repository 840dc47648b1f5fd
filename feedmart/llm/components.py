"""Connected components of a link table by alternating large and small stars.

Every turn is a minimum per node (partial minima in the tasks first) and a join with the links, and is
written to the shared folder, so no lineage grows and a lost executor repeats one turn at most. Nothing
is collected but a row count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import landed


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Neighbours above a node are linked to the smallest of its neighbourhood."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below it are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    below = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node of the component."""
    links = landed(links.filter("a != b").select("a", "b").distinct(), "links")
    before = None
    while True:
        sign = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 31) - 1))).first()
        if sign[0] == 0 or sign == before:
            break
        before = sign
        links = landed(_small_star(landed(_large_star(links), "large-star")), "small-star")
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
