"""Mixing sources to target weights by weighted sampling without replacement.

Sizes are words. A source's target is its weight's share of all words, but at most ``MOST`` times its
size; what lies above goes to the other sources by weight until none is above. A source is first taken
in complete epochs. The rest of its target is filled in the order of the exponential keys
``-ln(u) / weight`` (Efraimidis and Spirakis), where ``u`` comes from the id, so reruns agree. A text is
taken if the middle of its stretch of the running sum lies within the rest, which is off by half a
text at most.

No task sorts a source. The keys of a source fall into ``BUCKETS`` even ranges; sums per range tell the
one range in which the target is reached, and only its rows are sorted. A source with a third of all
rows is thus summed within tasks and sorted for a two-thousandth of its rows.

Defined results: a null or empty text has size 0 and 0 words taken; null is a source of its own, after
all others; repeated rows share a key and are ordered at will, which their equal rows don't show; with
no words at all every target is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmart.llm.common import landed

# Weights by the place of the source, and how often a source may be used.
WEIGHTS = (5, 2, 1)
MOST = 3

BUCKETS = 2048
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """0.1 to 1: less for symbols and exclamation marks among the characters, and for few words."""
    length = F.length(F.coalesce(text, F.lit("")))
    plain = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[#*$%&|<>!]", ""))
    clean = F.when(length > 0, plain / length).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.1), clean * F.least(F.lit(1.0), size / F.lit(50.0)))


def _uniform(key: Column) -> Column:
    """A number between 0 and 1 that follows from ``key``."""
    digits = F.substring(F.md5(key.cast("string")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def _ranked(sources: DataFrame) -> DataFrame:
    """``place`` of each source by code point from 0, null last: ranges, their sizes, then offsets."""
    order = [F.col("source").isNull(), F.col("source")]
    placed = landed(
        sources.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "source",
            "source_size",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"),
        ),
        "sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = placed.groupBy("part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return placed.join(parts, "part").select("source", "source_size", (F.col("row") + F.col("offset")).alias("place"))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) of rows (source, size)."""
    ranked = _ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    weighted = landed(ranked.withColumn("weight", weight), "weights")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while total:
        # sums over all sources in each turn: only three numbers come back
        above = MOST * F.col("source_size") < F.lit(level) * F.col("weight")
        n, held, open_weight = weighted.agg(
            F.count_if(above), F.sum(F.when(above, F.col("source_size")).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        if n == full or not open_weight:
            break
        full, level = n, (total - MOST * held) / open_weight
    target = F.least(F.lit(float(MOST)) * F.col("source_size"), F.lit(level) * F.col("weight"))
    return weighted.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
) -> DataFrame:
    """Per row: size, source_size, target of its source, and the words taken of it, repeats counted."""
    size = size_of(F.col(text_col))
    weight = quality_weight(F.col(text_col), size) if weight is None else weight
    key = -F.log(_uniform(F.col(id_col))) / weight
    slim = landed(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key")).withColumn(
            "bucket", F.least(F.lit(BUCKETS - 1), F.floor((1 - F.exp(-F.col("key"))) * BUCKETS)).cast("int")
        ),
        "sizes",
    )
    aims = targets(slim)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = aims.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = slim.groupBy("source", "bucket").agg(F.sum("size").alias("sum")).withColumn("upto", F.sum("sum").over(up_to))
    same = sums["source"].eqNullSafe(aims["source"])
    reached = (
        sums.join(aims, same)
        .filter(F.col("upto") > F.col("rest"))
        .groupBy(sums["source"])
        .agg(F.min_by(F.struct(F.col("bucket").alias("edge"), (F.col("upto") - F.col("sum")).alias("before")), "bucket").alias("at"))
        .select(F.col("source").alias("s"), "at.*")
    )
    aims = landed(
        aims.join(reached, aims["source"].eqNullSafe(reached["s"]), "left")
        .withColumn("edge", F.coalesce("edge", F.lit(BUCKETS)))
        .withColumn("before", F.coalesce("before", F.lit(0).cast("long")))
        .withColumnRenamed("source", "of")
        .drop("s"),
        "aims",
    )
    rows = slim.join(aims, slim["source"].eqNullSafe(aims["of"]))
    whole = rows.filter(F.col("bucket") != F.col("edge")).withColumn("chosen", F.col("bucket") < F.col("edge"))
    earlier = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    edge = rows.filter(F.col("bucket") == F.col("edge")).withColumn("chosen", start + F.col("size") / 2 <= F.col("rest"))
    return whole.unionByName(edge).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("epochs") + F.col("chosen").cast("int"))).cast("long").alias("taken"),
    )
