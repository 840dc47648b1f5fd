"""Exact duplicates, with the frequent texts settled before any shuffle.

Three steps over a landed table of digests (32 bytes in hex, and the id):

1. Each task keeps a Misra-Gries summary of ``TRACKED`` counters (Spark's mergeable frequent-items
   sketch). Summaries are merged in two levels, so no task reads more than a share of them. Every digest
   with more than a few ``1 / TRACKED`` of the rows is among the suspects; some suspects are not frequent.
2. The suspects, ``TRACKED`` at most, are broadcast, and their rows counted exactly in one aggregation,
   which leaves one row per task and suspect to shuffle. That gives each suspect's exact size and winner.
3. The verified winners, again ``TRACKED`` at most, are broadcast. A row with one of their digests is
   settled where it is read; only the rest is shuffled by digest. A group there is below the bound of
   step 1, whatever the number of rows.

Which digests are suspects decides about the way only: the result is the same for any of them. Texts are
equal if their SHA-256 is.

Defined results: null counts as the empty text. The largest id stays; null is below every id; among rows
that also share the id one stays, and such rows differ in ``kept`` alone. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmart.llm.common import landed

#: Counters of a summary: at most so many digests are broadcast.
TRACKED = 4096

#: Summaries are first merged to so many.
SHARDS = 64


def digests(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None) -> DataFrame:
    """(id, digest, row): the SHA-256 of ``text``, by default the column ``text`` as it is."""
    text = F.col("text") if text is None else text
    return docs.select(
        F.col(id_col).alias("id"),
        F.sha2(F.coalesce(text, F.lit("")), 256).alias("digest"),
        F.monotonically_increasing_id().alias("row"),  # tells rows with one id apart once it is landed
    )


def suspects(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """(token): hashes of the digests that may be frequent, ``tracked`` at most, none frequent missing."""
    counted = (
        rows.select(_token().alias("token"), (F.spark_partition_id() % SHARDS).alias("shard"))
        .groupBy("shard")
        .agg(F.expr(f"approx_top_k_accumulate(token, {tracked})").alias("summary"))
        # by a key that all shards share: Spark cannot combine the summary of a task without rows
        .groupBy(F.col("shard") < 0)
        .agg(F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))
    )
    frequent = counted.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {tracked})")).alias("_"))
    return frequent.filter("_.count > 1").select(F.col("_.item").alias("token"))


def verified(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """(digest, group_size, top) of the suspects that do repeat, counted exactly."""
    return (
        rows.withColumn("token", _token())
        .join(F.broadcast(tokens), "token", "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("top"))
        .filter("group_size > 1")
    )


def duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: Column | None = None, tracked: int = TRACKED
) -> DataFrame:
    """Per row: keep_id (the id that stays of its group), group_size, kept, text_sha256."""
    rows = landed(digests(docs, id_col, text), "digests")
    tokens = landed(suspects(rows, tracked), "suspects")
    winners = landed(verified(rows, tokens), "winners")
    marked = rows.join(F.broadcast(winners), "digest", "left")
    frequent = marked.filter(F.col("group_size").isNotNull())
    group = Window.partitionBy("digest")
    rest = marked.filter(F.col("group_size").isNull()).withColumns(
        {"group_size": F.count("*").over(group), "top": F.max(F.struct("id", "row")).over(group)}
    )
    return frequent.unionByName(rest).select(
        F.col("id").alias(id_col),
        F.col("top.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _token() -> Column:
    return F.xxhash64("digest")
