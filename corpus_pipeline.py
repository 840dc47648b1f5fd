"""From documents to a training mix: five stages, each written before the next one reads it.

Every stage but the last returns the columns it was given. Rows are judged whole and once: a stage sees
all rows its predecessor kept. What a stage does with nulls, repeated rows and empty tables is what its
operator does; see there. Rows are told apart by all their columns and not by ``doc_id``, which may be null
or repeat. A near-duplicate group is stood for by its smallest id; rows that are equal in every column are
one document there, and share one verdict elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.llm import decontaminate, mixing, quality_rules, simhash, toxicity
from feedmart.llm.common import landed, ship
from feedmart.session import pin

#: Documents of this score or more go.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(pin(spark))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grammar = toxicity.learn(docs, toxicity.learning_fold(labels))
    return docs.filter(toxicity.score(F.col("text"), grammar) < TOXIC)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(pin(spark))
    return quality_rules.kept(docs)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_key``: equal for rows that are equal in every column, and ordered by the id first."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    digest = F.md5(F.concat_ws(":", F.length("text"), "text"))
    return docs.withColumn("_key", F.struct("doc_id", digest.alias("text"), F.xxhash64(*rest).alias("rest")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(pin(spark))
    rows = keyed(docs)
    classes = simhash.near_duplicates(rows, id_col="_key", shingle=3, distance=2)
    first = classes.filter(F.col("_key").eqNullSafe(F.col("component_id")))
    ids = landed(first.groupBy(F.col("_key").alias("id")).agg((F.count("*") > 1).alias("repeated")), "representatives")
    own = _same(rows["_key"], ids["id"])
    once = rows.join(ids.filter(~F.col("repeated")), own, "left_semi")
    # rows that are equal in every column are few or none: only they are compared
    return once.unionByName(rows.join(ids.filter("repeated"), own, "left_semi").dropDuplicates(docs.columns)).drop("_key")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(pin(spark))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = keyed(docs)
    hits = decontaminate.contaminated(rows, benchmark, id_col="_key")
    found = landed(hits.select(F.col("_key").alias("id")).distinct(), "contaminated")
    return rows.join(found, _same(rows["_key"], found["id"]), "left_anti").drop("_key")


def _same(key: Column, other: Column) -> Column:
    return (key["text"] == other["text"]) & (key["rest"] == other["rest"]) & key["doc_id"].eqNullSafe(other["doc_id"])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the words taken of each, repeats counted."""
    ship(pin(spark))
    return mixing.mix(docs).filter("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_good),
    ("near duplicates", one_of_each_group),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
]

#: Learnt weights and fingerprints have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
