"""What five filters remove, for each order in which they may run.

A document is a mask of the filters it fails. A mask settles what happens to the document in each of the
120 orders: it is removed at the first step whose filter it fails. So a mask maps to one wide integer with
a field of ``WIDTH`` bits for every order and step, which is 1 where the document is removed, and a last
field that counts the document. The integers of a part's documents are summed, and as a field has room
for any count that Spark can hold, no field runs over into the next one. All results are unpacked from the
sums: kept and redundant documents, those that only one filter catches, and Shapley sums.

Documents are counted per part, mask and labels first, within the tasks, so equal integers meet as one
multiple and a part has 128 rows at most, however many documents it holds. Repeats of a text are found by
digest. Rows of a digest are first counted per part and labels, so a group of copies is a few rows by the
time it is brought together, and no document is joined with its group.

Defined results: a null text is empty, a null part is the empty string; a null id is not smaller than any
id nor has a smaller one, so E keeps it; equal ids with equal texts are not repeats of one another; a
document has a label if any of its label rows has it; an empty table gives no rows. Clashing extra columns
are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
#: Every order of the filters, by name.
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
SLOTS = len(ORDERS) * STEPS

#: Bits of a field: counts are longs, so a sum of any number of documents fits.
WIDTH = 64

SPACE = r"[\x20\x09-\x0D]+"

SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_mask(text: Column) -> Column:
    """The failed filters of a text as bits: A 1, B 2, C 4, D 8."""
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words)
    fails = [
        n < 100,
        100 * F.size(F.array_distinct(words)) < 80 * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(f, F.lit(1 << k)).otherwise(0) for k, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, part, digest, mask, good, toxic) per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("digest"),
        text_mask(text).alias("mask"),
    )
    wanted = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return found.join(wanted, "id", "left").fillna(False, ["good", "toxic"])


def mask_counts(rows: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n), the repeats of an earlier id with bit E."""
    kinds = ["digest", "part", "mask", "good", "toxic"]
    per_id = rows.groupBy("id", *kinds).agg(F.count("*").alias("n"))
    per_text = per_id.groupBy(*kinds).agg(
        F.sum("n").alias("n"),
        F.min("id").alias("first"),
        F.min_by("n", "id").alias("at_first"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
    )
    earliest = F.min("first").over(Window.partitionBy("digest"))
    own = F.when(F.col("first") == earliest, F.col("at_first")).otherwise(0)
    split = per_text.withColumn("passing", F.col("without_id") + own)
    repeat = F.col("mask").bitwiseOR(1 << 4)
    both = F.array(
        F.struct(F.col("mask").alias("full"), F.col("passing").alias("m")),
        F.struct(repeat.alias("full"), (F.col("n") - F.col("passing")).alias("m")),
    )
    return (
        split.select("part", "good", "toxic", F.inline(both))
        .filter("m > 0")
        .groupBy("part", F.col("full").alias("mask"), "good", "toxic")
        .agg(F.sum("m").alias("n"))
    )


def packed(mask: int) -> int:
    """The wide integer of one document: the step of each order that removes it, and the document."""
    value = 1 << (WIDTH * SLOTS)
    for k, order in enumerate(ORDERS):
        step = next((s for s, name in enumerate(order) if mask >> FILTERS.index(name) & 1), None)
        if step is not None:
            value += 1 << (WIDTH * (STEPS * k + step))
    return value


def unpacked(total: int) -> tuple[np.ndarray, int]:
    """Documents removed per order and step, and all documents."""
    fields = np.frombuffer(total.to_bytes((SLOTS + 1) * WIDTH // 8, "little"), "<i8")
    return fields[:-1].reshape(len(ORDERS), STEPS), int(fields[-1])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    counts = mask_counts(labelled(docs, labels, id_col))
    return counts.groupBy("part").applyInArrow(_report, SCHEMA)


def _report(group: pa.Table) -> pa.Table:
    every = good = toxic = 0
    wide: dict[int, int] = {}
    for row in group.to_pylist():  # 128 rows at most
        mask = row["mask"]
        if mask not in wide:
            wide[mask] = packed(mask)
        many = row["n"] * wide[mask]
        every += many
        good += many if row["good"] else 0
        toxic += many if row["toxic"] else 0
    removed, n = unpacked(every)
    place = np.array([[FILTERS.index(name) for name in order] for order in ORDERS])
    fails = np.array([removed[place[:, 0] == f, 0][0] for f in range(STEPS)])  # its filter runs first
    alone = np.array([removed[place[:, -1] == f, -1][0] for f in range(STEPS)])  # its filter runs last
    shapley = np.array([removed[place == f].sum() for f in range(STEPS)])
    columns = {
        "kept": n - removed.cumsum(axis=1),
        "removed": removed,
        "redundant": fails[place] - removed,
        "unique_fails": alone[place],
        "good_lost": unpacked(good)[0],
        "toxic_lost": unpacked(toxic)[0],
        "shapley": shapley[place],
    }
    return pa.table(
        {
            "part": pa.array([group.column("part")[0].as_py()] * SLOTS, pa.string()),
            "filter_order": pa.array([order for order in ORDERS for _ in order], pa.string()),
            "step": pa.array(list(range(1, STEPS + 1)) * len(ORDERS), pa.int32()),
            **{name: pa.array(values.reshape(-1), pa.int64()) for name, values in columns.items()},
        }
    )
