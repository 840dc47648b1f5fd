"""SimHash near-duplicates: generalised pigeonhole over groups of correlated bits.

Texts get a 64-bit fingerprint. Equal fingerprints are one node. If two fingerprints differ in at most
``d`` bits and the bits are parted into groups with thresholds ``t`` whose ``t + 1`` sum to ``d + 1``,
then in some group they differ in at most that group's threshold. So it is enough to look up, in each
group, the values within its threshold.

* Groups: bits that go together across the corpus share a group, from pair counts over all fingerprints.
  Rare values then tell more, and frequent ones can be left out.
* Thresholds: every fingerprint has its own, chosen by dynamic programming over how many fingerprints
  share its value in each group (counted over all) and how many look-ups a threshold takes. A group whose
  value is frequent may get -1: it is not looked up at all.
* Values shared by more than ``CROWD`` fingerprints are parted again: a pair that agrees there differs in
  at most ``d`` of the bits left, so it agrees in one of ``d + 1`` parts of them. Nothing is left out, and
  no large bucket is ever compared all with all.
* Look-ups are a hash join whose condition counts the differing bits; only true links leave it.

Defined results: null and empty texts have fingerprint zero and are linked like any others; texts of
fewer words than a shingle are one shingle; repeated rows share a node; null ids are linked but never
name a component unless it has no other; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from feedmart.llm.common import landed, lower_words_of
from feedmart.llm.components import components

BITS = 64
SEED = 42

#: Texts are hashed in stretches of so many shingles: memory does not follow the longest text.
STRETCH = 1 << 15
#: What a look-up costs in candidates compared, for the choice of groups and thresholds.
LOOKUP = 4
#: Fingerprints that share a value before its remaining bits are parted again.
CROWD = 2000


def fingerprint(words: list[bytes], shingle: int) -> int:
    """The fingerprint of a word sequence as a signed 64-bit number."""
    if not words:
        return 0
    if len(words) < shingle:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    ones, n = np.zeros(BITS, np.int64), 0
    while part := [xxh64_intdigest(s, SEED) for s in itertools.islice(shingles, STRETCH)]:
        hashes = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp) of every row."""

    @F.pandas_udf("long")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(lower_words_of(t), shingle) for t in column], dtype="int64")

    return docs.select(F.col(id_col).alias("id"), of(F.coalesce(F.col(text_col), F.lit(""))).alias("fp"))


def together(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bit i and bit j: 64 x 64 sums, whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy().astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            sums += bits.T @ bits
            n += len(values)
        flat = np.append(sums.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(flat)), "v": flat})

    rows = nodes.select("fp").mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:  # 4097 rows at most
        flat[r["k"]] = r["v"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def correlated_order(n: int, both: np.ndarray) -> list[int]:
    """Bits in an order in which those that go together stand next to each other."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    order = [int(corr.sum(axis=1).argmax())]
    while len(order) < BITS:
        # the nearest to the bits placed last
        pull = corr[order[-8:]].sum(axis=0)
        pull[order] = -1
        order.append(int(pull.argmax()))
    return order


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def groups_for(n: int, order: list[int], distance: int) -> list[list[int]]:
    """The number of groups with the least expected cost for ``n`` even fingerprints, cut from ``order``."""
    best: tuple[float, int] | None = None
    for m in range(1, distance + 3):
        widths = [len(c) for c in np.array_split(np.arange(BITS), m)]
        cost = sum(_allot([[_cost(n / 2.0**w, w, t, n) for t in range(-1, distance + 1)] for w in widths], distance)[1:])
        if best is None or cost < best[0]:
            best = (cost, m)
    return [[order[i] for i in c] for c in np.array_split(np.arange(BITS), best[1])]


def _ball(width: int, t: int) -> int:
    return sum(math.comb(width, k) for k in range(t + 1))


def _cost(sharing: float, width: int, t: int, n: float) -> float:
    """Look-ups and expected candidates of threshold ``t``, where ``sharing`` have the same value."""
    if t < 0:
        return 0.0
    ball = _ball(width, t)
    return LOOKUP * ball + sharing + (ball - 1) * n / 2.0**width


def _allot(costs: list[list[float]], distance: int) -> tuple[list[int], float]:
    """Thresholds (one per group, -1 to ``distance``) of least cost whose t + 1 sum to distance + 1."""
    units = distance + 1
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(math.inf, [])] * units
    for cost in costs:
        best = [
            min(((best[u - k][0] + cost[k], best[u - k][1] + [k - 1]) for k in range(u + 1)), key=lambda x: x[0])
            for u in range(units + 1)
        ]
    return best[units][1], best[units][0]


def allotted(sharing: np.ndarray, widths: list[int], distance: int, n: int) -> np.ndarray:
    """Thresholds for many fingerprints at once: the same dynamic program over columns."""
    rows, units = len(sharing), distance + 1
    best = np.full((rows, units + 1), np.inf)
    best[:, 0] = 0
    picked = []
    for g, w in enumerate(widths):
        cost = np.stack([_cost(0, w, t, n) + (sharing[:, g] if t >= 0 else 0) * np.ones(rows) for t in range(-1, distance + 1)], axis=1)
        nxt, pick = np.full_like(best, np.inf), np.zeros((rows, units + 1), np.int8)
        for u in range(units + 1):
            for k in range(u + 1):
                total = best[:, u - k] + cost[:, k]
                less = total < nxt[:, u]
                nxt[less, u], pick[less, u] = total[less], k
        best = nxt
        picked.append(pick)
    out, left = np.zeros((rows, len(widths)), np.int8), np.full(rows, units)
    for g in range(len(widths) - 1, -1, -1):
        k = picked[g][np.arange(rows), left]
        out[:, g] = k - 1
        left = left - k
    return out


def _flips(bits: list[int], t: int) -> list[int]:
    return [_signed(_mask(list(c))) for k in range(t + 1) for c in itertools.combinations(bits, k)]


def lookups(nodes: DataFrame, groups: list[list[int]], distance: int, n: int) -> tuple[DataFrame, DataFrame]:
    """The table of values (fp, mask, value), and the look-ups in it with each fingerprint's thresholds."""
    masks = [_signed(_mask(g)) for g in groups]
    entries = nodes.select("fp", F.posexplode(F.array(*map(F.lit, masks))).alias("g", "mask")).withColumn(
        "value", F.col("fp").bitwiseAND(F.col("mask"))
    )
    shared = entries.groupBy("g", "value").agg(F.count("*").alias("n"))
    known = (
        entries.join(shared, ["g", "value"])
        .groupBy("fp")
        .agg(F.array_sort(F.collect_list(F.struct("g", "n"))).alias("of"))  # one per group
        .select("fp", F.transform("of", lambda x: x["n"]).alias("sharing"))
    )
    widths = [len(g) for g in groups]
    flips = [[np.array(_flips(g, t), np.int64) for t in range(distance + 1)] for g in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            if not len(fps):
                continue
            sharing = np.stack(batch.column(1).to_pylist()).astype(float)
            thresholds = allotted(sharing, widths, distance, n)
            for g, mask in enumerate(masks):
                for t in range(distance + 1):
                    own = fps[thresholds[:, g] == t]
                    if len(own):
                        values = ((own & mask)[:, None] ^ flips[g][t]).ravel()
                        yield pa.RecordBatch.from_pydict(
                            {"fp": np.repeat(own, len(flips[g][t])), "mask": np.full(len(values), mask), "value": values}
                        )

    return entries.select("fp", "mask", "value"), known.mapInArrow(run, "fp long, mask long, value long")


def _parts(mask: int, order: list[int], pieces: int) -> list[int]:
    """The bits outside ``mask`` in ``pieces`` parts, each joined with the mask."""
    free = [b for b in order if not mask >> b & 1]
    return [_signed(mask & (2**BITS - 1) | _mask(free[k::pieces])) for k in range(pieces)]


def thinned(table: DataFrame, asked: DataFrame, order: list[int], distance: int) -> tuple[DataFrame, DataFrame]:
    """Both tables with crowded values parted by further bits, until none is crowded."""
    while True:
        crowded = landed(table.groupBy("mask", "value").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).drop("n"), "crowded")
        masks = [r["mask"] for r in crowded.select("mask").distinct().collect()]  # few: groups and their parts
        masks = [m for m in masks if bin(m & (2**BITS - 1)).count("1") < BITS - distance]
        if not masks:
            return table, asked
        finer = F.create_map(*(x for m in masks for x in (F.lit(m), F.array(*map(F.lit, _parts(m, order, distance + 1))))))
        crowded = crowded.filter(F.col("mask").isin(masks))

        def split(df: DataFrame) -> DataFrame:
            rest = df.join(crowded, ["mask", "value"], "left_anti")
            parted = df.join(crowded, ["mask", "value"], "left_semi").withColumn("finer", F.explode(finer[F.col("mask")]))
            # the value looked up may have bits flipped within the mask, so only further bits are added
            more = F.col("fp").bitwiseAND(F.col("finer").bitwiseAND(F.bitwise_not("mask")))
            return rest.select("fp", "mask", "value").unionByName(
                parted.select("fp", F.col("finer").alias("mask"), F.col("value").bitwiseOR(more).alias("value"))
            )

        table, asked = landed(split(table), "values"), landed(split(asked), "asked")


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints that differ in at most ``distance`` bits."""
    n, both = together(nodes)
    order = correlated_order(n, both)
    table, asked = lookups(nodes, groups_for(n, order, distance), distance, n)
    table, asked = thinned(landed(table, "values"), landed(asked, "asked"), order, distance)
    near = F.bit_count(F.col("t.fp").bitwiseXOR(F.col("q.fp"))) <= distance
    same = (F.col("t.mask") == F.col("q.mask")) & (F.col("t.value") == F.col("q.value"))
    return (
        asked.alias("q")
        .join(table.alias("t"), same & near & (F.col("t.fp") != F.col("q.fp")))
        .select(F.least("t.fp", "q.fp").alias("a"), F.greatest("t.fp", "q.fp").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """Per row: (id, fingerprint in hex, component_id), the smallest id reachable over links."""
    rows = landed(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = landed(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes, distance))
    joined = nodes.join(roots, nodes["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = landed(joined.join(ids, "root").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
