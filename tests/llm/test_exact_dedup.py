"""Groups against a brute-force version, with and without frequent texts; edge cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from feedmart.llm import exact_dedup

COLUMNS = "doc_id long, text string, keep_id long, digest string, id string, row int, kept int, top string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x", "y", 1, 2, "z") for i, t in rows], COLUMNS)


def brute(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[t or ""].append((i is not None, i or 0, k))
    out = []
    for text, members in groups.items():
        top = max(members)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for known, i, k in members:
            out.append((i if known else None, top[1] if top[0] else None, len(members), (known, i, k) == top, digest))
    return out


def check(spark, rows, tracked=exact_dedup.TRACKED):
    got = exact_dedup.duplicates(frame(spark, rows), tracked=tracked)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows))


def mixed(n=1200, seed=3):
    rng = random.Random(seed)
    hot = "the same text everywhere " * 20
    return [(k, hot if rng.random() < 0.35 else rng.choice(["", None, "a", " a", "a ", "A"]) if rng.random() < 0.2 else f"text {rng.randrange(700)}") for k in range(n)]


def test_groups(spark):
    check(spark, mixed())


def test_any_suspects_give_the_same_rows(spark):
    check(spark, mixed(), tracked=16)


def test_a_hot_text_is_found_and_leaves_the_shuffle(spark):
    rows = exact_dedup.digests(frame(spark, mixed()).repartition(7))
    tokens = exact_dedup.suspects(rows, 64)
    hot = hashlib.sha256(("the same text everywhere " * 20).encode()).hexdigest()
    assert 0 < tokens.count() <= 64
    assert hot in {r["digest"] for r in exact_dedup.verified(rows, tokens).collect()}


def test_more_partitions_than_rows(spark):
    rows = mixed(40)
    got = exact_dedup.duplicates(frame(spark, rows).repartition(60))
    assert sorted((r["keep_id"], r["group_size"]) for r in got.collect()) == sorted((r[1], r[2]) for r in brute(rows))


def test_nulls_repeats_and_long_texts(spark):
    long = "x" * 300_000
    rows = [(None, None), (None, ""), (5, ""), (5, None), (5, ""), (7, long), (6, long), (None, long), (8, long + " "), (9, "é"), (10, "é")]
    check(spark, rows)
    check(spark, [(None, "a"), (None, "a")])


def test_empty_table(spark):
    check(spark, [])


def test_a_normalised_text(spark):
    got = exact_dedup.duplicates(frame(spark, [(1, "A b"), (2, "a B"), (3, "c")]), text=F.lower("text"))
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in got.collect()) == [(1, 2, False), (2, 2, True), (3, 3, True)]
