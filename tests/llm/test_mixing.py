"""Targets against a brute-force version, totals near them, whole epochs first, edge cases."""

from __future__ import annotations

import math
from collections import defaultdict

from feedmart.llm import mixing

COLUMNS = "doc_id long, text string, source string, size string, key int"


def frame(spark, rows):
    # with columns named like results and like those the operator uses itself
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], COLUMNS)


def words(n):
    return " ".join(["word"] * n)


def aims(sizes):
    """Targets by source: by weight, at most three times the size, the excess reshared."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: share.get(s, 3.0 * sizes[s]) for s in order}
        full |= above


def check(spark, rows):
    out = mixing.mix(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    source = {i: s for i, _, s in rows}
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
        longest[s] = max(longest[s], len((t or "").split()))
    want = aims(sizes)
    for r in out:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] <= 3 * r["size"]
        epochs = math.floor(want[s] / sizes[s] + 1e-9) if sizes[s] else 0
        assert r["taken"] >= min(epochs, 3) * r["size"] - 1e-6
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6, (s, taken[s], want[s])
    return sorted(map(tuple, out))


def test_hot_source_and_null_source(spark):
    rows = [(k, words(10 + k % 90), "web" if k % 3 else ["books", "code", None, "zoo"][k % 4]) for k in range(900)]
    assert check(spark, rows) == check(spark, rows[::-1])


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(0, words(5), "a"), (1, words(7), "a"), (2, words(3), "b")] + [(k, words(50), "c") for k in range(3, 40)]
    check(spark, rows)


def test_null_and_empty_texts_and_one_long_one(spark):
    rows = [(0, None, "a"), (1, "", "a"), (2, " \n\t", None), (3, words(200_000), "b"), (4, "one", "b")]
    check(spark, rows)


def test_no_words_at_all(spark):
    out = mixing.mix(frame(spark, [(0, None, "a"), (1, "", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in out] == [(0, 0.0, 0)] * 2


def test_empty_table(spark):
    assert mixing.mix(frame(spark, [(0, "", "a")]).filter("false")).count() == 0


def test_repeated_rows_and_null_ids(spark):
    rows = [(7, words(20), "a")] * 6 + [(None, words(20), "a")] * 2 + [(k, words(20), "b") for k in range(9)]
    out = mixing.mix(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    again = mixing.mix(frame(spark, rows)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_better_texts_come_first(spark):
    clean = [(k, words(100), "a") for k in range(200)]
    noisy = [(k, " ".join(["#$%&"] * 100), "a") for k in range(200, 400)]
    rest = [(k, words(100), "b") for k in range(400, 420)]
    share = defaultdict(int)
    for r in mixing.mix(frame(spark, clean + noisy + rest)).collect():
        share[r["doc_id"] // 200] += r["taken"] > 0
    assert share[0] > share[1]
