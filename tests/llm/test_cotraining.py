"""Co-training: accuracy on held-out rows, what a view may teach, and odd rows."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

from feedmart.llm import cotraining as C
from feedmart.llm.common import ship


def test_thresholds_are_ranks_weighed_by_calibration():
    free = np.ones(C.BINS)
    counts = np.zeros((C.BINS, 2))
    counts[95, 1], counts[4, 0] = 100, 100
    low, high, bad, good = C.thresholds(counts, free)
    assert low < 0.01 and high > 0.99 and 0.15 < bad <= C.PSEUDO and 0.15 < good <= C.PSEUDO
    assert C.taught_rows(free, (low, high, bad, good)) == 2 * C.SHARE * C.BINS
    counts[95, 0] = counts[95, 1]  # no better than chance
    assert C.thresholds(counts, free)[3] < bad
    counts[:, 0], counts[:, 1] = 1, 1
    assert C.thresholds(counts, free)[2:] == (0.0, 0.0)
    few = np.zeros(C.BINS)
    few[70], few[20] = 5, 1  # the first bin that holds any row counts even if it holds more than the share
    _, high, _, _ = C.thresholds(np.zeros((C.BINS, 2)), few)
    assert abs(high - C.sigmoid(70 * 16 / C.BINS - 8)) < 1e-9


def plain(x, z, y, fold, rounds):
    """The rounds in one place, on whole matrices."""

    def fit(views, said):
        for _ in range(C.STEPS):
            new = []
            for k, m in enumerate((x, z)):
                target, weight = np.where(np.isnan(y), 0, y), (~np.isnan(y) & (fold == 0)).astype(float)
                if said is not None:
                    for i in np.flatnonzero(np.isnan(y)):
                        target[i], weight[i] = said[1 - k][i]
                p = 1 / (1 + np.exp(-np.clip(m @ views[k], -30, 30)))
                slope = m.T @ (weight * (target - p)) - C.RIDGE * views[k]
                curve = m.T @ np.diag(weight * p * (1 - p)) @ m + C.RIDGE * np.eye(m.shape[1])
                new.append(views[k] + np.clip(np.linalg.solve(curve, slope), -4, 4))
            views = new
        return views

    def say(m, w):
        """(label, weight) per row, by ranks of bins."""
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        at, free, held = C._bins(p), np.isnan(y), ~np.isnan(y) & (fold == 1)
        out = [(0.0, 0.0)] * len(y)
        for label in (0, 1):
            order = range(C.BINS // 2) if label == 0 else range(C.BINS - 1, C.BINS // 2 - 1, -1)
            taken, n = set(), 0
            for b in order:
                here = int((at[free] == b).sum())
                if n + here > C.SHARE * free.sum() and n > 0:
                    break
                taken.add(b)
                n += here
            inside = np.array([b in taken for b in at])
            chance = ((y[held] == label).sum() + 1) / (held.sum() + 2)
            right = ((y[held & inside] == label).sum() + 2 * chance) / ((held & inside).sum() + 2)
            weight = C.PSEUDO * max(0.0, (right - max(chance, 0.5)) / (1 - max(chance, 0.5)))
            for i in np.flatnonzero(inside):
                out[i] = (float(label), weight)
        return out

    views = fit([np.zeros(C.TEXT), np.zeros(C.META)], None)
    for _ in range(rounds):
        views = fit(views, (say(x, views[0]), say(z, views[1])))
    return views


def test_rounds_equal_a_plain_version_and_both_views_teach(spark):
    ship(spark)
    data = rows()
    docs = spark.createDataFrame([r[:5] for r in data], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(r[0], int(r[5])) for r in data if r[0] % 2], "doc_id long, quality int")
    prepared = C.prepared(docs, labels, "doc_id", "text", "lang", "source", "n_chars")
    views, _, taught = C.cotrained(prepared, 2)
    held = prepared.collect()
    x = np.array([r["text_x"] for r in held], float)
    z = np.zeros((len(held), C.META))
    z[:, 0] = 1
    for i, r in enumerate(held):
        z[i, r["meta_x"]] = 1
    y = np.array([np.nan if r["y"] is None else r["y"] for r in held], float)
    expected = plain(x, z, y, np.array([r["fold"] for r in held]), 2)
    assert np.allclose(views[0], expected[0], atol=1e-6) and np.allclose(views[1], expected[1], atol=1e-6)
    assert all(a > 0 and b > 0 for a, b in taught)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_both_views_teach_on_little_data(spark):
    ship(spark)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    _, _, taught = C.cotrained(C.prepared(docs, labels, "doc_id", "text", "lang", "source", "n_chars"))
    assert len(taught) == C.ROUNDS and all(a > 0 and b > 0 for a, b in taught)


def test_words_tell_texts_of_one_shape_apart(spark):
    ship(spark)
    rng = random.Random(3)
    good, bad = ["river", "stone", "cloud", "field"], ["cheap", "pills", "order", "click"]
    data = []
    for k in range(400):
        words = [rng.choice(good if k % 2 else bad) if rng.random() < 0.3 else "".join(rng.choice("aeiou") for _ in range(5)) for _ in range(60)]
        data.append((k, " ".join(words), "en", "s", 359))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, k % 2) for k in range(0, 400)], "doc_id long, quality int")
    got = [r for r in C.classify(docs, labels).collect() if r["held_out"]]
    assert np.mean([r["kept"] == bool(r["doc_id"] % 2) for r in got]) > 0.95


def test_combination_follows_the_better_view():
    rng, counts = np.random.default_rng(1), np.zeros((C.BINS, C.BINS, 2))
    for _ in range(3000):
        y = int(rng.integers(0, 2))
        counts[70 if y else 30, rng.integers(0, C.BINS), y] += 1
    weights = C.combined(counts)
    assert abs(weights[5]) > 5 * abs(weights[6])


def rows():
    rng = random.Random(1)
    out = []
    for k in range(600):
        good = k % 3 > 0
        words = ["".join(rng.choice("aeioulmnrst") for _ in range(5)) for _ in range(40)]
        text = " ".join(words) if good else " ".join(w + "%%%" for w in words)
        out.append((k, text, "en", "clean" if good == (k % 10 > 0) else "junk", len(text), good))
    return out


def test_held_out_rows_and_odd_ones(spark):
    ship(spark)
    data = rows()
    odd = [(None, None, None, None, None), (5000, "", "en", None, 0), (5001, "w " * 100000, "en", "s", 200000), (7, data[7][1], "en", "junk", 5)]
    docs = spark.createDataFrame([*(r[:5] for r in data), *odd], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("y", docs["n_chars"])
    labels = [(r[0], int(r[5])) for r in data if r[0] % 2] + [(1, 1), (3, None), (None, 1)]
    got = C.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(data) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    truth = {r[0]: r[5] for r in data}
    right = [r["kept"] == truth[r["doc_id"]] for r in got if r["doc_id"] in truth]
    assert np.mean(right) > 0.98


def test_without_labels_and_rows(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "some text", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert abs(C.classify(docs, none, rounds=1).first()["score"] - 0.5) < 1e-6
    assert C.classify(docs.limit(0), none, rounds=1).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_accuracy(spark):
    ship(spark)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = C.classify(docs, labels, rounds=1).join(labels, "doc_id").filter("held_out").select("quality", "kept").collect()
    assert np.mean([bool(q) == k for q, k in got]) > 0.93
