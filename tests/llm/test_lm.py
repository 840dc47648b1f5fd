"""Language-model scores: base scores against brute force, held-out gain, and odd rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from feedmart.llm import lm
from feedmart.llm.common import crc_of, lower_words_of, ship

SYLLABLES = {"a": "ra to mi se lo".split(), "b": "und gen ver ich ung".split()}


def corpus(n=300):
    rng = random.Random(8)
    rows = []
    for k in range(n):
        kind = "ab"[k % 2]
        words = ["".join(rng.choice(SYLLABLES[kind]) for _ in range(rng.choice([1, 1, 2, 3]))) for _ in range(rng.randrange(5, 60))]
        rows.append((k, " ".join(words)))
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \n"), (5, "Second Row of 5"), (None, "ra to"), (n + 3, "longword" * 40 + " ra")]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in low.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]


@pytest.mark.parametrize("known", [1 << 17, 20, 2])
def test_base_scores_equal_brute_force(spark, monkeypatch, known):
    ship(spark)
    monkeypatch.setattr(lm, "KNOWN", known)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int").repartition(3)
    got = lm.scored(docs, lm.learning_fold()).collect()
    c = Counter()
    for i, t in rows:
        if i is not None and crc_of(i, 10):
            c.update([*words(t), "<end>"])
    n, v = sum(c.values()), len(c)
    below = math.log10(n + 0.1 * (v + 1))

    def expect(i, t):
        tokens = [*words(t), "<end>"]
        return i, len(tokens), sum(c[w] > 0 for w in tokens), n, round(sum(math.log10(c[w] + 0.1) - below for w in tokens), 6)

    mine = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=repr)
    assert mine == sorted((expect(i, t) for i, t in rows), key=repr)
    held = [r for r in got if r["doc_id"] is not None and not crc_of(r["doc_id"], 10) and r["n_tokens"] > 5]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in got)


def test_nothing_to_learn_from(spark):
    ship(spark)
    docs = spark.createDataFrame([(None, "ra to"), (None, None)], "doc_id long, text string")
    got = lm.scored(docs, lm.learning_fold()).collect()
    assert [r["train_tokens"] for r in got] == [0, 0] and all(math.isfinite(r["score"]) for r in got)
    assert lm.scored(docs.limit(0), lm.learning_fold()).count() == 0


def test_result_does_not_follow_the_partitions(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 300)  # many shards, and more than one level of averages
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    got = []
    for n in (1, 6):
        rows = lm.scored(docs.repartition(n), lm.learning_fold()).collect()
        got.append(sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["score"]) for r in rows)))
    assert [r[:3] for r in got[0]] == [r[:3] for r in got[1]]
    assert all(math.isclose(a[3], b[3], rel_tol=1e-5) for a, b in zip(*got, strict=True))


def test_every_text_is_learnt_from(spark, monkeypatch):
    """Weights after a round change with any one of the training texts."""
    ship(spark)
    rows = [(k, t) for k, t in corpus(40) if k is not None and t]
    docs = spark.createDataFrame(rows, "id long, text string")
    vocab = lm.vocabulary(lm.counted(docs), docs)
    seen = []
    original = lm._mean
    monkeypatch.setattr(lm, "_mean", lambda found: seen.append(sum(r[1] for r in found)) or original(found))
    lm.trained(docs, vocab)
    assert sum(seen) == vocab.total


def test_numbers_stand_for_texts(spark):
    """Classes and weights that follow from the numbers of the texts are those that follow from the texts."""
    ship(spark)
    rows = [(k, t) for k, t in corpus(40) if k is not None]
    docs = spark.createDataFrame(rows, "id long, text string")
    known = lm.known_words(lm.counted(docs.na.fill("")))
    numbers = lm._numbered(docs.na.fill(""), known).select("id", "tokens").cache()
    unknown = lm.Known({lm.END: 0, b"ra": 1}, known.count[:2], known.total, known.distinct)
    assert unknown.numbers([b"ra", b"lo,", b"ra"]).tolist() == [1, -1 - lm.ending(b"lo,"), 1]
    counts = lm.counted(docs.na.fill(""))
    one, other = lm.vocabulary(counts, docs.na.fill("")), lm.vocabulary(counts, numbers, known)
    assert (one.tokens == other.tokens).all() and (one.rest == other.rest).all()
    weights, again = lm.trained(docs.na.fill(""), one), lm.trained(numbers, other)
    assert all(np.allclose(weights[k], again[k]) for k in weights)


def test_words_of_a_column_are_those_of_its_texts():
    """Words are parted, counted and looked up for a whole column, without a Python object per word."""
    rng = random.Random(6)
    texts = ["".join(rng.choice("aB Z\t\n\x0b\x0c\r\x1c\x1f\x85\xa0 \u00c9\u00df.,;\"')(\x00") for _ in range(rng.randrange(40))) for _ in range(500)]
    texts += [None, "", " \n", "a" * 300, "\U0001f600, x"]
    column = pa.array(["left out", *texts])[1:]
    starts, found = lm.words_in(column)
    assert [found[a:b].to_pylist() for a, b in zip(starts, starts[1:])] == [lower_words_of(t) for t in texts]
    assert [w.to_pylist() for w in (lm.words_in(column[:0])[1], lm.words_in(column[-3:-2])[1])] == [[], []]
    cut = [b.num_rows for b in lm.pieces(iter([pa.RecordBatch.from_arrays([column], ["text"])]), 0, 100)]
    assert sum(cut) == len(texts) and len(cut) > 50


def test_endings_are_worked_out_once_for_words_that_share_them(monkeypatch):
    odd = [b"", b".", b"a.,", b"abc", b"abc,", b"\xc3\xa4\xc3\xb6", b"(\xc3\xa4)", lm.END]
    many = [f"w{k}ing{'.' * (k % 2)}".encode() for k in range(1000)]
    expect = [lm.ending(w) for w in odd + many]
    asked, original = [], lm._ending
    monkeypatch.setattr(lm, "_ending", lambda *of: asked.append(of) or original(*of))
    assert lm.endings(pa.array(odd + many, pa.binary())).tolist() == expect
    assert len(asked) < 20
    assert lm.endings(pa.array([], pa.binary())).tolist() == []
