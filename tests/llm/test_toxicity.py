"""The toxicity grammar: its clauses, what labels add, and held-out accuracy."""

from __future__ import annotations

import os
import random
import re
import time

import pytest

from feedmart.llm import toxicity
from feedmart.llm import toxicity_lexicon as lexicon
from feedmart.llm.common import ship
from feedmart.llm.toxicity import ARCS, Grammar, clause_arcs, score_of

PLAIN = Grammar()


def used(text):
    return [{a: n for a, n in zip(ARCS, arcs) if n} for _, arcs in clause_arcs(text, PLAIN.insults)]


def test_arcs_of_clauses():
    assert used("the idiot left. all fine.") == [{"insult": 1}]
    assert used("you idiot!") == [{"insult": 1, "targeted": 1}]
    assert used("he is not an idiot") == [{"negated": 1, "targeted": 1}]
    assert used("not one of these many words is idiot") == [{"insult": 1}]
    assert used("somebody said idiot") == [{"reported": 1}]
    assert used("we will destroy them") == [{"threat": 1}]
    assert used("we never destroy them") == []
    assert used("destroy the bug") == []
    assert used("idiotic nonsense") == []
    assert used(None) == used("") == []


def test_what_a_negation_governs():
    for text in ("I will kill you", "No, I will kill you", "I will not rest until I kill you", "no one knows when, but they kill you"):
        assert [u.get("threat") for u in used(text)] == [1], text
    for text in ("we don't kill you", "they won’t ever kill him", "no we never kill you"):
        assert used(text) == [], text
    assert used("you aren't stupid") == used("you aren’t stupid") == used("you are not stupid") == [{"negated": 1, "targeted": 1}]
    assert used("you are stupid") == [{"insult": 1, "targeted": 1}]
    assert used("l'idiot n'est pas là") == [{"insult": 1}]


def read_plainly(clause):
    """The grammar's rules on one clause, without automata."""
    words = re.findall(r"[^\W\d_]*n['’]t(?![^\W\d_])|[^\W\d_]+|,", clause.lower())
    uses, reported, aimed, threats, people, insults = dict.fromkeys(ARCS, 0), False, False, 0, 0, 0
    for k, w in enumerate(words):
        since = [x for x in range(max(0, k - toxicity.REACH), k) if words[x] in lexicon.NEGATIONS or words[x].endswith(("n't", "n’t"))]
        governed = any("," not in words[x:k] for x in since)
        if f"{w}$" in PLAIN.insults:
            uses["negated" if governed else "reported" if reported else "insult"] += 1
            insults += 1
        elif w in lexicon.TARGETS:
            people += 1
        elif w in lexicon.THREATS and not governed:
            threats += 1
        reported |= w in lexicon.REPORTS
    uses["targeted"], uses["threat"] = int(insults > 0 and people > 0), int(threats > 0 and people > 0)
    return {a: n for a, n in uses.items() if n}


def test_clauses_equal_a_plain_reading():
    rng = random.Random(6)
    words = ["idiot", "scum", "kill", "destroy", "you", "them", "not", "never", "don't", "said", "the", "house", "of", ",", ","]
    for _ in range(3000):
        clause = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))
        expected = read_plainly(clause)
        assert used(clause) == ([expected] if expected else []), clause


def test_time_grows_with_the_text():
    def taken(n):
        text = "you idiot. " * n
        begin = time.perf_counter()
        clause_arcs(text, PLAIN.insults)
        return time.perf_counter() - begin

    taken(1000)
    assert taken(80_000) < 12 * taken(10_000)


def test_scores_order_and_bounds():
    values = [score_of(t, PLAIN) for t in ("good day", "he is not an idiot", "an idiot", "you idiot")]
    assert values == sorted(values) and 0 < values[0] < 0.3 < values[-1] < 1
    assert score_of(None, PLAIN) == score_of("", PLAIN) == values[0]
    long = "fine words here. " * 20000 + "you idiot"
    assert score_of(long, PLAIN) == score_of("you idiot", PLAIN)


def _docs(n=400):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choices("aeioulmnrst", k=3)) for _ in range(60)]
        toxic = k % 4 == 0
        if toxic:
            words[rng.randrange(60)] = "zorbel" + "abcdef"[rng.randrange(6)]
        rows.append((k, " ".join(words), "x"))
        labels.append((k, int(toxic)))
    return rows, labels


def test_learns_stems_and_scores_held_out_rows(spark):
    ship(spark)
    rows, labels = _docs()
    copied = [(1000 + k, "quaint copied phrase only here you see", "x") for k in range(40)]
    docs = spark.createDataFrame([*rows, *copied, (None, None, "x")], "doc_id long, text string, score string")
    known = spark.createDataFrame([*labels, *((1000 + k, 1) for k in range(40)), (5, None), (None, 1)], "doc_id long, toxic int")
    grammar = toxicity.learn(docs, toxicity.learning_fold(known))
    assert "zorbel" in grammar.insults
    assert not any(p.startswith(("copied", "quaint")) for p in grammar.insults)
    got = {r["doc_id"]: r for r in toxicity.scored(docs, grammar).collect()}
    assert len(got) == len(rows) + 41
    assert all(got[k]["predicted"] == t for k, t in labels)


def test_without_labels_and_rows(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "you idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    grammar = toxicity.learn(docs, none)
    assert toxicity.scored(docs, grammar).first()["predicted"] == 1
    assert toxicity.scored(docs.limit(0), grammar).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_accuracy(spark):
    ship(spark)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.scored(docs, toxicity.learn(docs, toxicity.learning_fold(labels))).join(labels, "doc_id").filter("held_out")
    rows = got.select("toxic", "predicted").collect()
    assert sum(r[0] == r[1] for r in rows) / len(rows) > 0.9
