"""Toxicity by a weighted finite-state grammar over clauses.

Words are mapped to classes (insult, threat, target, negation, report, other) by a lexical transducer.
Four small weighted automata read the classes of a clause: one marks what a negation governs, one what
reported speech governs, one pairs insults with the person they aim at, and one pairs threats with their
target. Their product is one table, built once; running it over a clause gives the arcs the clause
used. A document's score is the logistic of what its clauses' arcs add up to, the strongest clause
counting in full and each further one half as much as the one before. Words alone score nothing: a
threat needs a target, and an insult under negation or in reported speech weighs less.

Labels give two things: insult stems the word lists lack, and the weights of the arcs. A stem is a
word or prefix that occurs after many different words, nearly always in toxic texts; counting different
words before it, and not texts, keeps the words of a toxic text that was copied often from counting as
evidence. It also has to occur in many texts: one text repeats its own words. Both are learnt from a sample of at most ``TRAIN_ROWS`` labelled rows.

Defined results: null and empty texts get the score of a text without any matched clause; rows without
an id are scored, held out and never learnt from; repeated rows are scored alike; without labels the word lists and
default weights decide; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm import toxicity_lexicon as lexicon
from feedmart.llm.common import crc_bucket, landed

#: Labelled rows that stems and weights are learnt from: at most so many, by the order of a hash.
TRAIN_ROWS = 20_000
#: A stem needs so many different words before it and so many toxic texts, and such a share of both toxic.
MIN_SUPPORT, MIN_SHARE = 8, 0.85
#: Stems taken at most, those with the most evidence first.
MAX_STEMS = 2_000
STEM_LENGTHS = (4, 12)
#: Words a negation governs.
REACH = 3

# a word, a contraction with "not", or the comma that ends what a negation governs
_WORD = re.compile(r"[^\W\d_]*n['’]t(?![^\W\d_])|[^\W\d_]+|,")
_CLAUSE_END = re.compile(r"[.!?;:\n]")
ARCS = ["insult", "negated", "reported", "targeted", "threat"]
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, COMMA = range(7)


@dataclass(frozen=True)
class Grammar:
    """Patterns that end in ``$`` are whole words, others begin a word."""

    insults: tuple[str, ...] = tuple(f"{w}$" for w in lexicon.INSULTS)
    weights: tuple[tuple[str, float], ...] = field(default=tuple(lexicon.DEFAULT.items()))


# --- the automata: (start, {(state, class): (next state, arcs used)}) -------------------------------


def _negation() -> tuple:
    """How many words the last negation still governs. A comma ends it: "No, I will ..." """
    step = {}
    for left in range(REACH + 1):
        for c in range(7):
            governed = ("neg",) if left and c in (INSULT, THREAT) else ()
            step[left, c] = (REACH, ()) if c == NEGATION else (0, ()) if c == COMMA else (max(left - 1, 0), governed)
    return 0, step


def _report() -> tuple:
    """Reported speech lasts to the end of the clause."""
    step = {}
    for on in (0, 1):
        for c in range(7):
            step[on, c] = (1 if c == REPORT else on, ("rep",) if on and c == INSULT else ())
    return 0, step


def _aim() -> tuple:
    """An insult and a person in one clause, in either order, once."""
    # 0 nothing, 1 person seen, 2 insult seen, 3 both
    step = {}
    for s in range(4):
        for c in range(7):
            nxt = {TARGET: {0: 1, 2: 3}, INSULT: {0: 2, 1: 3}}.get(c, {}).get(s, s)
            step[s, c] = (nxt, ("targeted",) if nxt == 3 and s != 3 else ())
    return 0, step


def _threat() -> tuple:
    """A threat and a person in one clause, in either order. Threats under a negation do not reach it."""
    # 0 nothing, 1 person seen, 2 threat seen, 3 both
    step = {}
    for s in range(4):
        for c in range(7):
            nxt = {TARGET: {0: 1, 2: 3}, THREAT: {0: 2, 1: 3}}.get(c, {}).get(s, s)
            step[s, c] = (nxt, ("threat",) if nxt == 3 and s != 3 else ())
    return 0, step


@lru_cache(maxsize=1)
def composed() -> tuple[np.ndarray, list[list[tuple[int, ...]]]]:
    """The product of the automata: next states and the arcs (places in ``ARCS``) by state and class."""
    machines = [_negation(), _report(), _aim(), _threat()]
    start = tuple(m[0] for m in machines)
    states, queue, nxt, arcs = {start: 0}, [start], [], []
    for state in queue:
        row, used = [], []
        for c in range(7):
            governed = "neg" in machines[0][1][state[0], c][1]
            # the negation's output is what the threat automaton reads
            read = [c, c, c, OTHER if governed and c == THREAT else c]
            moves = [step[s, x] for s, x, (_, step) in zip(state, read, machines, strict=True)]
            to = tuple(m[0] for m in moves)
            if to not in states:
                states[to] = len(states)
                queue.append(to)
            marks = list(itertools.chain(*(m[1] for m in moves)))
            if c == INSULT:
                marks.append("negated" if "neg" in marks else "reported" if "rep" in marks else "insult")
            row.append(states[to])
            used.append(tuple(ARCS.index(m) for m in marks if m in ARCS))
        nxt.append(row)
        arcs.append(used)
    return np.array(nxt), arcs


# --- reading a text ---------------------------------------------------------------------------------


@lru_cache(maxsize=4)
def _machine(insults: tuple[str, ...]):
    found = ahocorasick.Automaton()
    patterns = [(p, INSULT) for p in insults] + [(f"{w}$", THREAT) for w in lexicon.THREATS]
    for pattern, _ in patterns:
        found.add_word(pattern.rstrip("$"), len(pattern.rstrip("$")))
    found.make_automaton()
    classes = {w: c for ws, c in ((lexicon.TARGETS, TARGET), (lexicon.NEGATIONS, NEGATION), (lexicon.REPORTS, REPORT), (lexicon.THREATS, THREAT)) for w in ws}
    whole = {p[:-1] for p in insults if p.endswith("$")}
    stems = tuple(p for p in insults if not p.endswith("$"))
    return found, classes, whole, stems


def _class_of(word: str, classes: dict[str, int], whole: set[str], stems: tuple[str, ...]) -> int:
    if word == ",":
        return COMMA
    if word.endswith(("n't", "n’t")):
        return NEGATION
    if word in whole or word.startswith(stems):
        return INSULT
    return classes.get(word, OTHER)


def clause_arcs(text: str | None, insults: tuple[str, ...]) -> list[tuple[str, tuple[int, ...]]]:
    """(clause, uses of each arc) for the clauses that use one. Only clauses around a hit are read."""
    low = (text or "").lower()
    found, classes, whole, stems = _machine(insults)
    nxt, arcs = composed()
    done, out = -1, []
    for end, length in found.iter(low):
        begin = end - length + 1
        if begin <= done or begin and low[begin - 1].isalpha():
            continue  # inside a clause that was read, or inside a word
        ends = [low.rfind(mark, max(done, 0), begin) for mark in ".!?;:\n"]  # the clause before ended at done
        start = max(*ends, done) + 1
        stop = _CLAUSE_END.search(low, end + 1)
        done = stop.start() if stop else len(low)
        uses, state = [0] * len(ARCS), 0
        for m in _WORD.finditer(low, start, done):
            c = _class_of(m[0], classes, whole, stems)
            for a in arcs[state][c]:
                uses[a] += 1
            state = nxt[state, c]
        if any(uses):
            out.append((low[start:done], tuple(uses)))
    return out


def features(text: str | None, insults: tuple[str, ...]) -> np.ndarray:
    """Uses of each arc: of the clause that uses most in full, of the next half, and so on."""
    uses = sorted((u for _, u in clause_arcs(text, insults)), key=lambda u: (-sum(u), u))
    total = np.zeros(len(ARCS))
    for k, u in enumerate(uses[:20]):  # the share of the 20th is below a millionth
        total += np.minimum(u, 3) * 0.5**k  # a clause that repeats a word says little more the fourth time
    return total


def score_of(text: str | None, grammar: Grammar) -> float:
    w = dict(grammar.weights)
    z = w["bias"] + float(features(text, grammar.insults) @ np.array([w[a] for a in ARCS]))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def score(text: Column, grammar: Grammar) -> Column:
    """0 to 1, higher if toxic."""

    @F.pandas_udf("double")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([score_of(t, grammar) for t in column], dtype="float64")

    return run(F.coalesce(text, F.lit("")))


# --- learning ---------------------------------------------------------------------------------------


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled rows."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).select(id_col, "toxic")
    chosen = known.orderBy(F.xxhash64(id_col), id_col, "toxic").limit(rows)  # so many rows of two numbers
    ids = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return landed(ids.join(F.broadcast(chosen), id_col).select("text", F.col("toxic").cast("int").alias("toxic")), "toxic-sample")


def stems(sample: DataFrame) -> list[str]:
    """Words and prefixes that occur after many different words, nearly always in toxic texts."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _WORD.findall(text.lower())
                seen = sorted(set(zip(words, ["", *words])))
                word = [s[0] for s in seen]
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array(word, pa.string()),
                        "before": pa.array([s[1] for s in seen], pa.string()),
                        "first": pa.array([int(a != b) for a, b in zip(word, ["", *word])], pa.int64()),
                        "toxic": pa.array([toxic] * len(seen), pa.int64()),
                    }
                )

    low, high = STEM_LENGTHS
    found = sample.mapInArrow(pairs, "word string, before string, first long, toxic long")
    contexts = found.groupBy("word", "before").agg(
        F.avg("toxic").alias("share"), F.sum("first").alias("texts"), F.sum(F.col("first") * F.col("toxic")).alias("bad_texts")
    )
    words = contexts.groupBy("word").agg(
        F.count("*").alias("n"), F.count_if(F.col("share") > 0.5).alias("bad"), F.sum("texts").alias("texts"), F.sum("bad_texts").alias("bad_texts")
    )
    lengths = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda k: k <= F.length("word"))
    prefixes = F.transform(lengths, lambda k: F.col("word").substr(F.lit(1), k))
    keyed = words.withColumn("key", F.explode(F.concat(prefixes, F.array(F.concat("word", F.lit("$"))))))
    rows = (
        keyed.groupBy("key")
        .agg(*(F.sum(c).alias(c) for c in ("n", "bad", "texts", "bad_texts")))
        .filter(F.least("bad", "bad_texts") >= MIN_SUPPORT)
        .filter((F.col("bad") >= MIN_SHARE * F.col("n")) & (F.col("bad_texts") >= MIN_SHARE * F.col("texts")))
        .orderBy(F.desc("bad"), "key")
        .limit(MAX_STEMS)
        .collect()
    )
    bad = {r["key"]: r["bad"] for r in rows}
    kept: list[str] = []
    for key in sorted(bad, key=lambda k: (len(k), k)):
        if any(key.startswith(k.rstrip("$")) and (not k.endswith("$") or k == key) for k in kept):
            continue
        while longer := [k for k in bad if len(k) == len(key) + 1 and k.startswith(key) and bad[k] >= 0.98 * bad[key]]:
            key = longer[0]  # the same words: the longer form says it more exactly
            if key.endswith("$"):
                break
        kept.append(key)
    return kept


def fit(sample: DataFrame, insults: tuple[str, ...], pull: float = 2.0) -> tuple[tuple[str, float], ...]:
    """Arc weights by logistic regression that starts from, and is pulled to, the default weights."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t, insults).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"x": pa.array(x, pa.list_(pa.float64())), "y": batch.column(1).cast(pa.int64())})

    got = sample.mapInArrow(rows, "x array<double>, y long").groupBy("x", "y").count().collect()  # of at most TRAIN_ROWS rows
    prior = np.array([lexicon.DEFAULT[k] for k in ("bias", *ARCS)])
    if not got:
        return tuple(lexicon.DEFAULT.items())
    x = np.array([[1.0, *r["x"]] for r in got])
    y, n = np.array([r["y"] for r in got], float), np.array([r["count"] for r in got], float)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - pull * (w - prior)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), slope)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    w[1:] = np.maximum(w[1:], 0)  # an arc never speaks for a text
    return tuple(zip(("bias", *ARCS), map(float, w)))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Grammar:
    """The grammar with stems and weights from the labelled rows given."""
    sample = _sample(docs, labels, id_col, text_col, rows)
    insults = tuple(dict.fromkeys([*Grammar().insults, *stems(sample)]))
    return Grammar(insults, fit(sample, insults))


def learning_fold(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labels that may be learnt from: those whose id does not fall into fold 2 of 4."""
    return labels.filter(crc_bucket(F.col(id_col), 4) != 2)


def scored(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row: held_out, score, predicted."""
    found = docs.select(
        F.col(id_col),
        F.coalesce(crc_bucket(F.col(id_col), 4) == 2, F.lit(True)).alias("held_out"),
        score(F.col(text_col), grammar).alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
