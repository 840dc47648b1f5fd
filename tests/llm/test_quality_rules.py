"""The cascade's verdict is that of all rules, whatever their order; edge cases."""

from __future__ import annotations

import itertools
import re

import pytest

from feedmart.llm import quality_rules as rules

PLAIN = " ".join(f"word{k} stands{k % 5}" for k in range(40))
TEXTS = [
    None,
    "",
    " \t\n ",
    "too few words",
    PLAIN,
    PLAIN,
    PLAIN + " # $ %" * 20,
    PLAIN.upper(),
    "\n".join(["a line that comes again and again"] * 30),
    "x" * 40 + (" " + "y" * 30) * 60,
    "one two three " * 40,
    PLAIN + "!" * 90,
    PLAIN + " é   ünïcode 漢字 😀",
    PLAIN * 500,
]


def by_hand(text):
    """The counts, written anew from their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    repeat = set(itertools.chain.from_iterable((k, k + 1, k + 2) for k, w in enumerate(windows) if seen[w] > 1))
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in earlier
            earlier.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(repeat) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat), failed


def frame(spark, texts=TEXTS):
    # a column named like one of the results, and like one the operator might use itself
    return spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, n_words string, rule int")


def test_counts_equal_those_by_hand(spark):
    out = {r["doc_id"]: r for r in rules.counts(frame(spark)).collect()}
    assert len(out) == len(TEXTS)
    for k, text in enumerate(TEXTS):
        r = out[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == by_hand(text), k
        assert r["kept"] == (not any(rule(rules.Page(text)) for rule in rules.RULES.values()))
        assert not (r["base_failed"] and r["kept"])


def test_order_changes_no_verdict(spark):
    docs = frame(spark)
    names = list(rules.RULES)
    verdicts = []
    for order in (names, names[::-1], names[4:] + names[:4]):
        found = docs.select("doc_id", rules.first_failed(docs["text"], order).isNull().alias("kept"))
        verdicts.append(sorted(map(tuple, found.collect())))
    assert verdicts[0] == verdicts[1] == verdicts[2]


def test_rules_run_by_rejections_per_second():
    made = {"dear": lambda p: True, "cheap": lambda p: True, "idle": lambda p: False, "new": lambda p: False}
    estimates = [("dear", 1.0, 0.9), ("cheap", 0.01, 0.1), ("idle", 0.001, 0.0)]
    assert rules.ordered(estimates, made) == ["cheap", "dear", "idle", "new"]


def test_a_rejected_text_runs_no_further_rule():
    page = rules.Page("few words")
    assert next(name for name in rules.RULES if rules.RULES[name](page)) == "few_words"
    assert "n_repeat_words" not in vars(page)


def test_kept_passes_columns_through(spark):
    docs = frame(spark)
    out = rules.kept(docs)
    assert out.schema == docs.schema
    assert {4, 5, 13} & {r["doc_id"] for r in out.collect()} == {4, 5}


@pytest.mark.parametrize("make", [rules.kept, rules.counts])
def test_empty_table(spark, make):
    assert make(frame(spark).filter("false")).count() == 0
