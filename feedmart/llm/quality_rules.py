"""Quality rules as a short-circuit cascade.

A text is kept if no rule rejects it, so the order of the rules changes the time and never the
verdict. Each rule's cost and the share it rejects are measured on a sample, on the executors, and the
rules then run by rejections per second: cheap rules that reject much come first, and a rejected text
runs no further rule.

Defined results: a null text counts as empty and has no words, so the rule on few words rejects it.
Repeated rows are judged one by one and alike. An empty table gives an empty result. Other columns pass
through untouched.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import texts, words_of

# Characters that count as symbols, and the white space between words.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

#: Rows, about, that costs and selectivity are estimated on. They decide the order only.
SAMPLE_ROWS = 1000


class Page:
    """A text with the counts that rules ask for, each counted once and only when asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return words_of(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - (len(self.raw) - len(self.raw.translate(None, SPACES)))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside three-word windows that occur twice or more, each word once."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        seen, covered = Counter(windows), bytearray(len(w))
        for k, window in enumerate(windows):
            if seen[window] > 1:
                covered[k : k + 3] = b"\1\1\1"
        return sum(covered)

    @cached_property
    def letters(self) -> tuple[int, int]:
        """A-Z and a-z."""
        upper = len(self.raw) - len(self.raw.translate(None, bytes(range(65, 91))))
        return upper, len(self.raw) - len(self.raw.translate(None, bytes(range(97, 123))))

    @cached_property
    def most_frequent(self) -> int:
        return max(Counter(self.words).values(), default=0)


Rule = Callable[[Page], bool]

#: The rules every text of the mix has to pass. True rejects.
BASE: dict[str, Rule] = {
    "few_words": lambda p: p.n_words < 50,
    "repeated_words": lambda p: 100 * p.n_repeat_words > 50 * p.n_words,
}

#: Further rules of this cascade.
FURTHER: dict[str, Rule] = {
    "symbols": lambda p: 100 * p.n_symbols > 20 * p.n_words,
    "exclamations": lambda p: 100 * p.raw.count(b"!") > 50 * p.n_words,
    "shouting": lambda p: 100 * p.letters[0] > 60 * sum(p.letters),
    "long_words": lambda p: p.word_chars > 15 * p.n_words,
    "short_words": lambda p: 10 * p.word_chars < 25 * p.n_words,
    "repeated_lines": lambda p: 100 * p.n_dup_lines > 50 * len(p.lines),
    "one_word": lambda p: 100 * p.most_frequent > 40 * p.n_words,
}

RULES = BASE | FURTHER


def measured(docs: DataFrame, rules: dict[str, Rule] = RULES, text_col: str = "text") -> list[tuple[str, float, float]]:
    """(rule, mean seconds, share rejected) on a sample. Each rule starts from the bare text.

    Texts are measured where they are read; only sums per task and rule move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, hits, n = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0
        for batch in batches:
            for text in texts(batch.column(0)):
                n += 1
                for name, rule in rules.items():
                    page, begin = Page(text), time.perf_counter()
                    hits[name] += rule(page)
                    spent[name] += time.perf_counter() - begin
        yield pa.RecordBatch.from_pydict(
            {"rule": list(rules), "spent": list(spent.values()), "hits": list(hits.values()), "n": [n] * len(rules)}
        )

    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    sample = docs.select(F.col(text_col).alias("text")).sample(share, seed=7)
    rows = (
        sample.mapInArrow(run, "rule string, spent double, hits long, n long")
        .groupBy("rule")
        .agg(F.sum("spent").alias("spent"), F.sum("hits").alias("hits"), F.sum("n").alias("n"))
        .collect()  # one row per rule
    )
    return [(r["rule"], r["spent"] / max(r["n"], 1), r["hits"] / max(r["n"], 1)) for r in rows]


def ordered(estimates: list[tuple[str, float, float]], rules: dict[str, Rule] = RULES) -> list[str]:
    """Rule names by rejections per second; rules without an estimate follow in their own order."""
    rate = {name: share / max(cost, 1e-9) for name, cost, share in estimates}
    place = list(rules)
    return sorted(rules, key=lambda name: (-rate.get(name, 0.0), place.index(name)))


def first_failed(text: Column, order: list[str], rules: dict[str, Rule] = RULES) -> Column:
    """The first rule in ``order`` that rejects the text, null if none does."""
    cascade = [(name, rules[name]) for name in order]

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        def judge(text: str | None) -> str | None:
            page = Page(text)
            return next((name for name, rejects in cascade if rejects(page)), None)

        return column.map(judge, na_action=None).astype(object)

    return run(F.coalesce(text, F.lit("")))


def kept(docs: DataFrame, rules: dict[str, Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the columns they had."""
    order = ordered(measured(docs, rules, text_col), rules)
    return docs.filter(first_failed(F.col(text_col), order, rules).isNull())


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the counts of its whole text, whether a base rule rejects it, and the cascade's verdict.

    The counts are wanted for every text, so the cascade decides here about what comes on top of them.
    """
    order = ordered(measured(docs, RULES, text_col))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    cascade = [(name, RULES[name]) for name in order]

    @F.pandas_udf(", ".join(f"{n} long" for n in names) + ", base_failed boolean, failed_rule string")
    def run(column: pd.Series) -> pd.DataFrame:
        rows = []
        for text in column:
            page = Page(text)
            failed = next((name for name, rejects in cascade if rejects(page)), None)
            rows.append((*(getattr(page, n) for n in names), any(r(page) for r in BASE.values()), failed))
        return pd.DataFrame(rows, columns=[*names, "base_failed", "failed_rule"])

    found = docs.select(F.col(id_col), run(F.coalesce(F.col(text_col), F.lit(""))).alias("_"))
    return found.select(id_col, "_.*", F.col("_.failed_rule").isNull().alias("kept"))
