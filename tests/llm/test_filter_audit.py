"""Every order replayed document by document; fields that do not run over; edge cases."""

from __future__ import annotations

import random
import re
from collections import defaultdict

from feedmart.llm import filter_audit as fa

DOCS = "doc_id long, text string, lang string, part string, mask int, good boolean, id string"
LABELS = "doc_id long, quality int, toxic int, good string"


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(*d, "p", 9, True, "i") for d in docs], DOCS),
        spark.createDataFrame([(*x, "g") for x in labels], LABELS),
    )


def brute(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = {x[0] for x in labels if x[1] == 1 and x[0] is not None}, {x[0] for x in labels if x[2] == 1 and x[0] is not None}
    parts = defaultdict(list)
    for i, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > least[t],
        }
        parts[lang or ""].append((fails, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        shapley = defaultdict(int)
        lines = []
        for order in fa.ORDERS:
            at = [next((k for k, f in enumerate(order) if fails[f]), 9) for fails, _, _ in rows]
            for k, f in enumerate(order):
                gone = [r for r, a in zip(rows, at, strict=True) if a == k]
                shapley[f] += len(gone)
                lines.append(
                    (part, order, k + 1, sum(a > k for a in at), len(gone), sum(r[0][f] and a < k for r, a in zip(rows, at, strict=True)),
                     sum(r[0][f] and sum(r[0].values()) == 1 for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone))
                )
        out += [(*line, shapley[line[1][line[2] - 1]]) for line in lines]
    return out


def check(spark, docs, labels):
    got = fa.audit(*frames(spark, docs, labels))
    assert got.columns == [c.split()[0] for c in fa.SCHEMA.split(", ")]
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, labels))


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    docs = []
    for k in range(n):
        words = [rng.choice("abcdefghij") + str(rng.randrange(2000)) for _ in range(rng.choice([20, 99, 100, 101, 140]))]
        if rng.random() < 0.3:
            words = words[:20] * 6
        text = rng.choice([" ", "\n", " \t\x0b"]).join(words)
        text = text.upper() if rng.random() < 0.2 else text + rng.choice(["", "", "#", "|"])
        docs.append((k, text, rng.choice(["en", "de", None, ""])))
    docs += [(n + k, docs[rng.randrange(40)][1], rng.choice(["en", "fr"])) for k in range(n // 3)]
    labels = [(rng.randrange(n + 50), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(n // 2)]
    return docs, labels


def test_all_orders(spark):
    check(spark, *corpus())


def test_one_text_holds_a_third(spark):
    docs, labels = corpus(200)
    check(spark, docs + [(5000 - k, "HOT text", "en" if k % 2 else "de") for k in range(150)], labels)


def test_nulls_repeats_and_long_texts(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    docs = [(None, None, None), (None, "", None), (4, None, None), (4, "", "en"), (4, "", "en"), (3, "x", "en"), (9, "x", "de")]
    docs += [(9, "x", "de"), (None, "x", "de"), (7, long, "en"), (8, long, "en"), (8, long + " É $", "en")]
    check(spark, docs, [(4, 1, 1), (4, 0, 0), (9, 1, None), (None, 1, 1), (8, None, 1)])


def test_empty_tables(spark):
    check(spark, [], [])
    check(spark, [(1, "a", "en")], [])


def test_fields_hold_any_count(spark):
    many = (1 << 62) + 12345
    removed, n = fa.unpacked(many * fa.packed(0b10010) + 7 * fa.packed(0))
    assert n == many + 7
    for k, order in enumerate(fa.ORDERS):
        first = min(order.index("B"), order.index("E"))
        assert [int(x) for x in removed[k]] == [many if s == first else 0 for s in range(5)]
