"""License scan against a plain Python version of the same rules."""

from __future__ import annotations

import re

from feedmart.llm import license_scan
from feedmart.llm.license_rules import TRIGGERS, rules

TEXTS = [
    None,
    "",
    "...  ---",
    "Released under the MIT License.",
    "mit license mit license",
    "permitlicense and emit license",
    "This work is licensed under the GNU General Public License, version 3. See the MIT-License",
    "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.",
    "SPDX-License-Identifier: Apache-2.0\n// Copyright (c) 2021 Somebody. All rights reserved.",
    "GNU Lesser General Public License v2.1 and gnu gpl v2",
    "café licence MIT License",
    "https://creativecommons.org/licenses/by-sa/4.0/ and https://www.apache.org/licenses/LICENSE-2.0.txt",
    "line under the mit license " * 300,
    "KİK apache LICENSE x " + "word " * 5000 + "cc by",
]


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    norm, found = " " + " ".join(words) + " ", []
    if any(t in norm for t in TRIGGERS):
        for r in rules():
            if r.keyword in norm:
                for m in re.finditer(f"(?<= )(?:{r.regex})(?= )", norm):
                    found.append((m.start(), m.end(), r.priority, r.label, r.score))
    stay = [
        h
        for h in found
        if not any(
            g[0] <= h[0] and g[1] >= h[1] and ((g[0], g[1]) != (h[0], h[1]) or g[2] < h[2]) for g in found
        )
    ]
    score = max([license_scan.BASE_SCORE if places else 0.0, *(h[4] for h in stay)])
    every = labels | {h[3] for h in stay}
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(labels)), ",".join(sorted(every)), score, len(stay),
    )


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)], "doc_id long, text string, _words string")
    got = {r[0]: tuple(r[1:]) for r in license_scan.scan(docs).collect()}
    assert got == {k: brute(t) for k, t in enumerate(TEXTS)}


def test_every_rule_has_a_trigger_in_its_matches():
    samples = {
        "licensed under the zlib license": "zlib",
        "spdx license identifier mit": "mit",
        "this is free and unencumbered software released into the public domain": "unlicense",
    }
    for text, label in samples.items():
        assert label in brute(text)[5].split(",")
    assert len(rules()) > 200


def spelled(tree):
    """Texts that a rule's regex matches, with each choice taken and each option left out and taken."""
    texts = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            more = [chr(arg)]
        elif name == "NOT_LITERAL":
            more = ["x"]
        elif name == "IN":
            more = [spelled_set(arg)]
        elif name == "MAX_REPEAT":
            low, high, inner = arg
            one = spelled(inner)
            more = ["" for _ in range(low == 0)] + [t * max(low, 1) for t in one]
        elif name == "SUBPATTERN":
            more = spelled(arg[-1])
        elif name == "BRANCH":
            more = [t for branch in arg[1] for t in spelled(branch)]
        else:
            raise ValueError(name)
        texts = [a + b for a in texts for b in more]
    return texts


def spelled_set(choices):
    op, arg = choices[0]
    return {"LITERAL": lambda: chr(arg), "RANGE": lambda: chr(arg[0]), "CATEGORY": lambda: "7", "NEGATE": lambda: "x"}[str(op)]()


def test_every_way_to_match_holds_the_keyword_and_a_trigger():
    for rule in rules():
        for text in spelled(re._parser.parse(rule.regex)):
            assert re.fullmatch(rule.regex, text), (rule, text)
            assert rule.keyword in text, (rule, text)
            assert any(t in text for t in TRIGGERS), (rule, text)


def test_words_elsewhere_do_not_matter(spark):
    title = "creative commons attribution share alike license"
    docs = spark.createDataFrame([(1, title), (2, title + " same by once")], "doc_id long, text string")
    assert {r["labels"] for r in license_scan.scan(docs).collect()} == {"cc-by-sa"}


def test_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None, "mit license"), (None, "cc by"), (1, None)], "doc_id long, text string")
    assert sorted(r["labels"] for r in license_scan.scan(docs).collect()) == ["", "cc-by", "mit"]


def test_longer_match_suppresses_the_name_within(spark):
    docs = spark.createDataFrame([(1, "under the Mozilla Public License 2.0 now")], "doc_id long, text string")
    assert license_scan.scan(docs).first()["labels"] == "mpl-2.0"


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "mit license"), (1, "mit license")], "doc_id long, text string")
    assert [r["n_base"] for r in license_scan.scan(docs).collect()] == [1, 1]
    assert license_scan.scan(docs.limit(0)).count() == 0
