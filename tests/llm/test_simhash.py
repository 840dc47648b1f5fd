"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from feedmart.llm import simhash


def brute_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, d=2):
    """{row: smallest id reachable} of rows (id, fingerprint)."""
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= d:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for r, (i, _) in zip(root, rows):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return [least[r] for r in root]


def test_fingerprint_equals_brute_force():
    rng = random.Random(3)
    texts = [None, "", " \n", "one", "Two wörds", "a\x1cb c\xa0d e", "x " * 70000]
    texts += [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(60))) for _ in range(50)]
    for t in texts:
        got = simhash.fingerprint(simhash.lower_words_of(t), 3) & (2**64 - 1)
        assert got == brute_fingerprint(t)


@pytest.mark.parametrize("crowd", [2000, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(120)) for _ in range(8)]
    texts = [None, "", "short", "short", "SHORT", "two words"]
    for b in base:
        for _ in range(9):
            w = b.split()
            for _ in range(rng.choice([0, 1, 1, 2])):
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    rows = [(k * 7 % 101, t, "fp", 0) for k, t in enumerate(texts)] + [(None, texts[10], "fp", 0), (3, texts[2], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, node int")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr)
    fps = [(i, brute_fingerprint(t)) for i, t, *_ in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_components(fps))), key=repr)
    assert got == want


@pytest.mark.parametrize("crowd", [2000, 4])
def test_links_lose_nothing(spark, monkeypatch, crowd):
    """Also where many fingerprints agree in almost all bits, and thresholds differ."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = np.random.default_rng(1)
    fps = {int(x) for x in rng.integers(-(2**63), 2**63 - 1, 60)}
    centre = int(rng.integers(0, 2**62))
    for _ in range(80):
        fps.add(simhash._signed((centre ^ sum(1 << int(b) for b in rng.integers(0, 12, 4))) & (2**64 - 1)))
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    for d in (1, 2, 3):
        got = {tuple(r) for r in simhash.links(nodes, d).collect()}
        want = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= d}
        assert got == want


def test_thresholds_keep_the_pigeonhole():
    sharing = np.array([[1, 1, 1, 1], [5000, 1, 1, 1], [9e9, 9e9, 1, 1]], float)
    out = simhash.allotted(sharing, [16] * 4, 2, 10**6)
    assert ((out + 1).sum(axis=1) == 3).all()
    assert out[1, 0] == -1 and out[2, 0] == -1 and out[2, 1] == -1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
