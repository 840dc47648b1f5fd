"""Codes, errors and codebooks against plain Python integers; who moves between rounds; edge cases."""

from __future__ import annotations

import hashlib
import math
import random

from feedmart.llm import vector_codes as vc

KIND = "vec_id long, embedding array<float>, label int, code string, id int, vector string, error long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1, "y", 2) for i, v, lab in rows], KIND)


def brute(spark, rows, entries=vc.ENTRIES):
    """The contract in loops. Components come back from Spark first, as floats of 32 bits."""
    seen = frame(spark, rows).select("vec_id", "embedding", "label").collect()
    kept = [r for r in seen if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    width = -(-max(len(r[1]) for r in kept) // 4)
    whole = [[math.floor(1024 * x) for x in r[1]] + [0] * (4 * width - len(r[1])) for r in kept]
    parts = [[w[p * width : (p + 1) * width] for w in whole] for p in range(4)]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[list(parts[p][k]) for k in order] for p in range(4)]

    def assign(p):
        def far(x, e):
            return sum((a - b) ** 2 for a, b in zip(x, e, strict=True))

        best = []
        for x in parts[p]:
            d = [far(x, e) for e in books[p]]
            best.append((d.index(min(d)), min(d)))
        return best

    for _ in range(4):
        for p in range(4):
            at = assign(p)
            for e in range(len(books[p])):
                own = [x for x, (k, _) in zip(parts[p], at, strict=True) if k == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = [assign(p) for p in range(4)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = (1 << 63) - 1
    errors = [min(sum(last[p][k][1] for p in range(4)), most) for k in range(len(kept))]
    total = {}
    for r, e in zip(kept, errors, strict=True):
        total[r[2]] = total.get(r[2], 0) + e
    return [
        (r[0], "".join(f"{last[p][k][0]:02x}" for p in range(4)), errors[k], min(total[r[2]], most), digest) for k, r in enumerate(kept)
    ]


def check(spark, rows):
    got = vc.compress(frame(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(spark, rows), key=repr)


def vectors(n, d=12, seed=5):
    rng = random.Random(seed)
    return [(k, [rng.uniform(-1, 1) for _ in range(d)], rng.choice([1, 2, None])) for k in range(n)]


def test_many_vectors(spark):
    check(spark, vectors(700))


def test_one_vector_holds_a_third(spark):
    rows = vectors(500)
    check(spark, rows + [(1000 + k, rows[7][1], 1) for k in range(260)])


def test_dropped_and_odd_vectors(spark):
    rows = vectors(300)
    odd = [None, [], [None] * 12, [math.nan] * 12, [math.inf] + [0.0] * 11, [-math.inf] * 12, [0.5] * 7, [0.25] * 13]
    check(spark, rows + [(900 + k, v, k) for k, v in enumerate(odd)])


def test_fewer_vectors_than_entries_and_repeats(spark):
    rows = vectors(9) + [(3, [0.5] * 12, 1), (3, [0.5] * 12, 1), (None, [0.1] * 12, None), (None, [0.1] * 12, None)]
    check(spark, rows)


def test_huge_components_stay_exact(spark):
    big = [(500 + k, [3e38 if k % 2 else -1e30] + [float(k)] * 11, 1) for k in range(6)]
    check(spark, vectors(280) + big + [(600, [70000.0] * 12, 2), (601, [-70001.5] * 12, 2)])


def test_ties_go_to_the_lower_entry(spark):
    check(spark, [(k, [k % 2 / 1024.0] * 4, 0) for k in range(40)] + [(99, [0.0] * 4, 0)])


def test_empty_tables(spark):
    check(spark, [])
    check(spark, [(1, None, 2), (2, [None], 2)])
    check(spark, [(1, [], 2), (2, [], None)])


def test_only_parts_that_change_entry_move(spark):
    rows = frame(spark, vectors(900))
    slim = rows.selectExpr("vec_id AS id", "label", "embedding AS vector")
    _, moved = vc.learnt(slim, 3)
    assert len(moved) == 3 and moved[0] > moved[-1] > 0 and max(moved) < 4 * 900


def test_residents_are_joined_without_a_shuffle(spark):
    slim = frame(spark, vectors(300)).selectExpr("vec_id AS id", "label", "embedding AS vector")
    books = vc.first_books(slim, 3)
    placed = vc._placed(slim, books, 3, 4).partitionBy(4, vc._owner)
    assigned = placed.mapPartitions(vc._reassigned(books, 4), preservesPartitioning=True)
    assert vc.resident(assigned).getNumPartitions() == 4  # a plain union would have eight


def test_result_does_not_follow_the_partitions(spark):
    rows = frame(spark, vectors(400))
    once, again = (sorted(map(tuple, vc.compress(rows.repartition(n)).collect())) for n in (1, 7))
    assert once == again
