"""The network's gradient against differences, its lanes, and that probabilities add up."""

from __future__ import annotations

import numpy as np

from feedmart.llm import gru


def model(members=4):
    return gru.start(7, 5, 6, 3, members, np.array([5.0, 3, 2, 2, 1, 1]), np.array([[3.0] * members, [2.0] * members, [1.0] * (members - 1) + [0]]))


def some(rng, n):
    classes = rng.integers(0, 6, n)
    members = np.where(classes < 3, rng.integers(0, 3, n), -1)
    return np.stack([rng.integers(0, 7, n), classes, members], axis=1)


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in model().items()}
    for v in p.values():
        v += rng.standard_normal(v.shape) * 0.3 * (v > -100)
    tokens = np.stack([some(rng, 6) for _ in range(3)], axis=1)
    keep = np.ones((6, 3))
    keep[0], keep[3, 1] = 0, 0
    h = np.zeros((3, 5))
    old, gru.F32 = gru.F32, np.float64
    try:
        _, g, _ = gru.gradient(p, tokens, keep, h)
        for k, v in p.items():
            for i in rng.choice(v.size, min(v.size, 8), replace=False):
                place = np.unravel_index(i, v.shape)
                was, e = v[place], 1e-5
                v[place] = was + e
                up = gru.gradient(p, tokens, keep, h)[0]
                v[place] = was - e
                down = gru.gradient(p, tokens, keep, h)[0]
                v[place] = was
                assert abs((up - down) / (2 * e) - g[k][place]) < 1e-4, k
    finally:
        gru.F32 = old


def test_scores_do_not_depend_on_lanes_and_windows():
    rng = np.random.default_rng(4)
    p, texts = model(), [some(rng, n) for n in (1, 9, 40, 3, 17, 1)]
    one = [gru.scores(p, [t], 1, 1000)[0] for t in texts]
    for n_lanes, steps in ((1, 4), (2, 3), (8, 32)):
        assert np.allclose(gru.scores(p, texts, n_lanes, steps), one, atol=1e-4)


def test_probabilities_add_up_to_one():
    p, h = model(), np.random.default_rng(5).standard_normal((1, 5)).astype(np.float32)
    total = 0.0
    for c in range(6):
        for m in range(4) if c < 3 else [-1]:
            total += float(np.exp(gru.log_probs(p, h, np.array([c]), np.array([m]))[0]))
    assert abs(total - 1) < 1e-5


def test_training_learns_a_pattern():
    text = np.array([[6, 0, 0], *([[1, 3, -1], [2, 1, 1], [3, 0, 2]] * 40)])
    p = model()
    trained, seen = gru.train(p, [text] * 64, rate=0.02)
    assert seen == 64 * len(text)
    assert gru.scores(trained, [text])[0] > 0.5 * gru.scores(p, [text])[0]


def test_even_windows_hold_every_token_once():
    rng = np.random.default_rng(9)
    for sizes in ((1,), (5, 1, 30), (100, 3, 3, 77, 1), (700,)):
        texts = [some(rng, n) for n in sizes]
        for n_lanes, steps in ((1, 4), (8, 3), (128, 16)):
            got = [tokens.reshape(-1, 3) for tokens, _, _ in gru.even_windows(texts, n_lanes, steps)]
            assert sorted(map(tuple, np.concatenate(got))) == sorted(map(tuple, np.concatenate(texts)))
            begins = sum(int((keep == 0).sum()) for _, keep, _ in gru.even_windows(texts, n_lanes, steps))
            assert begins == len(texts)
