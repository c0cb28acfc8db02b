"""The faster forms of steps of the network give the same bits as the plain ones."""

import numpy as np

from corpusloom.llm import pseudo_likelihood as pl


def test_largest_of_rows_equals_max():
    draw = np.random.default_rng(0)
    for width in (1, 2, 3, 6, 64):
        scores = draw.normal(size=(50, width)).astype("float32")
        kept = scores.copy()
        assert np.array_equal(pl._largest(scores), scores.max(axis=1, keepdims=True)) and np.array_equal(scores, kept)


def test_adam_in_place_equals_the_formula():
    draw = np.random.default_rng(1)
    padded, at, _ = pl.padded_texts([draw.integers(1, pl.CLASSES, 300).astype("<u2").tobytes() for _ in range(4)])
    counts = np.bincount(padded, minlength=pl.CLASSES).astype(float)
    learner, plain = pl.Adam(pl.Network.fresh(counts)), pl.Network.fresh(counts)
    mean, square = ([np.zeros_like(p) for p in plain.parts()] for _ in range(2))
    for step in range(1, 4):
        learner.learn(padded, at)
        rate = pl.RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for p, m, s, g in zip(plain.parts(), mean, square, plain.gradient(padded, at), strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * m / (np.sqrt(s) + 1e-8)
    assert np.array_equal(learner.network.flat(), plain.flat())
