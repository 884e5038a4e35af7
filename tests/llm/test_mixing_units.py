"""Posteriors on the grid are without a one-sided error, small ones included."""

from __future__ import annotations

import numpy as np

from chatloom.llm import mixing


def test_units_keep_small_posteriors():
    own = mixing.Classifier(["a", "b", "c"])
    own.bias = np.log([0.985, 0.01, 0.005])  # both small ones lie under 1 / GRID
    own.weights = np.zeros((0, 3))
    texts = [f"text {i}" for i in range(20_000)]
    tokens, units, p = own.posteriors(texts)
    assert (units >= 0).all() and (units.sum(axis=1) == mixing.GRID).all() and (np.abs(units / mixing.GRID - p) < 2 / mixing.GRID).all()
    assert np.allclose(units.mean(axis=0) / mixing.GRID, p[0], atol=5e-4)
