"""Marginals of chains cut into stretches, against all labellings; very many lines."""

from __future__ import annotations

import itertools
import time

import numpy as np
import pytest

from prodlake.llm import quality
from prodlake.llm.quality import marginals


@pytest.mark.parametrize("stretch", [1, 2, 3, 256])
def test_marginals_against_all_labellings(monkeypatch, stretch):
    monkeypatch.setattr(quality, "STRETCH", stretch)
    rng = np.random.default_rng(stretch)
    for _ in range(20):
        lengths = rng.integers(1, 9, size=int(rng.integers(1, 5)))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        emit, turns, mass = rng.normal(size=bounds[-1]) * 2, rng.normal(size=(2, 2)), rng.random(len(lengths))
        good, pair, total = np.zeros(bounds[-1]), np.zeros((2, 2)), 0.0
        for c, (a, e) in enumerate(itertools.pairwise(bounds)):
            weights, labels = [], list(itertools.product((0, 1), repeat=e - a))
            for y in labels:
                weights.append(np.exp(sum(emit[a + k] for k in range(e - a) if y[k]) + sum(turns[y[k], y[k + 1]] for k in range(e - a - 1))))
            z = sum(weights)
            total += np.log(z)
            for y, w in zip(labels, weights, strict=True):
                good[a:e] += np.array(y) * w / z
                for k in range(e - a - 1):
                    pair[y[k], y[k + 1]] += mass[c] * w / z
        got = marginals(emit, bounds, turns, mass)
        assert np.allclose(got[0], good) and np.allclose(got[1], pair) and abs(got[2] - total) < 1e-8


def test_a_chain_of_very_many_lines():
    rng = np.random.default_rng(0)
    began = time.perf_counter()
    good, pair, _ = marginals(rng.normal(size=500_000), np.array([0, 500_000]), np.array([[1.0, 0.0], [0.0, 1.0]]))
    assert time.perf_counter() - began < 20 and abs(pair.sum() - 499_999) < 1e-3 and 0 < good.min() <= good.max() < 1


def test_training_on_a_document_of_very_many_lines():
    """One document of 100,000 lines beside short ones: 120 rounds end in minutes."""
    rng = np.random.default_rng(1)
    lines = np.array([100_000, *rng.integers(1, 9, size=60)])
    bounds = np.concatenate([[0], np.cumsum(lines)])
    label = (np.arange(len(lines)) % 2).astype(int)
    values = rng.normal(size=(bounds[-1], 3)) + np.repeat(label, lines)[:, None]
    began = time.perf_counter()
    model = quality.fit(values, np.full(bounds[-1], 20), bounds, label, rounds=30)
    assert time.perf_counter() - began < 120
    raw = model.raw_scores(values, np.full(bounds[-1], 20), bounds)
    assert raw[label == 1].mean() > raw[label == 0].mean()
