"""Whitening against NumPy's eigenvectors, and its defined cases."""

from __future__ import annotations

import math

import numpy as np
import pytest

from prodlake.llm.queries import op12_whitening
from prodlake.llm.whitening import Centre, whiten

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id long, embedding array<double>, component string").repartition(3)


def expected(rows, d):
    """Integers of usable rows of one length, and what NumPy makes of the distinct ones."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit], dtype=float) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    return kept, n, sums, e, q


def check(found, rows, d, components=16):
    kept, n, sums, e, q = expected(rows, d)
    live = [k for k in range(min(components, d)) if e[k] > 1e-13 * e[0]]
    assert len(found) == len(kept) * len(live)
    assert {r["n"] for r in found} == {n}
    by = {}
    for r in found:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for i, x in kept:
        far = np.array([n * a - s for a, s in zip(x, sums, strict=True)], dtype=float) / n
        for k in live:
            got = by[i, k + 1]
            assert any(r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) and abs(abs(r["whitened"]) - abs(far @ q[:, k] / math.sqrt(e[k]))) < 1e-9 for r in got)
            assert all(abs(r["explained"] - e[k] / e.sum()) < 1e-12 and r["identity_error"] < 1e-10 for r in got)


def test_against_numpy(spark):
    draw = np.random.default_rng(3)
    mixed = draw.standard_normal((20, 20)) * np.geomspace(3, 0.2, 20)
    rows = [(k, (draw.standard_normal(20) @ mixed).tolist()) for k in range(300)]
    rows += rows[:40] + [(1000 + k, rows[7][1]) for k in range(50)] + [(2000, None), (2001, []), (2002, [NAN] * 20), (2003, [None] * 20), (2004, [INF] + [0.0] * 19), (None, rows[3][1])]
    check(whiten(frame(spark, rows)).collect(), rows, 20)


def test_few_components_stop_early(spark):
    """Falling deviations: the recurrence ends before it has gone through all dimensions."""
    draw = np.random.default_rng(5)
    rows = [(k, (draw.standard_normal(60) * 40 * 0.5 ** np.arange(60)).tolist()) for k in range(400)]
    check(whiten(frame(spark, rows), components=3).collect(), rows, 60, 3)


def test_constant_dimensions_and_low_rank(spark):
    rows = [(k, [float(k % 5), float(k % 3), 2.0, float(k % 5) * 2, 0.0]) for k in range(60)]
    check(whiten(frame(spark, rows)).collect(), rows, 5)


def test_equal_deviations(spark):
    """A cross of four points and its copies in other dimensions: every direction deviates alike, all are found."""
    d = 6
    rows = [(2 * k + (s > 0), [float(s) if j == k else 0.0 for j in range(d)]) for k in range(d) for s in (-1, 1)]
    found = whiten(frame(spark, rows)).collect()
    assert len(found) == 12 * d and max(r["identity_error"] for r in found) < 1e-9
    table = np.array([[r["whitened"] for r in sorted(found, key=lambda r: r["component"]) if r["vec_id"] == i] for i in range(12)])
    assert np.allclose(table.T @ table / 12, np.eye(d), atol=1e-9)


def test_lengths_apart_and_nothing_to_fit(spark):
    one = [(k, [1.0, 2.0]) for k in range(5)]
    assert whiten(frame(spark, one)).collect() == []
    rows = [(k, [float(k), float(k * k % 7)]) for k in range(20)] + [(100 + k, [float(k), 1.0, float(k % 3)]) for k in range(20)]
    found = whiten(frame(spark, rows)).collect()
    check([r for r in found if r["vec_id"] < 100], rows, 2)
    check([r for r in found if r["vec_id"] >= 100], rows, 3)


def test_exact_deviations_of_wide_numbers():
    sums = [10**15 + 7, -(10**14)]
    x = np.array([[1 << 50, -(1 << 49)], [5, 6], [10**6, 10**6]], dtype=np.int64)
    want = [min((1 << 63) - 1, sum((10**6 * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True))) for r in x.tolist()]
    assert Centre(10**6, sums).deviations(x).tolist() == want


def test_odd_and_empty_tables(spark, odd, empty):
    assert op12_whitening(spark, empty).collect() == []
    found = op12_whitening(spark, odd).collect()
    assert {r["vec_id"] for r in found} >= {None, 0, 259, 900, 901} and not {r["vec_id"] for r in found} & {300, 400, 500, 600, 700, 800}


@pytest.mark.parametrize("seed", range(3))
def test_random_shapes(spark, seed):
    draw = np.random.default_rng(seed)
    d, n = int(draw.integers(1, 9)), int(draw.integers(2, 40))
    rows = [(k, np.round(draw.standard_normal(d) * 3, 2).tolist()) for k in range(n)]
    check(whiten(frame(spark, rows)).collect(), rows, d)
