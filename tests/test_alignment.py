"""Alignment against the plain table, ties included, and a pair of long sequences."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from prodlake.functions.similarity import indel
from prodlake.operators import alignment as L

GAP = -12.0


def plain(n, m, score):
    """Every cell of the table; of equal sums a match, then a left item alone, then a right one."""
    best = [[GAP * (r + c) if not r or not c else 0.0 for c in range(m + 1)] for r in range(n + 1)]
    for r in range(1, n + 1):
        for c in range(1, m + 1):
            best[r][c] = max(best[r - 1][c - 1] + score(r - 1, c - 1), best[r - 1][c] + GAP, best[r][c - 1] + GAP)
    out, r, c = [], n, m
    while r or c:
        if r and c and best[r][c] == best[r - 1][c - 1] + score(r - 1, c - 1):
            r, c = r - 1, c - 1
            out += [(r, c)] if score(r, c) > 0 else []
        elif r and (not c or best[r][c] == best[r - 1][c] + GAP):
            r -= 1
        else:
            c -= 1
    return out[::-1]


@pytest.mark.parametrize("block", [1, 3, 256])
def test_best_matches_against_the_table(block):
    draw = random.Random(block)
    for _ in range(120):
        n, m = draw.randrange(1, 13), draw.randrange(1, 13)
        values = {(i, j): draw.choice([-24.0, -12.0, 0.0, 5.0, 5.5, 12.25, 46.0]) for i in range(n) for j in range(m) if draw.random() < 0.5}
        rows, columns = (np.array([k[x] for k in values], dtype=np.int64) for x in (0, 1))
        got = L.best_matches(n, m, rows, columns, np.array(list(values.values()), dtype=float), GAP, block)
        assert got == plain(n, m, lambda i, j, v=values: v.get((i, j), -80.0))


def test_long_sequences_end():
    """20,000 items against 20,000: the second reading lost every fifth item and has others between."""
    n = 20_000
    draw = random.Random(2)
    kept = [k for k in range(n) if k % 5]
    second = sorted([(k, k) for k in kept] + [(draw.random() * n, -1) for _ in range(n - len(kept))])
    pairs = [(k, j, 40.0) for j, (_, k) in enumerate(second) if k >= 0]
    pairs += [(draw.randrange(n), draw.randrange(n), 30.0) for _ in range(50_000)]
    known = {(i, j): s for i, j, s in reversed(pairs)}
    i, j = (np.array([p[x] for p in known], dtype=np.int64) for x in (0, 1))
    began = time.perf_counter()
    found = L.best_matches(n, n, i, j, np.array(list(known.values())))
    assert time.perf_counter() - began < 300
    assert len(set(found) & {p[:2] for p in pairs[: len(kept)]}) > 0.98 * len(kept)


SIDE = "k long, n long, text string, price int, category string, second double"


def reading(draw, key):
    words = ["가나다정", "가나다 정", "라마바", "라마바캡슐", "abc", "abd", ""]
    return [(key, n, draw.choice(words), draw.randrange(2), draw.choice(["x", "y", None]), float(draw.randrange(6))) for n in range(draw.randrange(9))]


@pytest.mark.parametrize("which", ["passes", "likeness"])
def test_align_against_the_table(spark, which):
    draw = random.Random(7)
    left = [r for k in range(12) for r in reading(draw, k)]
    right = [r for k in range(1, 13) for r in reading(draw, k)]
    a, b = spark.createDataFrame([*left, (None, 1, "x", 1, "x", 1.0)], SIDE), spark.createDataFrame(right, SIDE)
    if which == "passes":
        found = L.align(a, b, "k", "n", "text", L.pass_score, L.LEAST_ALIKE, ("price",), ("category", "second"))
    else:
        found = L.align(a, b, "k", "n", "text", L.likeness, 30.0)

    def score(x, y):
        like = indel(x[2], y[2])
        if which == "likeness":
            return like - 54
        if x[3] != y[3]:
            return -80.0
        return -50.0 if like < 52 else like - 54 + (10 if x[4] == y[4] else -4) - min(25.0, abs(x[5] - y[5]) * 3)

    want = set()
    for k in range(13):
        l, r = [x for x in left if x[0] == k], [x for x in right if x[0] == k]
        pairs = plain(len(l), len(r), lambda i, j, l=l, r=r: score(l[i], r[j])) if l and r else []
        want |= {(k, i, j) for i, j in pairs}
        want |= {(k, i, None) for i in range(len(l)) if i not in {p[0] for p in pairs}} | {(k, None, j) for j in range(len(r)) if j not in {p[1] for p in pairs}}
    rows = [tuple(x) for x in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_pass_scores(spark):
    rows = [(56, 100.0, "x", "x", 1.0, 1.0), (36, 100.0, "x", "y", 1.0, 3.0), (31, 100.0, "x", "x", 1.0, 99.0), (None, 51.9, "x", "x", 1.0, 1.0), (56, 100.0, None, None, None, 0.0)]
    df = spark.createDataFrame(rows, "want int, ratio double, l_category string, r_category string, l_second double, r_second double")
    assert all(r["got"] == r["want"] for r in df.select("want", L.pass_score(F.col("ratio")).alias("got")).collect())
