"""Medians by counting against sorting."""

from __future__ import annotations

import random
from statistics import median as plain

import pytest
from pyspark.sql import functions as F

from prodlake.operators import ranks

CASES = {
    "few": [5],
    "two": [1, 4],
    "hot": [7] * 300 + list(range(100)),
    "wide": [-(2**63), 2**63 - 1, 0, 5, 2**62, 2**62 + 1, 2**62 + 2],
    "close": [2**60 + k for k in range(9)],
    "doubles": [random.Random(1).gauss(0, 1e9) for _ in range(500)] + [1e308, -1e308, 5e-324, 0.0],
    "tiny": [5e-324 * k for k in range(11)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("buckets", [4096, 3])
def test_median(spark, monkeypatch, name, buckets):
    monkeypatch.setattr(ranks, "BUCKETS", buckets)
    values = CASES[name]
    kind = "double" if isinstance(values[0], float) else "long"
    df = spark.createDataFrame([(v,) for v in [*values, None]], f"v {kind}")
    assert ranks.median(df, F.col("v")) == pytest.approx(float(plain(values)), rel=1e-15)


def test_nothing_to_rank(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert ranks.median(df, F.col("v")) is None
