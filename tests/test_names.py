from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from prodlake.functions import names as N


@pytest.fixture(scope="module")
def judge(spark):
    """(safe, score, validated) of cases (name, found, pack), in one job."""

    def run(cases):
        df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, name string, found string, pack string")
        return [tuple(r) for r in N.judged(df, "name", "found", "pack").orderBy("k").select("safe", "score", "validated").collect()]

    return run


def test_safe_match(judge):
    cases = [
        ("타이레놀정", "타이레놀 정", "", True),
        ("타이레놀정500mg", "타이레놀정650mg", "", False),
        ("타이레놀(소아)", "타이레놀", "", False),
        ("타이레놀(30정)", "타이레놀", "", True),
        ("타이레놀캡슐", "타이레놀정", "", False),
        ("타이레놀", "타이레놀정", "10캡슐", False),
        ("타이레놀", "타이레놀정", "10정", True),
        ("판콜해열진통제", "판콜", "", False),
        ("판콜에이해열진통제", "판콜에이", "", True),
        ("", "x", "", False),
        (None, None, None, False),
        ("게보린씨럽", "게보린시럽", "", True),
        ("A&amp;B정", "a&b 정", "", True),
    ]
    assert [r[0] for r in judge([c[:3] for c in cases])] == [c[3] for c in cases]


def test_scores(judge):
    got = judge([("타이레놀", "타이레놀", ""), ("", "x", ""), ("타이레놀정", "타이레놀정에이", ""), ("타이레놀(30정)", "타이레놀(30 정)", ""), ("타이레놀정", "타이레놀캡슐", ""), ("타이레놀정", "타이레놀", "")])
    assert got[0] == (True, 100, 100) and got[1][1] == 0 and got[2][1] == 96 and got[3][2] == 100
    assert got[4][1] == got[4][2] and got[5] == (True, 96, 98)


def test_cores_and_variants(spark):
    df = spark.createDataFrame([("타이레놀정500mg",), ("정",), ("타이레놀정 500mg(10정)",), (None,)], "x string")
    got = df.select(N.core(N.plain(N.corrected(F.col("x")))), N.variants(F.col("x"))).collect()
    assert got[0][0] == "타이레놀" and got[1][0] == "정" and got[3][1] == []
    assert got[2][1][:2] == ["타이레놀정 500mg(10정)", "타이레놀정 500mg"]


def test_listing_score(spark):
    cases = [("red widget", "WIDGET, red"), ("red widget", "new widget of a red maker"), ("red widget", "blue widget"), ("", "x"), ("red widget", "red widget box"), ("red widget 3개", "<b>Red</b> widget")]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, name string, found string")
    got = [r["score"] for r in N.listed(df, "name", "found").orderBy("k").collect()]
    assert got[:2] == [92, 92] and got[2] < 92 and got[3:] == [0, 96, 100]


def test_search_choice_knows_tokens_and_vetoes(spark, monkeypatch):
    from prodlake.plans import QUERIES, audit_queries

    rows = [(1, "acetamin red", "blue acetamin", ""), (2, "widgets(x)", "widgets", ""), (3, "widgets", "widgets", "")]
    pairs = spark.createDataFrame(rows, "item_id int, name string, item_name string, capacity string")
    monkeypatch.setattr(audit_queries, "_pairs", lambda *_: (spark.range(1, 5).withColumnRenamed("id", "item_id"), pairs))
    found = QUERIES["e03_e06_search_choice"](spark, "").orderBy("item_id").collect()
    assert [tuple(r) for r in found] == [
        (1, "blue acetamin", 96, "name_or_dosage_conflict"),
        (2, "widgets", 100, "name_or_dosage_conflict"),
        (3, "widgets", 100, "confirmed"),
        (4, None, None, "no_search_result"),
    ]


def test_matching_blocks_in_batches():
    """Ratios of batches of pairs equal those of pairs by themselves, ties and long texts included, and take less time."""
    import random
    import time
    from difflib import SequenceMatcher

    from prodlake.functions.similarity import block_ratios

    draw = random.Random(6)
    text = lambda letters, n: "".join(draw.choices(letters, k=draw.randrange(n)))
    pairs = [(text("가나다라마바사아자차카타파하", 18), text("가나다라마바사아자차카타파하", 18)) for _ in range(6000)] + [(text("ab", 30), text("ab", 30)) for _ in range(1500)]
    pairs += [(text("a😀b가", 12), text("a😀b가", 12)) for _ in range(500)] + [("abc" * 90, "bca" * 70), ("x" * 250, "x" * 3), ("", "a"), ("", "")]
    began = time.perf_counter()
    got = block_ratios(pairs)
    mine = time.perf_counter() - began
    began = time.perf_counter()
    want = {p: SequenceMatcher(None, *p).ratio() if p[0] and p[1] else 0.0 for p in pairs}
    plain = time.perf_counter() - began
    assert got == want
    assert mine < plain
