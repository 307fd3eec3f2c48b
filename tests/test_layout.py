"""The band join in two dimensions against all pairs, and crowded cells."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from prodlake.operators import layout
from prodlake.operators.layout import Window2, band_pairs, catalogue_lines


def sides(seed, n=160, span=400):
    draw = random.Random(seed)
    anchors = [(draw.choice(["p", "q", None]), k, draw.choice([None, draw.randrange(-span, span)]) if k % 9 == 0 else draw.randrange(-span, span), draw.randrange(-span, span)) for k in range(n)]
    boxes = [(draw.choice(["p", "q", None]), k, float(draw.randrange(-span, span)) + draw.choice([0, 0.5]), float(draw.randrange(-span, span))) for k in range(n)]
    return anchors, boxes


@pytest.mark.parametrize("window", [Window2(-52, 118, -400, 20), Window2(-5, 5, 0, 30), Window2(0, 0, 0, 0), Window2(-52, 52)])
@pytest.mark.parametrize("dense", [4096, 3])
def test_against_all_pairs(spark, monkeypatch, window, dense):
    monkeypatch.setattr(layout, "DENSE", dense)
    anchors, boxes = sides(dense)
    boxes += boxes[:5]
    a = spark.createDataFrame(anchors, "page string, anchor long, x int, y int")
    b = spark.createDataFrame(boxes, "page string, box long, x double, y double")
    found = sorted((r["anchor"], r["box"]) for r in band_pairs(a, b, ["page"], "x", "y", window).collect())
    inside = lambda low, v, high: low is None or low <= v <= high
    want = sorted(
        (k, j) for p, k, x, y in anchors for q, j, u, v in boxes if p == q is not None and p and (x is not None) and inside(window.top, v - y, window.bottom) and inside(window.left, u - x, window.right)
    )
    if window.left is None:  # then x does not count at all
        want = sorted((k, j) for p, k, _, y in anchors for q, j, _, v in boxes if p == q and p and window.top <= v - y <= window.bottom)
    assert found == want


def test_a_row_of_a_screen(spark):
    rows = [
        ("f", 1, "게보린정", 0.9, 100, 100, 300, 120), ("f", 2, "10정", 0.8, 400, 104, 500, 124), ("f", 3, "1,200", 1.0, 800, 102, 900, 122), ("f", 4, "진통제", 0.7, 60, 180, 120, 200),
        ("f", 5, "다른 분류", 0.7, 60, 160, 120, 180), ("f", 6, "검색", 0.9, 50, 100, 90, 120), ("f", 7, "흐림", 0.3, 120, 100, 200, 120), ("f", 8, "90", 1.0, 800, 600, 900, 620),
        ("g", 1, "가", 0.9, 100, 100, 300, 120), ("g", 2, "900", 1.0, 800, 100, 900, 120), ("g", 3, "  ", 1.0, 100, 100, 300, 120), ("h", 1, "500 ", 1.0, 800, 100, 900, 120),
        ("i", 1, "파스|연고", 0.5, 100, 100, 300, 120), ("i", 2, "12,34", 1.0, 800, 100, 900, 120), ("i", 3, "2 ,500", 0.7, 800, 110, 900, 130),
    ]
    got = catalogue_lines(spark.createDataFrame(rows, "frame string, k int, text string, score double, x1 int, y1 int, x2 int, y2 int"), ["frame"], "k").collect()
    assert {tuple(r) for r in got} == {("f", 3, 1200, "게보린정", "10정", "진통제", 0.85, 4), ("i", 3, 2500, "파스l연고", "", "미분류", 0.6, 2)}


def test_plans_hold_each_step_once(spark, small):
    """Before, lineitem was grouped for every kind of line, both sides were shuffled to learn shares, and filters repeated the patterns of names."""
    from prodlake.plans import QUERIES

    plan = QUERIES["j12_band_pairs"](spark, small)._jdf.queryExecution()
    assert plan.optimizedPlan().collectLeaves().size() == 4  # anchors, boxes, and the dense cells beside each
    assert plan.sparkPlan().toString().count("BroadcastHashJoin") == 2 and plan.sparkPlan().toString().count("SortMergeJoin") == 1
    lines = QUERIES["j12_catalogue_lines"](spark, small)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not any("regexp" in x for x in lines if "Filter" in x and "collect_list" in x or "Filter" in x and "array_join" in x)


def screens(seed, n=500):
    draw = random.Random(seed)
    text = {850: ["1,200", "90", "2 ,500", "12,34", "9,000,000"], 755: ["700", "800"], 300: ["검색", "10정", "다른 분류", "a|b㎖", "x" * 17, " "], 500: ["30 정", "name", "초기화"]}
    rows = []
    for k in range(n):
        x = draw.choice([850, 755, 300, 500])
        y = draw.choice([draw.randrange(-3000, 9000), draw.randrange(2500, 3000), draw.randrange(2500, 3000)])
        rows.append((draw.choice(["p", "q", None]), k, draw.choice(text[x]), draw.choice([0.3, 0.5, 0.75, 1.0]), x - draw.randrange(3), draw.choice([y, y, y, None]), x + 50, y + draw.choice([20, 21])))
    return rows


def read_plainly(rows):
    """Each price against every line of its page: texts and scores of its row, from left to right, and the line below."""
    lines = [(p, k, layout_text(t), s, x, (y + v) / 2) for p, k, t, s, x, y, _, v in rows if p and s >= 0.45 and t.strip() and y is not None]
    out = {}
    for p, k, t, s, x, cy in lines:
        digits = t.replace(" ", "")
        if x < 750 or not re.fullmatch(r"\d{1,3}(,\d{3})*", digits) or not 100 <= int(digits.replace(",", "")) <= 10_000_000:
            continue
        mine = [(a, j, u, c, h - cy) for q, j, u, c, a, h in lines if q == p and -52 <= h - cy <= 118]
        row = sorted(r[:4] for r in mine if r[0] < 760 and abs(r[4]) <= 52 and r[2] not in ("검색", "초기화"))
        below = min(((abs(d - 78), a, j, u, c) for a, j, u, c, d in mine if a < 420 and d >= 42 and len(u) <= 16), default=None)
        if row:
            out[p, k] = (int(digits.replace(",", "")), [r[2] for r in row], [r[3] for r in row], below and below[3], below and below[4])
    return out


def layout_text(text):
    return re.sub(r"\s+", " ", text.replace("|", "l").replace("㎖", "ml")).strip()


@pytest.mark.parametrize("dense, stretch", [(4096, 16), (7, 16), (50, 1)])
def test_rows_against_all_pairs(spark, monkeypatch, dense, stretch):
    """Over stretches' ends, on crowded stretches dealt into shares, with lines that are a price and part of its name."""
    monkeypatch.setattr(layout, "DENSE", dense)
    monkeypatch.setattr(layout, "STRETCH", stretch)
    rows = screens(dense)
    met, keep = [], layout._met
    monkeypatch.setattr(layout, "_met", lambda usable, pages: met.append(keep(usable, pages)) or met[0])
    lines = spark.createDataFrame(rows, "frame string, k int, text string, score double, x1 int, y1 int, x2 int, y2 int").repartition(3)
    catalogue_lines(lines, ["frame"], "k")
    got = {(r["frame"], r["place"]): (r["price"], r["row_text"], r["row_score"], r["below_text"], r["below_score"]) for r in met[0].collect()}
    assert got == read_plainly(rows) and len(got) > 30


@pytest.mark.parametrize("at_once, pairs, cut", [(1, 1, 1), (5, 3, 2), (1 << 14, 1 << 18, 1000)])
def test_the_sweep_in_pieces(monkeypatch, at_once, pairs, cut):
    """Whatever comes and is met at a time, a price meets the lines of its window, and what is kept is a window's lines."""
    monkeypatch.setattr(layout, "AT_ONCE", at_once)
    monkeypatch.setattr(layout, "PAIRS", pairs)
    draw = random.Random(3)
    rows = sorted((draw.randrange(3), draw.randrange(2), 0, draw.randrange(-104, 5676), draw.choice([0, 1, 3]), k) for k in range(400))
    price = [100 + r[5] if draw.random() < 0.4 or not r[4] else None for r in rows]
    names = ["page", "_stretch", "_share", "_at", "_use", "place"]
    table = pa.table({name: pa.array([r[n] for r in rows], pa.int32() if name in ("_at", "_use") else pa.int64()) for n, name in enumerate(names)})
    table = table.append_column("price", pa.array(price, pa.int64())).append_column("text", pa.array([f"t{r[5]}" for r in rows]))
    table = table.append_column("score", pa.array([1.0] * len(rows))).append_column("x1", pa.array([r[5] % 7 for r in rows], pa.int64()))
    got = [r for b in layout._swept(iter(table.to_batches(max_chunksize=cut)), 1, 5440) for r in b.to_pylist()]
    want = {}
    for asked, p in zip(rows, price, strict=True):
        near = [(r[5] % 7, r[5], r[3] - asked[3]) for r in rows if r[:2] == asked[:2] and r[4] & 1 and abs(r[3] - asked[3]) <= 104]
        if p is not None and near:
            want[asked[5]] = [f"t{k}" for _, k, _ in sorted(near)]
    assert {r["place"]: r["row_text"] for r in got} == want and len(got) == len(want)


def test_lines_are_shuffled_once(spark, small):
    """Before, pairs of a price and a line were sorted and shuffled once more, after a merge join of both sides."""
    from prodlake.plans import QUERIES

    plan = QUERIES["j12_catalogue_lines"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ObjectHashAggregate" not in plan and plan.count("REPARTITION_BY_COL") == 1
    assert len(set(re.findall(r"PushedFilters: \[[^]]*\]", plan))) == 1  # else lineitem is shuffled for each of two scans
