"""Hash trees against plain hashing, and their differences."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from prodlake.operators.hash_tree import hash_tree, marker_errors, set_hash, tree_changes


def root(leaves, fan):
    """leaves: place -> hash."""
    level = dict(leaves)
    while True:
        above = {}
        for node in sorted(level):
            above.setdefault(node // fan, []).append(level[node])
        level = {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in above.items()}
        if max(level) == 0:
            return level[0]


def tree(spark, rows, fan):
    return hash_tree(spark.createDataFrame(list(rows.items()), "place long, h string").repartition(3), "place", F.col("h"), fan)


@pytest.mark.parametrize(("n", "fan"), [(1, 3), (3, 3), (4, 3), (50, 3), (50, 64)])
def test_root(spark, n, fan):
    rows = {k: hashlib.sha256(str(k).encode()).hexdigest() for k in range(n) if k % 5 != 1 or k == n - 1}
    top = tree(spark, rows, fan).orderBy(F.desc("level")).first()
    assert (top["node"], top["n"], top["first"], top["last"]) == (0, len(rows), min(rows), n - 1) and top["sha256"] == root(rows, fan)


@pytest.mark.parametrize("fan", [5, 16])
def test_changes(spark, fan):
    draw = random.Random(fan)
    old = {k: str(draw.randrange(9)) for k in range(60)}
    new = {k: v if draw.random() < 0.9 else "other" for k, v in old.items() if draw.random() < 0.95} | {k: "more" for k in range(60, 90)}
    for a, b in ((old, new), (new, old), (old, old), (old, {}), ({}, old), ({}, {})):
        want = {(k, "changed" if k in a and k in b else "added" if k in b else "removed") for k in {*a, *b} if a.get(k) != b.get(k)}
        assert {tuple(r) for r in tree_changes(tree(spark, a, fan), tree(spark, b, fan), fan).collect()} == want


def test_plan_holds_each_level_once(spark):
    """Before, the rows stood in it once for every path from the root: their number doubled with each level."""
    rows = spark.range(1000).withColumn("h", F.sha2(F.col("id").cast("string"), 256))
    later = rows.withColumn("h", F.when(F.col("id") % 97 == 3, "other").otherwise(F.col("h")))
    changes = tree_changes(*[hash_tree(t, "id", F.col("h"), 4) for t in (rows, later)], 4)
    assert changes._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 4
    assert {r["place"] for r in changes.collect()} == set(range(3, 1000, 97))


def test_set_hash(spark):
    import json

    got = spark.range(1).select(set_hash(F.lit("b"), F.array(F.lit("x"), F.lit("y")))).first()[0]
    assert got == hashlib.sha256(json.dumps({"baseline_sha256": "b", "batch_sha256": ["x", "y"]}, separators=(",", ":")).encode()).hexdigest()


def test_a_marker_is_parsed_once(spark):
    """Before, it was parsed in each of four branches, and in filters below them."""
    import json

    hashes = ["h1", "h2"]
    entries = [{"batch_id": f"batch-0{i}", "file_name": f"batch-0{i}.json", "sha256": h, "product_count": 5, "source_order_start": 5 * i - 4, "source_order_end": 5 * i} for i, h in enumerate(hashes, 1)]
    own = hashlib.sha256(json.dumps({"baseline_sha256": "b", "batch_sha256": hashes}, separators=(",", ":")).encode()).hexdigest()
    fine = {"schema_version": "1.0", "complete": True, "set_id": own, "generated_at": "now", "baseline_sha256": "b", "baseline_count": 10, "batch_count": 2, "field_union_sha256": "f", "batches": entries}
    markers = [fine, fine | {"set_id": "x"}, fine | {"batches": [entries[0] | {"sha256": "no"}, {"batch_id": 1}]}, fine | {"batches": 3}, [], fine, fine | {"set_id": None}]
    made = spark.createDataFrame([(k, json.dumps(x)) for k, x in enumerate(markers)], "set long, marker string")
    expected = made.selectExpr("set", "'b' as baseline_sha256", "10L as baseline_count", "2L as batch_count", "'f' as fields_sha256", "5 as size")
    files = spark.createDataFrame([(k, f"batch-0{i}.json", h) for k in range(len(markers)) for i, h in enumerate(hashes, 1) if k != 5], "set long, file_name string, sha256 string")
    found = marker_errors(made, expected, files)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    want = {(1, "set_id"), (2, "changed_file:1"), (2, "entry_keys:2"), (3, "batches"), (4, "not_an_object"), (5, "missing_file:1"), (5, "missing_file:2"), (6, "set_id")}
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
