"""Paging and numbering beyond one task, sinks, page scans, answered requests and small shapes."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.operators import catalog as C
from prodlake.operators import records as R
from prodlake.operators import shapes as S
from prodlake.operators.audit import ledger_summary, schema_errors
from prodlake.operators.resolve import registry_choice, two_phase
from prodlake.session import catalog
from prodlake.sources import readers, writers
from prodlake.sources.registry import answered


@pytest.mark.parametrize("sort", C.SORTS)
def test_any_way_to_a_page_gives_the_same_rows(spark, small, monkeypatch, sort):
    df = catalog(spark, small)
    whole = [r["pos"] for r in df.orderBy(*C.order_of(sort)).collect()]
    monkeypatch.setattr(C, "NEAR", 60)
    for page in (1, 4, 8):  # from the front, between, from the back
        got = C.page_of(df, C.CatalogQuery(sort=sort, page=page)).orderBy("place").collect()
        assert [(r["pos"], r["place"]) for r in got] == [(whole[k], k + 1) for k in range(25 * page - 25, 25 * page)]


def test_long_numbers_keep_their_order(spark):
    names = ["5", "05b", "8801234567890", "88012345678901", "a9999999999999", "a10000000000000", None]
    rows = spark.createDataFrame(list(enumerate(names)), "pos int, name string")
    assert [r["name"] for r in rows.orderBy(*C.order_of("name")).collect()] == [None, "5", "05b", "8801234567890", "88012345678901", "a9999999999999", "a10000000000000"]


def test_numbers_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(R, "SLOTS", 40)
    df = spark.range(5000).select(F.struct((F.col("id") % 7).alias("a"), F.col("id").alias("b")).alias("o"))
    got = R.numbered(df, "o").orderBy("number").collect()
    assert [r["number"] for r in got] == list(range(1, 5001)) and [tuple(r["o"]) for r in got] == sorted(tuple(r["o"]) for r in got)
    assert R.numbered(df.where("false"), "o").collect() == []


def test_ties_keep_the_order_of_the_answer(spark):
    scored = spark.createDataFrame([(1, "10", 90, 2, False), (1, "9", 90, 1, False), (1, "8", 70, 0, False)], "item_id int, official_product_key string, score int, place int, exact_name boolean")
    scored = scored.withColumns({"identifier_hit": F.lit(False), "conflict": F.lit(False), "status": F.lit("review_required")})
    assert registry_choice(spark.createDataFrame([(1,)], "item_id int"), scored, "place").first()["official_product_key"] == "9"


def test_pages_are_read_for_promising_pairs_only(spark):
    pairs = spark.createDataFrame([(1, "a", "", 50), (1, "b", "", 20), (2, "c", "c", 20)], "item_id int, code string, known_code string, base int")
    pages = spark.createDataFrame([(k, {"x": k}) for k in "abc"], "code string, page map<string,string>")
    score = lambda df: df.withColumns({"score": F.col("base") + F.when(F.col("page").isNotNull(), 5).otherwise(0), "reasons": F.lit(None), "conflicts": F.when(F.col("page").isNull(), F.array(F.lit("first"))).otherwise(F.array().cast("array<string>"))})
    got = {r["code"]: (r["score"], r["detailed"], r["conflicts"]) for r in two_phase(pairs, pages, score).collect()}
    assert got == {"a": (55, True, []), "b": (20, False, ["first"]), "c": (25, True, [])}


def test_headers_and_published_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2)], "b int, a string, c int")
    assert writers.header_columns(spark, str(tmp_path / "none"), ["b", "a"]) == ["a", "b"]
    writers.write_csv(df, [F.col("b")], str(tmp_path / "e"), ["b", "a"])
    assert writers.header_columns(spark, str(tmp_path / "e"), ["d", "c", "a", "b"]) == ["b", "a", "c", "d"]
    with pytest.raises(ValueError, match="more than 0 rows"):
        writers.write_csv(df, [F.col("b")], str(tmp_path / "f"), most=0)
    df.write.parquet(str(tmp_path / "t"))
    assert writers.publish(spark, str(tmp_path / "t"), str(tmp_path / "public")) == 1
    assert spark.read.parquet(str(tmp_path / "public")).collect() == df.collect()


def test_chain_of_pages(spark, tmp_path):
    document = lambda n: {"name": f"p/{n}", "fields": {"n": {"integerValue": str(n)}, "m": {"nullValue": None}}}
    for name, page in {"first": {"documents": [document(1)], "nextPageToken": "second"}, "second": {"documents": [document(2)]}, "old": {"documents": [document(9)]}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(page))
    rows = readers.document_pages(spark, str(tmp_path)).orderBy("document_id").collect()
    assert [(r["document_id"], json.loads(r["fields"])) for r in rows] == [("1", {"n": 1, "m": None}), ("2", {"n": 2, "m": None})]


def test_each_request_is_made_once(spark, tmp_path):
    requests = spark.createDataFrame([("u", {"n": "1"}), ("u", {"n": "1"}), ("u", {"n": "2"}), ("u", {"n": "3"})], "endpoint string, params map<string,string>")
    cache = requests.where("params['n'] = '2'").select(readers.cache_key(F.col("endpoint"), F.col("params")).alias("key"), F.lit('"known"').alias("payload"))
    log = tmp_path / "log"

    def fetch(endpoint, params):
        with log.open("a") as f:
            f.write(params["n"])
        return "no json" if params["n"] == "3" else '"fresh"'

    got = sorted((r["params"]["n"], r["payload"], r["error"], r["cached"]) for r in answered(requests, cache, fetch, interval=0, retries=2, pause=0).collect())
    assert [g for g in got if g[0] != "3"] == [("1", '"fresh"', None, False), ("1", '"fresh"', None, False), ("2", '"known"', None, True)]
    assert got[-1][1] is None and got[-1][2] == "JSONDecodeError" and sorted(log.read_text()) == ["1", "3", "3", "3"]


def test_shapes(spark):
    assert S.visible_columns(["price", "x", "price"], ("name",)) == ["name", "price"] and S.visible_columns([], ("name", "etc")) == ["name", "etc"]
    kind = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.ArrayType(T.IntegerType(), False), False), T.StructField("m", T.MapType(T.StringType(), T.DoubleType(), False), False)])
    schema = S.declared_schema(kind)
    assert schema_errors({"a": None, "b": [1], "m": {"x": 0.5}}, schema) == []
    assert schema_errors({"b": ["1"], "m": {}, "z": 1}, schema) == ["$.a: missing", "$.b[0]: not of type integer", "$.z: unknown"]
    picked = S.Selection().page(["a", "b"], True).toggle("b").toggle("c")
    assert picked.keys == {"a", "c"} and S.Selection().everything().page(["a"], False).toggle("a") == S.Selection(inverted=True) and picked.clear() == S.Selection()
    rows = spark.createDataFrame([("a",), ("x",)], "k string")
    assert [r["k"] for r in picked.applied(rows, "k").collect()] == ["a"] and S.Selection().applied(rows, "k").count() == 0
    records = spark.createDataFrame([(1, "pending"), (2, "approved")], "id int, final string")
    assert tuple(ledger_summary(records, spark.range(5)).first()) == (2, 1, 5)


def test_folds_that_are_cut_at_pauses_find_the_same(spark, monkeypatch):
    import random

    from prodlake.operators import folding

    rng = random.Random(7)
    at, rows = 0.0, []
    for n in range(400):
        at += rng.choice([1.0, 2.0, 3.0, 30.0])
        rows.append((n % 2, at, n, rng.choice(["alpha beta", "alpha betb", "gamma", "delta"]), 1))
    df = spark.createDataFrame(rows, "k int, at double, id int, text string, observations int")
    found = []
    for slots in (1, 10**9):
        monkeypatch.setattr(folding, "SLOT", slots)
        found.append(sorted(map(tuple, folding.fold_lookback(df, ["k"], ["id"]).collect())))
    assert found[0] == found[1] and len(found[0]) < 400


def test_dense_times_meet_as_many_rows_as_stated(spark):
    from prodlake.operators.sequence import banded_pairs

    df = spark.range(200).select(F.lit(1).alias("k"), F.timestamp_seconds((F.col("id") / 40).cast("int")).alias("t"), "id")
    got = {(r["left_id"], r["right_id"]) for r in banded_pairs(df, ["k"], "t", "id", 7, 2.0).collect()}
    assert got == {(a, b) for a in range(200) for b in range(a + 1, min(a + 8, 200)) if b // 40 - a // 40 <= 2}
