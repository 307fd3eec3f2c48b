from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prodlake.operators import catalog as C
from prodlake.operators import records as R
from prodlake.operators import resolve as E
from prodlake.operators import sequence as S
from prodlake.operators.folding import fold_lookback
from prodlake.session import catalog
from prodlake.sources import readers, writers
from prodlake.streaming import incremental as I


def test_query_state_round_trip():
    q = C.CatalogQuery.from_params("?q= ring &category=A&category=B&min=0&sort=bad&page=-3&size=50&cols=price,name,price&note=with")
    assert q == C.CatalogQuery(search="ring", categories=("A", "B"), min_price=0, page=1, page_size=50, columns=("name", "price"), note="with")
    assert C.CatalogQuery.from_params(q.to_params()) == q and q.active_filters() == 4 and C.CatalogQuery().to_params() == ""


def test_page_is_clamped_and_stable(spark, small):
    df = catalog(spark, small)
    last = C.run(df, C.CatalogQuery(sort="name", page=99, page_size=25)).collect()
    assert [r["place"] for r in last] == list(range(176, 201))
    assert C.run(df.where("false"), C.CatalogQuery(page=9)).collect() == []
    assert C.page_window(1, 2) == [1, 2] and C.page_window(6, 9) == [4, 5, 6, 7, 8] and C.page_window(9, 9) == [5, 6, 7, 8, 9]
    assert C.export_name(" a b/c ", "csv", "2024-01-02").endswith("_a_b_c_2024-01-02.csv")


def test_natural_order(spark):
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(["b10", "b9", "a 2", "A 10"])], "pos int, name string")
    assert [r["name"] for r in rows.orderBy(*C.order_of("name")).collect()] == ["a 2", "A 10", "b9", "b10"]


def test_presence_rules(spark):
    rows = [("confirmed", "", "u", "unverified"), ("pending", "x", "", "verified"), ("", "x", "https://h/a", "verified"), ("", " ", "http://h/a", "no")]
    df = spark.createDataFrame(rows, "official_match_status string, official_item_name string, image_url string, image_rights_status string")
    got = df.select(C.has_official(df), C.has_image(), C.approved_image()).collect()
    assert [tuple(r) for r in got] == [(True, True, False), (False, False, False), (True, True, True), (False, False, False)]


def test_summary_of_nothing(spark, small):
    assert C.summary(catalog(spark, small).where("false")).first().asDict() == {"total": 0, "categories": 0, "min_price": 0, "max_price": 0, "median_price": 0.0, "with_note": 0, "with_official": 0, "with_image": 0}


def test_ties_go_to_the_first(spark):
    df = spark.createDataFrame([(1, 5, 2, "b"), (1, 5, 1, "a"), (2, 1, 3, None)], "k int, score int, pos int, v string")
    assert sorted(map(tuple, R.best_per_key(df, ["k"], [-F.col("score"), F.col("pos")]).select("k", "v").collect()), key=str) == [(1, "a"), (2, None)]
    assert R.last_wins(df, ["k"], ["pos"]).where("k = 1").first()["v"] == "b"
    margins = {r["k"]: r["margin"] for r in R.runner_up_margin(df, ["k"], "score", "pos").collect()}
    assert margins == {1: 0, 2: None}


def test_batches(spark):
    df = spark.range(103).withColumnRenamed("id", "pos").repartition(5)
    numbered = R.batches(df, "pos", 25)
    assert {(r["pos"], r["number"], r["batch_no"]) for r in numbered.collect()} == {(k, k + 1, k // 25 + 1) for k in range(103)}
    sizes = sorted(r["count"] for r in R.balanced_batches(numbered, 4, 103).groupBy("batch").count().collect())
    assert sizes == [25, 26, 26, 26]


def test_overlay_and_diff(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    fixes = spark.createDataFrame([(1, "a", "A"), (2, "x", "B")], "k int, expected string, corrected string")
    done = R.overlay(base, fixes, "k", "v")
    assert sorted(map(tuple, done.select("k", "v", "correction").collect())) == [(1, "A", "applied"), (2, "b", "conflict"), (3, "c", "none")]
    after = spark.createDataFrame([(1, "A"), (2, "b"), (4, "d")], "k int, v string")
    assert sorted(map(tuple, R.snapshot_diff(base, after, "k", ["v"]).collect())) == [(1, "changed", "v"), (2, "kept", ""), (3, "removed", ""), (4, "added", "")]


def test_lookback_fold_is_sequential(spark):
    rows = [(1, 0.0, 1, "abcdefgh", 1), (1, 1.0, 2, "abcdefgh!", 1), (1, 2.0, 3, "zzzz", 1), (1, 20.0, 4, "abcdefgh", 1), (2, 0.5, 5, "abcdefgh", 1)]
    df = spark.createDataFrame(rows, "k int, at double, id int, text string, observations int")
    got = fold_lookback(df, ["k"], ["id"]).collect()
    assert sorted((r["k"], r["at"], r["text"], r["observations"]) for r in got) == [(1, 0.0, "abcdefgh!", 2), (1, 2.0, "zzzz", 1), (1, 20.0, "abcdefgh", 1), (2, 0.5, "abcdefgh", 1)]


ITEM = "item_id int, name string, capacity string, manufacturer_hint string, item_seq string"
CANDIDATE = "official_product_key string, item_name string, pack_unit string, manufacturer string, dosage_form string, official_item_seq string"


def decide(spark, item, candidates):
    items = spark.createDataFrame([(1, *item)], ITEM)
    registry = spark.createDataFrame(candidates, CANDIDATE)
    block = F.array(F.lit("all"))
    return tuple(E.registry_choice(items, E.registry_points(E.candidates(items, registry, block, block))).first())[1:4]


@pytest.mark.parametrize(
    ("item", "candidates", "want"),
    [
        (("비타씨정", "30정", "한국제약", ""), [("a", "비타씨정", "30 정", "(주)한국제약", "", "")], ("confirmed", 100, "a")),
        (("비타씨", "", "", ""), [("a", "비타씨", "", "", "", ""), ("b", "비타씨", "", "", "", "")], ("review_required", 60, "a")),
        (("비타씨", "", "", ""), [("a", "비타씨", "", "", "", ""), ("b", "다른것", "", "", "", "")], ("confirmed", 95, "a")),
        (("비타씨", "", "", "77"), [("a", "비타씨", "", "", "", ""), ("b", "전혀다른", "", "", "", "77")], ("confirmed", 100, "b")),
        (("비타씨", "", "", "77"), [("a", "비타씨", "", "", "", "77"), ("b", "전혀다른", "", "", "", "77")], ("review_required", 100, "a")),
        (("비타씨캡슐", "", "", ""), [("a", "비타씨캡슐", "", "", "정", "")], ("review_required", 80, "a")),
        (("비타씨", "", "", ""), [("a", "xyz", "", "", "", "")], ("not_found", 0, "")),
    ],
)
def test_registry_decisions(spark, item, candidates, want):
    assert decide(spark, item, candidates) == want


def test_scans(spark, tmp_path):
    schema = StructType().add("a", "integer")
    (tmp_path / "x.json").write_text('[{"a": 1},\n {"a": 2}]')
    (tmp_path / "y.json").write_text('{"a": 1}\nnot json\n')
    assert readers.json_array(spark, str(tmp_path / "x.json"), schema).count() == 2
    assert readers.json_or_empty(spark, str(tmp_path / "none.json"), schema).count() == 0
    assert [r["_bad_line"] for r in readers.json_lines(spark, str(tmp_path / "y.json"), schema).collect()] == [None, "not json"]
    payloads = spark.createDataFrame([('{"response":{"body":{"items":{"item":[{"x":1},{"x":2}]}}}}',), ('{"items":{"x":3}}',), ('{"z":0}',)], "j string")
    assert [len(r[0]) for r in payloads.select(F.transform(readers.items_of(F.parse_json("j")), lambda v: v.cast("string"))).collect()] == [2, 1, 0]


def test_recorded_pages(spark, tmp_path):
    document = lambda n: {"name": f"p/{n}", "fields": {"n": {"integerValue": str(n)}, "m": {"mapValue": {"fields": {"l": {"arrayValue": {"values": [{"nullValue": None}]}}}}}}}
    (tmp_path / "first.json").write_text(json.dumps({"documents": [document(1)], "nextPageToken": "second"}))
    (tmp_path / "second.json").write_text(json.dumps({"documents": [document(2)]}))
    rows = readers.document_pages(spark, str(tmp_path)).orderBy("document_id").collect()
    assert [(r["document_id"], json.loads(r["fields"])) for r in rows] == [("1", {"m": {"l": [None]}, "n": 1}), ("2", {"m": {"l": [None]}, "n": 2})]


def test_sinks(spark, small, tmp_path):
    df = catalog(spark, small).select("document_id", "name", "price").limit(10)
    for n in (10, 4):
        writers.swap(df.limit(n), str(tmp_path / "t"))
        assert spark.read.parquet(str(tmp_path / "t")).count() == n
    manifest = writers.package(df, str(tmp_path / "p"), 10)
    assert manifest.count() >= 1 and writers.package_errors(spark, str(tmp_path / "p")).collect() == []
    writers.write_csv(df, [F.col("document_id")], str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("part-*")).read_bytes().decode()
    assert text.startswith("﻿document_id,name,price\r\n") and text.count("\r\n") == 11


def test_commit_of_several_tables(spark, tmp_path):
    one, two = (str(tmp_path / n) for n in ("one", "two"))
    writers.swap_all([(spark.range(1), one), (spark.range(2), two)])
    (tmp_path / "missing").mkdir()
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS|could not"):
        writers.swap_all([(spark.range(3), one), (spark.range(3), two), (spark.range(3), two)])
    assert spark.read.parquet(one).count() == 1 and spark.read.parquet(two).count() == 2
    writers.swap_all([(spark.range(5), one)], keep_old=True)
    assert spark.read.parquet(one).count() == 5 and len(list(tmp_path.glob("one.old-*"))) == 1
    with writers.locked(spark, one), pytest.raises(BlockingIOError), writers.locked(spark, one):
        pass
    with writers.locked(spark, one):
        pass


def test_files(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"12345")
    before = writers.fingerprint(spark, str(tmp_path)).collect()
    assert [tuple(r)[:2] for r in before] == [("a", 5)] and writers.fingerprint(spark, str(tmp_path)).collect() == before
    assert writers.bounded_files(spark, str(tmp_path), 5).count() == 1
    with pytest.raises(ValueError, match="larger"):
        writers.bounded_files(spark, str(tmp_path), 4)


def test_resume_reads_every_file_once(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet").select("event_id", "event_type")
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    go = lambda: I.process_new_files(spark, source, events.schema, target, state, lambda b: b.where("event_type = 'view'"))
    events.where("event_id < 500").write.parquet(source)
    assert go() == 500 and go() == 0
    events.where("event_id >= 500").write.mode("append").parquet(source)
    assert go() == 500
    assert spark.read.parquet(target).count() == events.where("event_type = 'view'").count()
    done = spark.createDataFrame([(1, "confirmed"), (2, "error")], "event_id long, status string")
    assert I.pending(events, done, "event_id", "status").count() == events.count() - 1


def test_streams(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = I.event_counts(stream, "1 day").writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == events.count()


def test_every_order_has_a_place(spark, small):
    from prodlake.plans import QUERIES

    places = [r["place"] for r in QUERIES["o05_o07_priority_all"](spark, small).collect()]
    assert sorted(places) == list(range(1, spark.read.parquet(f"{small}/orders.parquet").count() + 1))
    df = spark.createDataFrame([(k % 3 or None, -k, k) for k in range(90)], "a int, b int, k int").select(F.struct("a", "b", "k").alias("key"), "a", "b")
    want = sorted(((k % 3 or 0, -k) for k in range(90)))
    assert [(r["a"] or 0, r["b"]) for r in R.numbered(df, "key").orderBy("number").collect()] == want


def test_equal_names_of_other_brands_ask_for_review(spark, tmp_path):
    from prodlake.plans import QUERIES

    rows = [(1, "cold widget", "Brand#1", 5, "PROMO"), (2, "cold widget", "Brand#2", 9, "PROMO"), (3, "old gear", "Brand#3", 4, "PROMO")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    for name in ("e01_e02_registry_choice", "e02_registry_choice_whole_levenshtein"):
        got = {r["item_id"]: (r["status"], r["n_candidates"]) for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert got == {1: ("review_required", 2), 2: ("review_required", 2), 3: ("confirmed", 1)}
    assert QUERIES["e12_listing_scores"](spark, str(tmp_path)).count() == 5


def test_pruned_registry_choice_equals_all_pairs(spark):
    """Decisions from pruned candidates against all pairs scored, with ties, identifiers, makers, packs and forms."""
    import random

    from prodlake.operators import resolve as E

    draw = random.Random(4)
    words = ["게보린", "정", "시럽", "plus", "a", "10mg", "20mg", "유한", "연고", "(1+1)", "타이레놀"]
    name = lambda: draw.choice([None, "", *[" ".join(draw.choices(words, k=draw.randrange(1, 4))) for _ in range(12)]])
    items = spark.createDataFrame([(k, name(), draw.choice(["10정", "", None]), draw.choice(["유한", "유한양행", "", None]), draw.choice(["", "1", "2", "3"])) for k in range(60)], "item_id int, name string, capacity string, manufacturer_hint string, barcode string")
    rows = [(str(k), name(), draw.choice(["10tab", "5정", ""]), draw.choice(["유한양행", "(주)동화", ""]), draw.choice(["정제", "", None]), draw.choice(["", "2", "7"])) for k in range(80)]
    registry = spark.createDataFrame(rows, "official_product_key string, item_name string, pack_unit string, manufacturer string, dosage_form string, official_barcode string")
    one = F.array(F.lit("all"))
    every = E.registry_choice(items, E.registry_points(E.candidates(items, registry, one, one))).collect()
    live = E.pruned_candidates(items, registry, one, one)
    pruned = E.registry_choice(items, E.pruned_scores(live)).collect()
    assert sorted(map(tuple, pruned)) == sorted(map(tuple, every))
    assert live.count() < 60 * 80 / 2


def test_items_alike_are_scored_once(spark, tmp_path):
    """Forty equal items make no more pairs than one, nulls included, and all are decided like it."""
    from prodlake.operators import resolve as E
    from prodlake.plans import QUERIES

    rows = [(k, "cold widget", "Brand#1", 5, "PROMO") for k in range(1, 41)] + [(k, None, "Brand#2", 9, "PROMO") for k in range(41, 44)]
    part = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int, p_type string")
    seen = []
    items = part.selectExpr("p_partkey as item_id", "p_name as name", "p_brand as maker")
    out = E.each_kind_once(items, ["name", "maker"], lambda kinds: seen.append(kinds.count()) or kinds.select("item_id", (F.col("item_id") + 1).alias("score")))
    assert seen == [2] and sorted(map(tuple, out.collect())) == [(k, 2) for k in range(1, 41)] + [(k, 42) for k in range(41, 44)]
    part.where("p_name is not null").write.parquet(f"{tmp_path}/part.parquet")
    for name in ("e01_e02_registry_choice", "e02_registry_choice_whole_levenshtein", "e03_e06_search_choice", "e12_listing_scores", "e09_two_phase", "e07_e08_deep_choice"):
        got = QUERIES[name](spark, str(tmp_path)).collect()
        assert sorted(r["item_id"] for r in got) == list(range(1, 41)) and len({tuple(v for k, v in r.asDict().items() if k != "item_id").__repr__() for r in got}) == 1


def test_ratio_bounds_hold(spark):
    import random

    from prodlake.functions.similarity import matching_blocks_ratio
    from prodlake.operators import resolve as E

    draw = random.Random(9)
    text = lambda: draw.choice(["".join(draw.choices("가나다 ab1", k=draw.randrange(12))), " ".join(draw.choices(["가나", "다라마", "ab1", "x"], k=4)), "가나다" * 90])
    pairs = spark.createDataFrame([(text(), text()) for _ in range(2000)], "a string, b string")
    facts = E.name_facts(E.name_facts(pairs, "a", "_a"), "b", "_b")
    least, most = E.ratio_bounds("_a", "_b")
    got = facts.select(least.alias("low"), matching_blocks_ratio(F.col("_a_name"), F.col("_b_name")).alias("r"), most.alias("high")).collect()
    assert all(r["low"] <= r["r"] + 1e-12 and r["r"] <= r["high"] + 1e-12 for r in got)


def test_korean_order(spark):
    """Digits by value, Hangul by syllable, then Latin without regard to case and accents; equal names by place."""
    ordered = [None, "2정", "10정", "가", "가나", "각", "비타민 2", "비타민 10", "비타민 10 골드", "Ábc", "abc", "ABC", "abc 2", "ABC 010", "zoo"]
    rows = [(k, n) for k, n in enumerate(ordered)]
    df = spark.createDataFrame([rows[k] for k in (7, 3, 12, 0, 5, 1, 14, 9, 2, 11, 4, 13, 6, 10, 8)], "pos int, name string").withColumns({"price": F.lit(1), "updated": F.lit(""), "category": F.lit("x")})
    got = [r["pos"] for r in df.repartition(4).orderBy(*C.order_of("name")).collect()]
    assert got == list(range(len(ordered)))
    paged = [r["place"] for r in C.page_of(df, C.CatalogQuery(sort="category", page_size=25)).orderBy("pos").collect()]
    assert paged == list(range(1, len(ordered) + 1))
