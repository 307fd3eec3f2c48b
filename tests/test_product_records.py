"""Rules of product records beyond the registered queries: empty tables and single cases."""

from __future__ import annotations

import json

from prodlake.operators.product_records import TEXT_FIELDS, baseline_errors, portable_records, product_errors

FIELDS = ["id", "name", "official_match_status", "official_content"]


def rows(spark, records):
    return spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records, 1)], "place long, record string")


def test_baselines(spark):
    fine = {"id": "a", "name": "x", "official_match_status": "confirmed", "official_content": {}}
    other = {"id": "b", "name": "x", "official_match_status": None}
    assert baseline_errors(rows(spark, [fine, other]), "place", "record", 2, FIELDS).collect() == []
    wrong = [fine | {"source_order": 1}, other | {"official_content": 1}, other | {"source_order": True}, [], {"id": 5}]
    got = {tuple(r) for r in baseline_errors(rows(spark, wrong), "place", "record", 4, FIELDS).collect()}
    assert {(1, "row_fields"), (2, "row_fields"), (2, "official_content"), (2, "source_order"), (2, "repeated_id"), (3, "repeated_id"), (3, "source_order"), (4, "not_an_object"), (5, "id_missing"), (None, "row_count"), (None, "field_union")} <= got
    assert {r["code"] for r in baseline_errors(rows(spark, [fine]).limit(0), "place", "record", 0, FIELDS).collect()} == {"field_union"}


def test_empty_products(spark):
    empty = rows(spark, [{}]).limit(0)
    assert product_errors(empty, "place", "record").collect() == []
    got = {tuple(r) for r in product_errors(rows(spark, [{"more": 1, "official_x": 2}]), "place", "record").collect()}
    assert (1, "unknown_field:more") in got and (1, "not_text:id") in got and (1, "price_not_positive") in got and not any("official_x" in c for _, c in got)


def test_a_record_is_parsed_once(spark):
    """Before, each branch of the plan parsed it for itself, and filters once more for every field they asked."""
    full = {f: "x" for f in TEXT_FIELDS} | {"displayed_price_krw": 1, "source_order": 1}
    found = product_errors(rows(spark, [full, full | {"name": " \u3000", "etc": " "}, full | {"id": None}]), "place", "record")
    assert "parseJson" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = {(2, "empty:name"), (2, "repeated_id"), (3, "not_text:id"), *((k, "repeated_document_id") for k in (2, 3))}
    assert {tuple(r) for r in found.collect()} == want


def test_a_portable_record_of_few_columns(spark):
    df = spark.createDataFrame([("d", " n ", None, 5, "confirmed"), (None, None, "c", None, "x")], "document_id string, name string, capacity string, price int, official_match_status string")
    one, two = (r.asDict(recursive=True) for r in portable_records(df).orderBy("product_id", ascending=False).collect())
    assert one["product_id"] == "d" and one["display"]["name"] == "n" and one["display"]["price_krw"] == 5 and one["medicine"]["identity"]["item_name"] is None and one["media"]["primary_image"] is None
    assert two["product_id"] == "" and two["medicine"] is None and two["display"]["specification"] == "c" and two["ai_context"].startswith("상품명: \n\n규격: c")
