"""Product records whole: the rules of raw records (V-01), the portable record (P-06, P-07), and the audit of image research (V-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.functions.text import blank, trim_space
from prodlake.session import stash

# Fields of a product.
TEXT_FIELDS = (
    "document_id", "id", "name", "capacity", "category", "price", "etc", "updated", "app_id", "app_name", "app_capacity", "app_category", "app_price", "app_etc", "app_updated",
    "document_create_time", "document_update_time", "specification", "normalized_name", "normalized_capacity", "source_type", "recorded_at", "price_status", "verification_status",
    "image_url", "image_source_url", "image_rights_status",
)
MAY_BE_EMPTY = ("etc", "app_etc", "document_create_time", "document_update_time", "image_url", "image_source_url", "image_rights_status")
OTHER_FIELDS = ("displayed_price_krw", "source_order", "duplicate_group_id", "duplicate_group_size", "image_kind", "image_checked_at", "enrichment_status", "match_alternatives")
# Hosts that are no product's page, and marks of pictures that stand for none.
SEARCH_HOSTS = ("search.naver.com", "search.pstatic.net", "www.google.com", "google.com", "www.bing.com", "search.daum.net", "search.danawa.com")
PLACEHOLDERS = ("noimg", "no_image", "placeholder", "19_limited", "default-image")
STATUSES = ("confirmed", "review_required", "not_found")
LEAST_SIDE = 150
GUARDED = (401, 403, 429)
# The portable record's identity fields with their columns, and the labels of its text.
IDENTITY = (
    ("item_name", "official_item_name"), ("item_code", "official_item_seq"), ("manufacturer", "official_manufacturer"), ("english_name", "official_english_name"), ("category", "official_category"),
    ("classification_code", "official_classification_code"), ("dosage_form", "official_dosage_form"), ("route", "official_route"), ("pack_unit", "official_pack_unit"), ("atc_code", "official_atc_code"),
)
IDENTITY_LABELS = (("약학정보원 품목명", "item_name"), ("제조사", "manufacturer"), ("제형", "dosage_form"), ("포장단위", "pack_unit"))
SECTION_LABELS = (("효능·효과", "efficacy"), ("용법·용량", "dosage"), ("사용상의 주의사항", "precautions"), ("복약 안내", "medication_guide"))


def product_errors(records: DataFrame, place: str, record: str) -> DataFrame:
    """V-01: (place, code) of every rule that a raw JSON record breaks, and codes of repeated ids for all but their first record.

    Codes: not_an_object, unknown_field:<name>, not_text:<field>, empty:<field>, price_not_positive, order_not_positive,
    repeated_id, repeated_document_id. A record that is no object, or not JSON, has the first code alone. The first
    record of an id is the one of the smallest place. Records are parsed once; what was found is written to the shared folder.
    """
    value = F.col("_value")
    kind = lambda field: F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
    number = lambda field: F.when(kind(field).rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, f"$.{field}", "double"))
    # each step is a few expressions over the last one's columns, and no filter stands above them: a rule that asks again,
    # or a filter that moves below, would parse the record once more
    parsed = records.select(F.col(place).alias("place"), F.col(record).alias(record)).withColumn("_value", F.try_parse_json(record))
    asked = parsed.select(
        "place",
        F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False)).alias("_object"),
        F.coalesce(F.json_object_keys(record), F.array().cast("array<string>")).alias("_keys"),
        F.array(*[F.when(kind(f) == "STRING", F.try_variant_get(value, f"$.{f}", "string")) for f in TEXT_FIELDS]).alias("_texts"),
        number("displayed_price_krw").alias("_price"),
        number("source_order").alias("_order"),
    )
    text = lambda field: F.get("_texts", F.lit(TEXT_FIELDS.index(field)))
    unknown = F.filter("_keys", lambda k: ~k.isin(*TEXT_FIELDS, *OTHER_FIELDS) & ~F.startswith(k, F.lit("official_")))
    order = F.col("_order")
    codes = [
        *[F.when(text(f).isNull(), F.lit(f"not_text:{f}")) for f in TEXT_FIELDS],
        *[F.when(~text(f).rlike(r"(?U)\S"), F.lit(f"empty:{f}")) for f in TEXT_FIELDS if f not in MAY_BE_EMPTY],
        F.when(~F.coalesce(F.col("_price") > 0, F.lit(False)), F.lit("price_not_positive")),
        F.when(~F.coalesce((order > 0) & (order == F.floor(order)), F.lit(False)), F.lit("order_not_positive")),
    ]
    found = F.concat(F.transform(unknown, lambda k: F.concat(F.lit("unknown_field:"), k)), F.filter(F.array(*codes), lambda c: c.isNotNull()))
    ids = [F.when(F.col("_object"), text(f)).alias(f) for f in ("id", "document_id")]
    judged = stash(asked.select("place", F.when(F.col("_object"), found).otherwise(F.array(F.lit("not_an_object"))).alias("codes"), *ids))
    out = judged.select("place", F.explode("codes").alias("code"))
    for field, code in (("id", "repeated_id"), ("document_id", "repeated_document_id")):
        stated = judged.select("place", F.col(field).alias("key")).where("key is not null")
        firsts = stated.groupBy("key").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
        out = out.union(stated.join(firsts, "key").where("place > first").select("place", F.lit(code).alias("code")))
    return out


def _or_null(df: DataFrame, column: str) -> Column:
    """The trimmed text of a column; null if blank or absent."""
    return F.nullif(trim_space(F.col(column).cast("string")), F.lit("")) if column in df.columns else F.lit(None).cast("string")


def portable_records(df: DataFrame) -> DataFrame:
    """P-06 and P-07: the nested portable record of each product with its text. Columns that df lacks count as blank.

    official_content is a struct of sections with `text`; official ingredients are arrays; prices and orders whole numbers.
    """
    c = lambda name: _or_null(df, name)
    whole = lambda *names: F.coalesce(*[F.nullif(F.col(n).cast("long"), F.lit(0)) for n in names if n in df.columns], F.lit(0).cast("long"))
    items = lambda name: F.coalesce(F.col(name), F.array().cast("array<string>")) if name in df.columns else F.array().cast("array<string>")
    has_content = "official_content" in df.columns
    sections = [f.name for f in df.schema["official_content"].dataType.fields] if has_content else []
    medicine = F.when(
        F.col("official_match_status") == "confirmed",
        F.struct(
            F.struct(*[c(source).alias(name) for name, source in IDENTITY]).alias("identity"),
            *([F.col("official_content").alias("content")] if has_content else []),
            F.struct(items("official_active_ingredients").alias("active"), items("official_ingredients").alias("all"), items("official_additives").alias("additives")).alias("ingredients"),
            c("official_storage").alias("storage"),
            c("official_appearance").alias("appearance"),
            F.struct(c("official_source_type").alias("type"), c("official_source_url").alias("url"), c("official_checked_at").alias("checked_at")).alias("source"),
        ),
    )
    image = F.when(c("image_url").isNotNull(), F.struct(c("image_url").alias("url"), c("image_source_url").alias("source_url"), c("image_kind").alias("kind"), c("image_rights_status").alias("rights_status"), c("image_checked_at").alias("checked_at")))
    text = lambda name: F.coalesce(c(name), F.lit(""))
    record = df.select(
        F.lit("1.0").alias("schema_version"),
        F.coalesce(c("document_id"), c("id"), F.lit("")).alias("product_id"),
        F.struct(
            text("name").alias("name"), F.coalesce(c("capacity"), c("specification"), F.lit("")).alias("specification"), text("category").alias("category"),
            whole("displayed_price_krw", "price").alias("price_krw"), c("etc").alias("notes"), whole("source_order").alias("source_order"),
        ).alias("display"),
        F.struct(image.alias("primary_image")).alias("media"),
        medicine.alias("medicine"),
        F.struct(*[c(n).alias(n) for n in ("verification_status", "official_match_status", "official_content_status", "image_rights_status")]).alias("quality"),
        F.struct(c("source_type").alias("catalog_source_type"), c("recorded_at").alias("catalog_recorded_at"), c("document_update_time").alias("catalog_document_updated_at")).alias("provenance"),
    )
    d, m = F.col("display"), F.col("medicine")
    labelled = lambda label, value, gap=" ": F.when(value.isNotNull() & (value != ""), F.concat(F.lit(f"{label}:{gap}"), value))
    lines = [
        F.concat(F.lit("상품명: "), d["name"]), F.concat(F.lit("규격: "), d["specification"]), F.concat(F.lit("분류: "), d["category"]), F.concat(F.lit("가격(원): "), d["price_krw"]),
        *[labelled(label, m["identity"][name]) for label, name in IDENTITY_LABELS],
        *[labelled(label, trim_space(m["content"][name]["text"]), "\n") for label, name in SECTION_LABELS if name in sections],
        labelled("약학정보원 출처", m["source"]["url"]),
        labelled("제품 이미지 출처", F.col("media.primary_image.source_url")),
    ]
    return record.withColumn("ai_context", F.concat_ws("\n\n", *lines))


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def is_product_page(url: Column) -> Column:
    """F-17: an address on a host that is no search's."""
    return (_host(url) != "") & ~_host(url).isin(*SEARCH_HOSTS)


def image_allowed(url: Column) -> Column:
    """F-17: a secure address on no search host that names no stand-in picture."""
    return is_product_page(url) & F.startswith(F.lower(url), F.lit("https://")) & ~F.lower(url).rlike("|".join(PLACEHOLDERS))


def research_errors(queue: DataFrame, results: DataFrame, pages: DataFrame, images: DataFrame) -> DataFrame:
    """V-13: (pos, product_id, code) of each row of image research that breaks a rule.

    queue: pos, product_id. results: pos, product_id, status, candidate_name, n_evidence, source_url, image_url. pages: url,
    status. images: url, status, final_url, content_type, width, height, sha256 (null where nothing could be decoded). Both
    have a row an address. Codes of order come first: order_differs where a place holds another id, or none, on one
    side, and repeated_id; the others are the rows' own.
    """
    q = queue.select("pos", F.col("product_id").alias("wanted"))
    order = q.join(results.select("pos", F.col("product_id").alias("found")), "pos", "full")
    differs = order.where(~F.col("wanted").eqNullSafe(F.col("found"))).select("pos", F.coalesce("found", "wanted").alias("product_id"), F.lit("order_differs").alias("code"))
    times = results.groupBy("product_id").agg(F.count("*").alias("n")).where("n > 1").select("product_id")
    again = results.join(times, "product_id").select("pos", "product_id", F.lit("repeated_id").alias("code"))
    status, source, image = blank(F.col("status")), blank(F.col("source_url")), blank(F.col("image_url"))
    confirmed = status == "confirmed"
    p = pages.select(F.col("url").alias("source_url"), F.col("status").alias("page_status"))
    i = images.select(F.col("url").alias("image_url"), F.col("status").alias("image_status"), "final_url", "content_type", "width", "height", "sha256")
    probed = results.join(p, "source_url", "left").join(i, "image_url", "left")
    # a page or an image that is no candidate's is not fetched
    page_status = F.when(is_product_page(source), F.coalesce("page_status", F.lit(0))).otherwise(0)
    ok = lambda s: (s >= 200) & (s < 400)
    decoded = image_allowed(image) & F.coalesce(ok(F.col("image_status")), F.lit(False)) & image_allowed(F.coalesce("final_url", image)) & ~F.startswith(F.lower(blank(F.col("content_type"))), F.lit("text/html")) & F.col("width").isNotNull() & F.col("height").isNotNull()
    small = ~decoded | (F.col("width") < LEAST_SIDE) | (F.col("height") < LEAST_SIDE)
    judged = probed.withColumns({"_decoded": confirmed & decoded, "_digest": F.when(confirmed & decoded, F.nullif("sha256", F.lit("")))})
    codes = [
        F.when(~status.isin(*STATUSES), "invalid_status"),
        F.when(confirmed & ~is_product_page(source), "source_is_not_product_page"),
        F.when(confirmed & ~ok(page_status) & ~page_status.isin(*GUARDED), "source_page_unreachable"),
        F.when(confirmed & ~F.col("_decoded"), "invalid_image_response"),
        F.when(confirmed & small, "image_too_small"),
        F.when(confirmed & ((blank(F.col("candidate_name")) == "") | (F.coalesce("n_evidence", F.lit(0)) == 0)), "missing_match_evidence"),
        F.when(~confirmed & ((image != "") | (source != "")), "unconfirmed_row_has_candidate_urls"),
    ]
    own = judged.select("pos", "product_id", F.explode(F.filter(F.array(*codes), lambda c: c.isNotNull())).alias("code"))
    digests = judged.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.count("*").alias("n")).where("n > 1").select("_digest")
    twins = judged.join(digests, "_digest").select("pos", "product_id", F.lit("duplicate_image_content_in_batch").alias("code"))
    return differs.union(again).union(own).union(twins)


def baseline_errors(records: DataFrame, place: str, record: str, expected_rows: int, fields: list[str]) -> DataFrame:
    """V-02: (place, code) of what breaks a baseline of raw JSON records, whose places run from 1; codes of the whole have no place.

    row_count, field_union; not_an_object, id_missing, repeated_id (every record of the id); source_order, where any record has
    one: it must be the record's place; row_fields: all `fields`, official_content among them only where the match is confirmed;
    official_content, where its presence and a confirmed match differ.
    """
    value = F.col("_value")
    kind = lambda field: F.coalesce(F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant")), F.lit(""))
    text = lambda field: F.when(kind(field) == "STRING", F.try_variant_get(value, f"$.{field}", "string"))
    has = lambda field: F.array_contains("_keys", field)
    rows = records.select(F.col(place).cast("long").alias("place"), F.try_parse_json(record).alias("_value"), F.array_sort(F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))).alias("_keys"))
    rows = rows.withColumn("_object", F.startswith(F.coalesce(F.schema_of_variant("_value"), F.lit("")), F.lit("OBJECT")))
    confirmed = F.coalesce(text("official_match_status") == "confirmed", F.lit(False))
    listed = lambda names: F.array(*[F.lit(n) for n in sorted(names)])
    whole, core = listed(fields), listed([f for f in fields if f != "official_content"])
    ordered = (kind("source_order") == "BIGINT") & (F.try_variant_get(value, "$.source_order", "long") == F.col("place"))
    # of the whole: rows, whether any has an order, and the union of their fields
    facts = rows.agg(F.count("*").alias("_n"), F.coalesce(F.bool_or(F.col("_object") & has("source_order")), F.lit(False)).alias("_any"))
    union = rows.where("_object").select(F.explode("_keys").alias("k")).distinct().agg(F.array_sort(F.collect_list("k")).alias("_union"))  # as many as there are field names
    n, any_order = facts.first()
    seen = union.first()["_union"]
    codes = [
        F.when(~F.col("_object"), "not_an_object"),
        F.when(F.col("_object") & (trim_space(text("id")) == ""), "id_missing"),
        *([F.when(F.col("_object") & ~F.coalesce(ordered, F.lit(False)), "source_order")] if any_order else []),
        F.when(F.col("_object") & (F.col("_keys") != F.when(confirmed, whole).otherwise(core)), "row_fields"),
        F.when(F.col("_object") & (has("official_content") != confirmed), "official_content"),
    ]
    own = rows.select("place", F.explode(F.filter(F.array(*codes), lambda c: c.isNotNull())).alias("code"))
    ids = rows.where("_object").select("place", text("id").alias("id")).where(trim_space(F.col("id")) != "")
    twice = ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    out = own.union(ids.join(twice, "id").select("place", F.lit("repeated_id").alias("code")))
    of_all = [c for c, wrong in (("row_count", n != expected_rows), ("field_union", sorted(seen) != sorted(fields))) if wrong]
    return out.union(records.sparkSession.createDataFrame([(None, c) for c in of_all], "place long, code string"))
