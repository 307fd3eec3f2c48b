"""Details of confirmed products over the driver's tables (T-23, T-24, E-13, P-12 to P-14, K-12, V-04, V-06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.operators import details as D
from prodlake.operators import resolve as E
from prodlake.operators import shapes as S
from prodlake.operators.audit import json_errors
from prodlake.plans.audit_queries import _ITEM, _SCORED, _brand_and_word, _levenshtein_ratio, _met, _sides
from prodlake.plans.registry import query
from prodlake.session import CATALOG_SQL, catalog, spread, table
from prodlake.sources.writers import record_errors


@query(
    "t23_t24_upstream",
    """select c_custkey, case when c_custkey % 2 = 0 then 'a' || c_custkey || ',' || c_mktsegment else 'a' || c_custkey end as parts, c_name || ' / 5:A1;' || c_mktsegment || ':' as ingredients, c_name || '|' || case when c_custkey % 3 = 0 then '' else 'x' end as maker,
    'h1=' || c_name || ';h2=' as history from customer""",
)
def upstream(spark, sf_dir):
    key = F.col("c_custkey")
    part = F.concat(F.lit("a"), key.cast("string"))
    text = F.when(key % 2 == 0, F.concat(part, F.lit("<br>"), "c_mktsegment", F.lit("#"), part)).otherwise(F.concat(part, F.lit("@ ")))
    listed = F.concat(F.lit("<a href='?ingd_code=A1'>"), "c_name", F.lit("</a>@5|"), "c_mktsegment", F.lit("| "))
    made = F.when(key % 3 == 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit("|x")))
    shown = lambda a, sep, *names: F.array_join(F.transform(a, lambda i: F.concat_ws(sep, *[i[n] for n in names])), ";")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.array_join(D.split_texts(text), ",").alias("parts"), shown(D.ingredients(listed), ":", "label", "code").alias("ingredients"),
        F.concat_ws("|", D.manufacturer(made)["name"], D.manufacturer(made)["english_name"]).alias("maker"), shown(D.insurance_history(F.concat(F.lit("h1|"), "c_name", F.lit("^ ^h2"))), "=", "code", "detail").alias("history"),
    )


@query(
    "e13_deep_variants",
    """with n as (select p_partkey, regexp_replace(lower(p_name), '[^0-9a-z가-힣+]', '', 'g') as s, p_size from part)
    select p_partkey, array_to_string(list_slice(list_distinct_ordered, 1, 8), ',') as variants from (select p_partkey, list_filter([s || p_size || '정', s, case when length(s) >= 5 then substr(s, 1, greatest(4, length(s) - 1)) end, case when length(s) >= 5 then substr(s, 1, 4) end, case when length(s) >= 5 then substr(s, 1, 3) end], lambda x: x is not null) as list_distinct_ordered from n)""",
)
def deep_variants(spark, sf_dir):
    rows = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")).select("p_partkey", F.concat("p_name", F.lit(" "), "p_size", F.lit("정")).alias("name"), F.concat("p_size", F.lit("정")).alias("capacity"))
    return D.deep_variants(rows, "name", "capacity").select("p_partkey", F.array_join("variants", ",").alias("variants"))


@query(
    "p14_alternatives_levenshtein",
    f"""with {_SCORED}, r as (select *, row_number() over (partition by item_id order by score desc, k) as rn from s), t as (select r.*, reg.p_name, reg.p_brand from r join reg using (k) where rn <= 10)
    select item_id, string_agg(k || ':' || score || ':' || p_name || ':' || p_brand, ';' order by rn) as alternatives from t group by 1""",
)
def alternatives(spark, sf_dir):
    items, registry = _sides(spark, sf_dir)
    found = lambda kinds: D.alternatives_of(E.registry_points(_met(kinds, registry, _brand_and_word), _levenshtein_ratio()))
    shown = F.transform("alternatives", lambda a: F.concat_ws(":", a["official_product_key"], a["score"].cast("string"), a["item_name"], a["manufacturer"]))
    return E.each_kind_once(items, _ITEM, lambda kinds: found(kinds).select("item_id", F.array_join(shown, ";").alias("alternatives")))


def _confirmed(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    texts = {"drug_name": F.col("p_name"), "drug_code": key, "effect": F.concat(F.lit("<p>"), "p_type", F.lit("</p>")), "dosage": F.when(size % 2 == 0, "twice a day").otherwise(" "), "caution": F.lit("none"), "stmt": F.lit("cool"), "drug_form": F.lit("정"),
             "dosage_route": F.lit("oral"), "drug_box": F.concat("p_size", F.lit("정")), "upso_name": F.concat("p_brand", F.lit("|EN")), "sunb": F.concat(F.lit("<a href='?ingd_code=A1'>"), "p_name", F.lit("</a>@5|")), "charact": F.lit("white"), "additives": F.lit("a#b")}
    images = F.when(size % 3 == 0, F.array(*[F.struct(F.concat(F.lit(f"https://common.health.kr/{k}/"), key).alias("url"), F.lit(k).alias("kind")) for k in ("pill", "package")]))
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), key.alias("code"), (size + 45).alias("score"), F.array(F.lit("core names agree")).alias("reasons"), F.array().cast("array<string>").alias("conflicts"),
        F.create_map(*[v for k, c in texts.items() for v in (F.lit(k), c)]).alias("raw"), images.alias("images"), F.array(F.lit(""), F.lit("https://aux")).alias("aux_urls"), "p_size",
    )
    return D.confirmed_records(rows, "2024-01-01T00:00:00+00:00")


@query(
    "p12_confirmed_records",
    """select p_partkey as id, p_name as official_item_name, p_brand as official_manufacturer, p_type as official_efficacy, case when p_size % 2 = 0 then 'twice a day' else '' end as official_dosage, p_name || ' / 5' as ingredients, 'white' as official_appearance,
    'a,b' as additives, 'https://www.health.kr/searchDrug/result_drug.asp?drug_cd=' || p_partkey as official_source_url, p_size + 45 as official_match_score, case when p_size % 2 = 0 then 'complete' else 'partial' end as official_content_status,
    case when p_size % 3 = 0 then 'https://common.health.kr/package/' || p_partkey else '' end as image_url, case when p_size % 3 = 0 then 'package' else '' end as image_kind,
    'ingredients,efficacy,' || case when p_size % 2 = 0 then 'dosage,' else '' end || 'precautions,storage,manufacturer,dosage_form,route,package' || case when p_size % 3 = 0 then ',images' else '' end as verified from part""",
)
def confirmed_records(spark, sf_dir):
    rows = _confirmed(spark, sf_dir)
    return rows.select(
        "id", "official_item_name", "official_manufacturer", "official_efficacy", "official_dosage", F.array_join("official_ingredients", ",").alias("ingredients"), "official_appearance", F.array_join("official_additives", ",").alias("additives"),
        "official_source_url", "official_match_score", "official_content_status", "image_url", "image_kind", F.array_join("official_section_evidence.verified_fields", ",").alias("verified"),
    )


_BROKEN = ("bad_match_score", "bad_status", "duplicate_image", "bad_image_item", "invalid_image_domain", "invalid_image_kind", "image_source_mismatch", "image_not_probed", "confirmed_enrichment_status", "confirmed_content_status",
           "confirmed_bad_domain", "confirmed_missing_checked_at", "missing_evidence_key", "missing_raw_detail", "raw_code_mismatch", "normalized_text_mismatch", "representative_not_in_images", "bad_image_rights", "image_metadata_without_image",
           "nonconfirmed_content_status", "nonconfirmed_enrichment_status", "nonconfirmed_official_data", "nonconfirmed_image_data", "additive_contains_html", "confirmed_missing_item_seq")
_CODES = ", ".join(f"({k}, '{c}')" for k, c in enumerate(_BROKEN))


@query(
    "v06_enrichment_audit",
    f"""with c as (select * from (values {_CODES}) as t(k, code)), p as (select p_partkey as id, (p_partkey % 40) as k, p_size from part)
    select cast(id as varchar) as id, code, '' as field from p join c using (k)
    union all select cast(id as varchar), 'confirmed_bad_source', '' from p where k = 24
    union all select cast(id as varchar), 'raw_code_mismatch', '' from p where k = 24
    union all select cast(id as varchar), 'changed_original_field', 'name' from p where k = 30
    union all select '', 'original_count', '' union all select '', 'result_count', '' union all select '', 'missing_official_field', 'official_udi_di' union all select '', 'wrong_array_type', 'official_storage' union all select '', 'wrong_object_type', 'official_efficacy'
    union all select '', 'missing_original_field', 'price'""",
)
def enrichment_audit(spark, sf_dir):
    """Records that are right, each fortieth of them made wrong in another way."""
    rows = _confirmed(spark, sf_dir).drop("official_udi_di").withColumn("id", F.col("id").cast("string"))
    k = F.col("id").cast("int") % 40
    is_ = lambda code: k == _BROKEN.index(code)
    page, other = F.col("official_source_url"), k.isin(*[_BROKEN.index(c) for c in _BROKEN if c.startswith("nonconfirmed")])
    image = lambda url, kind, source: F.struct(url.alias("url"), F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), source.alias("source_url"))
    good = F.concat(F.lit("https://common.health.kr/pill/"), "id")
    first = image(F.when(is_("invalid_image_domain"), F.concat(F.lit("https://elsewhere.example.org/"), "id")).otherwise(good), F.when(is_("invalid_image_kind"), "photo").otherwise("pill"), F.when(is_("image_source_mismatch"), "https://x").otherwise(page))
    bare = other | is_("image_metadata_without_image")
    images = F.when(bare, F.array().cast("array<struct<url:string,kind:string,source_url:string>>")).when(is_("duplicate_image"), F.array(first, first)).when(is_("bad_image_item"), F.array(first, F.lit(None))).otherwise(F.array(first))
    texts = [c for c in rows.columns if c.startswith("official_") and dict(rows.dtypes)[c] == "string" and c not in ("official_match_status", "official_checked_at", "official_content_status")]
    lists = [c for c in rows.columns if c.startswith("official_") and dict(rows.dtypes)[c].startswith("array") and c != "official_images"]
    empty = {c: F.when(other, F.array().cast(dict(rows.dtypes)[c])).otherwise(F.col(c)) for c in lists} | {c: F.when(other, "").otherwise(F.col(c)) for c in texts if c != "official_storage"}
    empty |= {"official_storage": F.when(is_("nonconfirmed_official_data"), "cool").when(other, "").otherwise(F.col("official_storage")), "official_match_score": F.when(is_("bad_match_score"), 101).when(other, 0).otherwise(F.col("official_match_score")),
              "official_consumer_guidance": F.when(other, F.create_map().cast("map<string,string>")).otherwise(F.col("official_consumer_guidance"))}
    for c in ("official_section_evidence", "official_manufacturer_details"):
        empty[c] = F.when(~other & ~(is_("missing_evidence_key") if c.endswith("evidence") else F.lit(False)), F.col(c))
    bent = rows.withColumns({"_images": images, "_page": page}).withColumns(empty)
    bent = bent.withColumns(
        {
            "official_images": F.col("_images"), "probed": F.when(is_("image_not_probed"), F.array().cast("array<string>")).otherwise(F.transform("_images", lambda i: i["url"])),
            "official_match_status": F.when(is_("bad_status"), "sure").when(other, "review_required").otherwise("confirmed"),
            "enrichment_status": F.when(is_("confirmed_enrichment_status") | is_("nonconfirmed_enrichment_status"), "x").when(other, "official_review_required").otherwise("official_details_linked"),
            "official_content_status": F.when(is_("confirmed_content_status") | is_("nonconfirmed_content_status"), "x").when(other, "").otherwise(F.col("official_content_status")),
            "official_domain": F.when(is_("confirmed_bad_domain"), "x").otherwise(F.col("official_domain")), "official_checked_at": F.when(is_("confirmed_missing_checked_at"), "").otherwise(F.col("official_checked_at")),
            "official_item_seq": F.when(is_("confirmed_missing_item_seq"), "").otherwise(F.col("official_item_seq")),
            "raw": F.when(~is_("missing_raw_detail"), F.when(is_("raw_code_mismatch"), F.map_concat(F.map_filter("raw", lambda n, _: n != "drug_code"), F.create_map(F.lit("drug_code"), F.lit("x")))).otherwise(F.col("raw"))),
            "official_efficacy": F.when(is_("normalized_text_mismatch"), "other").otherwise(F.col("official_efficacy")),
            "image_url": F.when(is_("representative_not_in_images") | is_("image_metadata_without_image") | is_("nonconfirmed_image_data"), "https://x").when(bare, "").otherwise(F.get("_images", F.lit(0))["url"]),
            "image_kind": F.when(bare, "").otherwise("pill"), "image_source_url": F.when(bare, "").otherwise(F.col("_page")), "image_checked_at": F.when(bare, "").otherwise("t"),
            "image_rights_status": F.when(is_("bad_image_rights"), "verified").when(bare, "").otherwise("official_source_preview"),
            "official_additives": F.when(is_("additive_contains_html"), F.array(F.lit("a<b>"))).otherwise(F.col("official_additives")),
        }
    )
    names = catalog(spark, sf_dir).select("pos", "id", "name")
    after = bent.drop("_images", "_page", "p_size").join(names.select("id", "pos", F.when(F.col("id").cast("int") % 40 == 30, "other").otherwise(F.col("name")).alias("name")), "id")
    return D.enrichment_audit(names, after, "id", ["name", "price"], -1, arrays=("official_storage", "official_additives"), maps=("official_efficacy", "official_section_evidence"))


@query(
    "k12_review_queue_full",
    f"""with c as (select *, row_number() over (order by pos) as n from {CATALOG_SQL}) select cast(floor((n - 1) / 25) + 1 as bigint) as batch_no, n as source_order, id as catalog_product_id, name as catalog_name, capacity as catalog_capacity, category as catalog_category, price as catalog_price,
    case when pos % 3 = 0 then 'pending' when pos % 3 = 1 then 'found' else 'not_found' end as lookup_status, case when pos % 3 = 0 then 'pending' when pos % 3 = 1 then 'confirmed' else 'not_found' end as match_status,
    case when pos % 3 = 1 then 'drug:' || id else '' end as official_product_key, case when pos % 3 = 1 then 'drug' when pos % 3 = 2 then 'food' else '' end as official_domain, case when pos % 3 = 1 then id when pos % 3 = 2 then 'alt' else '' end as official_item_seq,
    case when pos % 3 = 1 then name when pos % 3 = 2 then 'other' else '' end as official_name, '' as official_manufacturer, '' as official_dosage_form, case when pos % 3 = 0 then '' else 'box' end as official_pack_unit, '' as official_barcode,
    case when pos % 3 = 1 then 'd1' when pos % 3 = 2 then 'd2' else '' end as official_dataset_id, '' as official_source_url, '' as official_efficacy, '' as official_dosage, '' as official_precautions, '[]' as official_ingredients_json, '[]' as official_images_json,
    case when pos % 3 = 0 then '' else cast(official_match_score as varchar) end as match_score, case when pos % 3 = 0 then '' else 'name=' || official_match_score end as match_reason, case when pos % 3 = 2 then '["form"]' else '[]' end as conflict_reasons_json,
    case when pos % 3 = 0 then '' else 'me' end as reviewer, '' as reviewed_at from c""",
)
def review_queue(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    found = F.col("pos") % 3 == 1
    other = F.struct(*[v.alias(k) for k, v in {"source_domain": F.lit("food"), "item_seq": F.lit("alt"), "item_name": F.lit("other"), "manufacturer": F.lit(""), "dosage_form": F.lit(""), "pack_unit": F.lit("box"), "barcode": F.lit(""), "source_dataset_id": F.lit("d2"), "source_url": F.lit("")}.items()])
    matches = rows.where("pos % 3 <> 0").select(
        "id", F.when(found, "confirmed").otherwise("not_found").alias("status"), F.when(found, F.concat(F.lit("drug:"), "id")).otherwise("").alias("official_product_key"), F.col("official_match_score").alias("score"),
        F.create_map(F.lit("name"), F.col("official_match_score")).alias("score_components"), F.when(found, F.array().cast("array<string>")).otherwise(F.array(F.lit("form"))).alias("conflicts"), F.lit("me").alias("reviewer"), F.lit(None).cast("string").alias("reviewed_at"), F.array(other).alias("alternatives"),
    )
    records = rows.where(found).select(S.empty_record(F.lit("drug"), F.lit("d1"), F.col("id"), F.col("name")).alias("r")).select("r.*")
    return D.review_queue(rows, matches, records)


@query(
    "v04_record_errors",
    """select cast(p_partkey as varchar) as key, 'schema' as code from part where p_size % 7 = 0 union all select cast(p_partkey as varchar), 'literal_null' from part where p_size % 5 = 0
    union all select cast(p_partkey as varchar), 'only_in_first' from part where p_size % 11 = 0 union all select cast(p_partkey as varchar), 'only_in_second' from part where p_size % 11 = 0
    union all select null, 'wrong_number'""",
)
def package_records(spark, sf_dir):
    size = F.col("p_size")
    records = table(spark, sf_dir, "part").select("p_partkey", F.when(size % 7 == 0, "").otherwise(F.col("p_name")).alias("name"), F.when(size % 5 == 0, "undefined").otherwise(F.col("p_type")).alias("type"))
    other = table(spark, sf_dir, "part").select("p_partkey", F.when(size % 7 == 0, "").otherwise(F.col("p_name")).alias("name"), F.when(size % 11 == 0, "changed").when(size % 5 == 0, "undefined").otherwise(F.col("p_type")).alias("type"))
    schema = {"type": "object", "properties": {"name": {"type": "string", "minLength": 1}}}
    return record_errors(records, other, "p_partkey", -1, json_errors(schema), {"literal_null": r"\b(?:undefined|nan)\b"})
