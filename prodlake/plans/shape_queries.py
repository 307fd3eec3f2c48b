"""Shapes of rows over the driver's tables (P-02 to P-04, P-08 to P-11, P-15, V-08, V-11, V-14, V-17, T-17 to T-20, T-22, X-04, S-08, S-10, U-08)."""

from __future__ import annotations


from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.operators import content as C
from prodlake.operators import shapes as S
from prodlake.operators.audit import findings, json_errors
from prodlake.plans.registry import query
from prodlake.session import CATALOG_SQL, catalog, table
from prodlake.sources.registry import SOURCES, requests


@query(
    "p03_derived",
    f"""select document_id, name as app_name, capacity as specification, cast(regexp_replace(cast(price as varchar), '[^0-9]', '', 'g') as bigint) as displayed_price_krw, regexp_replace(lower(name), '[^0-9a-z가-힣]', '', 'g') as normalized_name,
    row_number() over (order by document_id) as source_order, '미확인' as image_rights_status from {CATALOG_SQL}""",
)
def derived(spark, sf_dir):
    rows = catalog(spark, sf_dir).select("document_id", "name", "capacity", "price")
    return S.derived(rows, ["name", "capacity", "price"], "2024-01-01").select(
        "document_id", "app_name", "specification", "displayed_price_krw", "normalized_name", F.col("source_order").cast("long").alias("source_order"), "image_rights_status"
    )


@query("p02_p04_p11_columns", f"select document_id, name, category, price, official_match_status, 'pending' as enrichment_status, '' as image_kind from {CATALOG_SQL}")
def columns(spark, sf_dir):
    rows = S.with_defaults(catalog(spark, sf_dir))
    kept = S.visible_columns(["category", "price", "nothing", "category"], ("name",))
    return rows.select("document_id", *kept, "official_match_status", "enrichment_status", "image_kind")


@query(
    "p10_research_rows",
    f"""select row_number() over (order by pos) as queue_index, id as catalog_product_id, document_id, name as catalog_name, category as catalog_category, official_item_name, '' as official_pack_unit from {CATALOG_SQL} where image_url = ''""",
)
def research_rows(spark, sf_dir):
    rows = S.research_rows(catalog(spark, sf_dir).where("image_url = ''"), "pos")
    return rows.select(F.col("queue_index").cast("long").alias("queue_index"), "catalog_product_id", "document_id", "catalog_name", "catalog_category", "official_item_name", "official_pack_unit")


def _records(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    number = F.when(F.col("p_size") % 10 == 0, "").otherwise(F.col("p_partkey").cast("string"))
    return part.select("p_partkey", S.empty_record(F.lit("drug"), F.lit("d1"), number, F.col("p_name")).alias("r"))


@query(
    "p09_p15_candidate_view",
    "select 'drug:' || p_partkey as official_product_key, p_name as item_name, '' as manufacturer, cast(p_partkey as varchar) as item_seq, '' as barcode, 'drug' as source_domain, 'd1' as source_dataset_id from part where p_size % 10 <> 0",
)
def candidate_view(spark, sf_dir):
    rows = S.candidate_view(_records(spark, sf_dir).where("r is not null").select("r.*"))
    return rows.select("official_product_key", "item_name", "manufacturer", "item_seq", "barcode", "source_domain", "source_dataset_id")


@query(
    "v08_record_errors",
    """select p_partkey, code from (select p_partkey, unnest(list_filter([case when p_size % 6 = 0 then 'missing_item_name' end, case when p_size % 4 = 0 then 'key_of_other_domain' end, case when p_size % 5 = 1 then 'image_without_source' end], lambda x: x is not null)) as code
    from part where p_size % 10 <> 0)""",
)
def record_errors(spark, sf_dir):
    size = F.col("p_size")
    joined = _records(spark, sf_dir).where("r is not null").join(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey").select("p_partkey", "p_size", "r.*")
    image = F.array(F.struct(F.lit("https://x/a.png").alias("url"), F.lit("pill").alias("kind"), F.when(size % 5 == 1, "").otherwise("https://x").alias("source_url"), F.lit("l").alias("license")))
    bent = joined.withColumns({"item_name": F.when(size % 6 != 0, F.col("item_name")), "source_domain": F.when(size % 4 == 0, "food").otherwise(F.col("source_domain")), "images": image})
    return findings(bent, "p_partkey", S.record_rules())


@query(
    "v08_match_and_image_errors",
    """select p_partkey, code from (select p_partkey, unnest(list_filter([case when p_size % 7 = 0 then 'unknown_status' end, case when p_size > 40 then 'score_out_of_range' end, case when p_size % 3 = 0 then 'unknown_kind' end, case when p_size % 4 = 0 then 'not_https' end], lambda x: x is not null)) as code from part)""",
)
def match_and_image_errors(spark, sf_dir):
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(size % 7 == 0, "sure").otherwise("confirmed").alias("status"), F.when(size > 40, 101).otherwise(size).alias("score"), F.when(size % 3 == 0, "photo").otherwise("pill").alias("kind"),
        F.when(size % 4 == 0, "http://x/a").otherwise("https://x/a").alias("url"), F.lit("https://x").alias("source_url"),
    )
    return findings(rows, "p_partkey", {**S.match_rules(), **S.image_rules()})


@query("v17_declared_schema", "select p_partkey, case when p_size % 9 = 0 then '$.item_name: not of type string' else '' end as errors from part where p_size % 10 <> 0")
def declared_schema(spark, sf_dir):
    """The schema that a record type declares, held against the records as JSON."""
    rows = _records(spark, sf_dir).where("r is not null").join(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    kind = T.StructType([T.StructField(n, T.StringType(), False) for n in ("official_product_key", "item_name", "manufacturer")])
    flat = rows.select("p_partkey", "p_size", "r.official_product_key", "r.item_name", "r.manufacturer")
    text = F.to_json(F.struct("official_product_key", F.when(F.col("p_size") % 9 != 0, F.col("item_name")).alias("item_name"), "manufacturer"), {"ignoreNullFields": "false"})
    return flat.select("p_partkey", F.array_join(json_errors(S.declared_schema(kind))(text), ";").alias("errors"))


@query(
    "v11_v14_set_errors",
    """with b as (select c_nationkey as f, count(*) as n, min(c_custkey) as low, max(c_custkey) as high from customer group by 1)
    select 'f' || f as file, 'missing_file' as code from b where f % 5 = 0 union all select 'f' || f, 'changed_file' from b where f % 5 = 1 union all select 'f' || f, 'wrong_size' from b where f % 5 < 4 or f % 2 = 0
    union all select 'f' || f, 'wrong_range' from b where not (f % 5 < 4 or f % 2 = 0) union all select 'extra', 'unlisted_file'""",
)
def set_errors(spark, sf_dir):
    """Files of customers by nation, against a marker that is wrong in several ways."""
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("f"), "c_nationkey").alias("file"), F.col("c_custkey").cast("string").alias("key"), F.col("c_custkey").alias("place"), "c_nationkey")
    size = 10
    marked = rows.groupBy("file", "c_nationkey").agg(F.min("place").alias("first"))
    whole = (F.col("c_nationkey") % 5 < 4) | (F.col("c_nationkey") % 2 == 0)
    entries = marked.select("file", F.lit("h").alias("sha256"), "first", (F.col("first") + F.when(whole, size).otherwise(size - 1)).alias("last"))
    files = marked.where("c_nationkey % 5 <> 0").select("file", F.when(F.col("c_nationkey") % 5 == 1, "g").otherwise("h").alias("sha256"))
    return S.set_errors(entries, files.union(spark.sql("select 'extra', 'h'")), rows.select("file", "key", "place"), size)


@query(
    "t17_t18_lists",
    """select c_custkey, case when c_custkey % 3 = 0 then c_name || ',' || c_mktsegment when c_custkey % 3 = 1 then c_name else '' end as items, c_mktsegment as interaction, case when c_nationkey % 2 = 0 then 'summary' else '' end as kept from customer""",
)
def lists(spark, sf_dir):
    key = F.col("c_custkey")
    raw = F.when(key % 3 == 0, F.array(F.concat(F.lit("<p>"), "c_name", F.lit(" / </p>")), F.lit(" "), "c_mktsegment", "c_mktsegment")).when(key % 3 == 1, F.array(F.concat("c_name", F.lit("/"))))
    given = F.create_map(F.lit("summary"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).otherwise(" "), F.lit("full_text"), F.col("c_name"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.array_join(C.string_list(raw, C.ingredient), ",").alias("items"), C.interaction(C.health_text(F.concat("c_mktsegment", F.lit("\n\n복사")))).alias("interaction"),
        F.array_join(F.map_keys(C.guidance(given, C.GUIDANCE_KEYS)), ",").alias("kept"),
    )


@query(
    "t18_t22_nested",
    """select p_partkey, 'name: ' || p_name || chr(10) || 'sizes: ' || p_size || ' · ' || p_type as shown, '{"name":"' || p_name || '","sizes":[' || p_size || ',"' || p_type || '"]}' as cleaned from part""",
)
def nested(spark, sf_dir):
    text = F.concat(F.lit('{"name": "'), "p_name", F.lit('<br>복사", "sizes": ['), "p_size", F.lit(', "<b>'), "p_type", F.lit('</b>"], "none": ""}'))
    plain = F.concat(F.lit('{"name": "'), "p_name", F.lit('\\n", "sizes": ['), "p_size", F.lit(', "'), "p_type", F.lit('"], "none": null}'))
    cleaned = F.replace(C.interactions(text), F.lit(',"none":""'), F.lit(""))
    return table(spark, sf_dir, "part").select("p_partkey", C.structured_text(plain).alias("shown"), cleaned.alias("cleaned"))


@query(
    "t19_normalised",
    f"""select id, trim(name) as name, case when official_match_status = 'confirmed' and pos % 2 = 0 then case when trim(category) = '' then 'x' else category || chr(10) || chr(10) || 'x' end when official_match_status = 'confirmed' then 'old' else '<p>old</p>' end as official_efficacy,
    case when official_match_status <> 'confirmed' then '' when pos % 2 = 0 then 'normalized_from_upstream_cache' else 'normalized_from_canonical' end as content_status,
    case when official_match_status = 'confirmed' then 'name,official_efficacy' else 'name' end as changed_fields from {CATALOG_SQL}""",
)
def normalised(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    products = rows.select("id", F.concat(F.lit("  "), "name", F.lit("\t")).alias("name"), F.lit("<p>old</p>").alias("official_efficacy"), "official_match_status", F.col("id").alias("official_item_seq"))
    sources = rows.where("pos % 2 = 0").select(F.col("id").alias("code"), F.create_map(F.lit("effect"), F.concat("category", F.lit("<p>x</p>"))).alias("raw"))
    return C.normalise(products, sources, "id").select("id", "name", "official_efficacy", "content_status", F.array_join("changed_fields", ",").alias("changed_fields"))


@query(
    "t20_relocated",
    """select c_custkey, case when c_custkey % 2 = 0 then 'kept' else 'https://p' end as source_url, case when c_custkey % 3 = 0 then '' else c_name end as text from customer""",
)
def relocated(spark, sf_dir):
    key = F.col("c_custkey")
    given = F.create_map(F.lit("source_url"), F.lit("https://p"), F.lit("full_text"), F.when(key % 3 == 0, " ").otherwise(F.col("c_name")))
    there = F.when(key % 2 == 0, F.create_map(F.lit("source_url"), F.lit("kept")))
    moved = C.relocated(F.transform_values(given, lambda k, v: F.trim(v)), there)
    return table(spark, sf_dir, "customer").select("c_custkey", F.element_at(moved, "source_url").alias("source_url"), F.coalesce(F.try_element_at(moved, F.lit("text")), F.lit("")).alias("text"))


@query(
    "p08_detail_view",
    """select p_partkey, case when p_size % 3 = 0 then '제품 정보:저장방법' when p_size % 3 = 1 then '효능과 복용:효능·효과;제품 정보:저장방법' else '효능과 복용:효능·효과,용법·용량;성분:유효성분;제품 정보:저장방법' end as groups from part""",
)
def detail_view(spark, sf_dir):
    size = F.col("p_size") % 3
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(size > 0, F.col("p_type")).otherwise(" ").alias("official_efficacy"), F.when(size == 2, F.col("p_name")).otherwise(F.col("p_type")).alias("official_dosage"),
        F.when(size == 2, F.array("p_brand", F.lit(""))).otherwise(F.array().cast("array<string>")).alias("official_active_ingredients"), F.lit("cool").alias("official_storage"),
    )
    rows = rows.withColumn("official_dosage", F.when(F.col("official_efficacy") == " ", "").otherwise(F.col("official_dosage")))
    shown = F.transform(C.detail_view(rows), lambda g: F.concat(g["title"], F.lit(":"), F.array_join(F.transform(g["items"], lambda i: i["label"]), ",")))
    return rows.select("p_partkey", F.array_join(shown, ";").alias("groups"))


@query("x04_lists", "select c_custkey, case when c_custkey % 2 = 0 then c_name || ',' || c_mktsegment else c_name end as items, 1 as n from customer")
def clean_lists(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.array(F.concat("c_name", F.lit("  ")), F.lit(" "), "c_mktsegment")).otherwise(F.array("c_name")).alias("l"), F.concat(F.lit(" "), "c_name").alias("one")
    )
    return rows.select("c_custkey", F.array_join(C.clean_list(F.col("l"), rows.schema["l"].dataType), ",").alias("items"), F.size(C.clean_list(F.col("one"), rows.schema["one"].dataType)).alias("n"))


_SPECS = ", ".join(f"('{s.key}', '{s.dataset}', '{s.domain}', '{s.endpoint}', '{s.parameter}', {str(s.discovery).lower()}, {len(s.ids) + len(s.names)})" for s in SOURCES.values())


@query(
    "s10_sources",
    f"""select p_partkey, source, dataset, domain, endpoint, discovery, n_fields, sha256(endpoint || '?' || parameter || '=' || p_partkey || '&type=json') as cache_key
    from part, (values {_SPECS}) as t(source, dataset, domain, endpoint, parameter, discovery, n_fields)""",
)
def sources(spark, sf_dir):
    """What every source is asked about each part."""
    return requests(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey").drop("parameter", "params")


@query("u08_selection", f"select id from {CATALOG_SQL} where id not in ('1', '2', '5')")
def selection(spark, sf_dir):
    """All but the rows of a page, one of which was picked again."""
    picked = S.Selection().everything().page(["1", "2", "3", "5"], selected=False).toggle("3")
    return picked.applied(catalog(spark, sf_dir), "id").select("id")
