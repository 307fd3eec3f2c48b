"""Queries of whole product records: raw rules, portable records, image research."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.operators.product_records import baseline_errors, portable_records, product_errors, research_errors
from prodlake.plans.registry import query
from prodlake.session import CATALOG, CATALOG_SQL, spread, table

_TEXTS = (
    "document_id id name capacity category price etc updated app_id app_name app_capacity app_category app_price app_etc app_updated document_create_time document_update_time"
    " specification normalized_name normalized_capacity source_type recorded_at price_status verification_status image_url image_source_url image_rights_status"
).split()
_PLAIN = {"document_id": "'d-' || (p_partkey - case when p_partkey % 19 = 3 then 1 else 0 end)", "id": "cast(p_partkey - case when p_partkey % 23 = 5 then 1 else 0 end as string)", "name": "p_name"}
#: Fields that some rows leave out, empty, or fill with what is no text.
_FAULTS = {"updated": "case when p_partkey % 7 = 1 then '\"\"' when p_partkey % 7 = 2 then '5' when p_partkey % 7 = 3 then 'null' else '\"2024\"' end", "etc": "case when p_partkey % 5 = 0 then '\"\"' when p_partkey % 5 = 1 then '{{}}' else '\"x\"' end".replace("{{}}", "{}")}
_FIELDS = " || ',' || ".join(f"'\"{f}\":' || " + (_FAULTS[f] if f in _FAULTS else f"'\"' || {_PLAIN.get(f, repr(f))} || '\"'") for f in _TEXTS)
_RECORD = (
    "case when p_partkey % 29 = 7 then '[1]' when p_partkey % 31 = 7 then 'no json' else '{' || " + _FIELDS
    + " || ',\"displayed_price_krw\":' || case p_size % 6 when 0 then '0' when 1 then '\"12\"' when 2 then '-3.5' else '1200' end"
    + " || ',\"source_order\":' || case p_size % 4 when 0 then '1.5' when 1 then '0' else cast(p_partkey as string) end"
    + " || case p_size % 3 when 0 then ',\"secret\":1' when 1 then ',\"official_name\":null' else '' end || '}' end"
)


@query(
    "v01_product_errors",
    f"""with r as (select p_partkey as place, {_RECORD} as record from part), o as (select place, case when json_valid(record) then record end as j from r),
    ok as (select place, j, json_type(j) = 'OBJECT' as obj from o), good as (select * from ok where obj),
    t as (select place, f, json_type(j, '$.' || f) as kind, json_extract_string(j, '$.' || f) as v from good, (select unnest({_TEXTS!r}) as f)),
    k as (select place, unnest(json_keys(j)) as key from good), n as (select place, json_type(j, '$.displayed_price_krw') as pk, try_cast(json_extract_string(j, '$.displayed_price_krw') as double) as p, json_type(j, '$.source_order') as ok, try_cast(json_extract_string(j, '$.source_order') as double) as o from good)
    select place, 'not_an_object' as code from ok where obj is distinct from true
    union all select place, 'unknown_field:' || key from k where key = 'secret'
    union all select place, 'not_text:' || f from t where kind is distinct from 'VARCHAR'
    union all select place, 'empty:' || f from t where kind = 'VARCHAR' and trim(v) = '' and f not in ('etc', 'app_etc', 'document_create_time', 'document_update_time', 'image_url', 'image_source_url', 'image_rights_status')
    union all select place, 'price_not_positive' from n where pk = 'VARCHAR' or p <= 0
    union all select place, 'order_not_positive' from n where o <= 0 or o <> floor(o)
    union all select place, case f when 'id' then 'repeated_id' else 'repeated_document_id' end from (select *, row_number() over (partition by f, v order by place) as rn from t where f in ('id', 'document_id')) where rn > 1""",
)
def raw_errors(spark, sf_dir):
    part = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"))
    return product_errors(part.selectExpr("p_partkey as place", f"{_RECORD} as record"), "place", "record")


_OFFICIAL = {
    "official_item_seq": "cast(p_partkey * 3 as string)", "official_manufacturer": "case when p_size % 4 = 0 then '  ' else p_brand end", "official_dosage_form": "case when p_size % 3 = 0 then '정제' end", "official_pack_unit": "p_type",
    "official_storage": "' dry '", "official_source_url": "case when p_size % 5 > 1 then concat('https://drug.example.org/', cast(p_partkey as string)) else '' end", "source_type": "'list'", "displayed_price_krw": "case when p_size % 7 = 0 then 0 else p_size * 100 end",
    "source_order": "p_partkey", "image_source_url": "case when p_size % 2 = 0 then 'https://shop.example.org/ ' else '' end", "efficacy": "case when p_size % 2 = 0 then concat(' good for ', p_name) end", "dosage": "case when p_size % 3 = 1 then '   ' else p_type end",
}


@query(
    "p06_p07_portable_whole",
    f"""with c as (select c.*, {", ".join(f"{v.replace('as string', 'as varchar')} as {k}" for k, v in _OFFICIAL.items())} from {CATALOG_SQL} c join part on p_partkey = pos),
    t as (select *, official_match_status = 'confirmed' as ok, nullif(trim(official_item_name), '') as item_name, nullif(trim(official_manufacturer), '') as maker, nullif(trim(official_dosage_form), '') as form, nullif(trim(official_pack_unit), '') as pack,
      nullif(trim(official_source_url), '') as official_url, nullif(trim(image_url), '') as image, nullif(trim(image_source_url), '') as image_source, cast(coalesce(nullif(displayed_price_krw, 0), price) as bigint) as price_krw from c)
    select document_id as product_id, trim(name) as name, trim(capacity) as specification, trim(category) as category, price_krw, nullif(trim(etc), '') as notes, source_order, image as image_url, case when image is not null then image_source end as image_source,
    case when ok then item_name end as item_name, case when ok then trim(official_item_seq) end as item_code, case when ok then maker end as manufacturer, case when ok then 'dry' end as storage, case when ok then 0 end as n_ingredients,
    nullif(trim(official_match_status), '') as match_status, image_rights_status as rights, source_type as catalog_source,
    concat_ws(chr(10) || chr(10), '상품명: ' || trim(name), '규격: ' || trim(capacity), '분류: ' || trim(category), '가격(원): ' || price_krw, case when ok then '약학정보원 품목명: ' || item_name end, case when ok then '제조사: ' || maker end,
      case when ok then '제형: ' || form end, case when ok then '포장단위: ' || pack end, case when ok then '효능·효과:' || chr(10) || nullif(trim(efficacy), '') end, case when ok then '용법·용량:' || chr(10) || nullif(trim(dosage), '') end,
      case when ok then '약학정보원 출처: ' || official_url end, case when image is not null then '제품 이미지 출처: ' || image_source end) as ai_context from t""",
)
def portable_whole(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr(*[f"{v} as {k}" for k, v in CATALOG.items()], *[f"{v} as {k}" for k, v in _OFFICIAL.items()])
    content = F.struct(F.struct(F.col("efficacy").alias("text")).alias("efficacy"), F.struct(F.col("dosage").alias("text")).alias("dosage"))
    found = portable_records(part.withColumn("official_content", content))
    return found.select(
        "product_id", "display.name", "display.specification", "display.category", "display.price_krw", "display.notes", "display.source_order", F.col("media.primary_image.url").alias("image_url"), F.col("media.primary_image.source_url").alias("image_source"),
        "medicine.identity.item_name", "medicine.identity.item_code", "medicine.identity.manufacturer", "medicine.storage", F.when(F.col("medicine").isNotNull(), F.size("medicine.ingredients.all")).alias("n_ingredients"),
        F.col("quality.official_match_status").alias("match_status"), F.col("quality.image_rights_status").alias("rights"), F.col("provenance.catalog_source_type").alias("catalog_source"), "ai_context",
    )


_RESULTS = """select p_partkey + case when p_partkey % 41 = 3 then 1 else 0 end as pos, cast(p_partkey - case when p_partkey % 43 = 4 then 1 else 0 end as string) as product_id,
    case p_size % 5 when 0 then 'not_found' when 1 then 'maybe' else 'confirmed' end as status, case p_size % 7 when 0 then '' when 1 then ' ' else p_name end as candidate_name, p_size % 9 as n_evidence,
    case p_size % 11 when 0 then '' when 1 then 'https://search.daum.net/x' when 2 then 'ftp://a' else concat('https://shop', cast(p_size % 4 as string), '.example.org/p/', cast(p_partkey as string)) end as source_url,
    case p_size % 13 when 0 then '' when 1 then 'http://img.example.org/a.png' when 2 then 'https://img.example.org/noimg.png' else concat('https://img.example.org/', cast(p_partkey % 97 as string), '.png') end as image_url from part"""
_PAGES = "select distinct concat('https://shop', cast(p_size % 4 as string), '.example.org/p/', cast(p_partkey as string)) as url, case p_partkey % 6 when 0 then 404 when 1 then 403 when 2 then 0 else 200 end as status from part where p_partkey % 8 <> 5"
_IMAGES = """select distinct concat('https://img.example.org/', cast(p_partkey % 97 as string), '.png') as url, case when p_partkey % 97 % 10 = 4 then 500 else 200 end as status,
    case when p_partkey % 97 % 12 = 5 then 'https://img.example.org/placeholder.png' end as final_url, case when p_partkey % 97 % 14 = 6 then 'Text/HTML; charset=x' else 'image/png' end as content_type,
    case when p_partkey % 97 % 9 = 8 then null else 100 + p_partkey % 97 * 2 end as width, 149 + p_partkey % 97 % 3 as height, concat('h', cast(p_partkey % 97 % 40 as string)) as sha256 from part where p_partkey % 97 <> 50"""
_V = lambda s: s.replace("as string", "as varchar")


@query(
    "v13_research_errors",
    f"""with q as (select p_partkey as pos, cast(p_partkey as varchar) as wanted from part), r as ({_V(_RESULTS)}), p as ({_V(_PAGES)}), i as ({_V(_IMAGES)}),
    hosts as (select ['search.naver.com', 'search.pstatic.net', 'www.google.com', 'google.com', 'www.bing.com', 'search.daum.net', 'search.danawa.com'] as h),
    j as (select r.*, p.status as ps, i.status as ist, final_url, content_type, width, height, sha256, status_ok from (select *, r.status = 'confirmed' as status_ok from r) r left join p on p.url = r.source_url left join i on i.url = r.image_url),
    k as (select *, regexp_matches(source_url, '^https?://[^/]') and not list_contains(h, regexp_extract(source_url, '^https?://([^/?#:]+)', 1)) as product,
      starts_with(image_url, 'https://') and not regexp_matches(image_url, 'noimg|no_image|placeholder|19_limited|default-image') as allowed from j, hosts),
    d as (select *, case when product then coalesce(ps, 0) else 0 end as page, coalesce(allowed and ist between 200 and 399 and not regexp_matches(coalesce(final_url, image_url), 'noimg|no_image|placeholder|19_limited|default-image')
      and not starts_with(lower(content_type), 'text/html') and width is not null and height is not null, false) as decoded from k)
    select pos, coalesce(product_id, wanted) as product_id, 'order_differs' as code from q full join r using (pos) where wanted is distinct from product_id
    union all select pos, product_id, 'repeated_id' from r where product_id in (select product_id from r group by 1 having count(*) > 1)
    union all select pos, product_id, 'invalid_status' from d where status = 'maybe'
    union all select pos, product_id, 'source_is_not_product_page' from d where status_ok and not product
    union all select pos, product_id, 'source_page_unreachable' from d where status_ok and not (page between 200 and 399) and page not in (401, 403, 429)
    union all select pos, product_id, 'invalid_image_response' from d where status_ok and not decoded
    union all select pos, product_id, 'image_too_small' from d where status_ok and (not decoded or width < 150 or height < 150)
    union all select pos, product_id, 'missing_match_evidence' from d where status_ok and (candidate_name = '' or n_evidence = 0)
    union all select pos, product_id, 'unconfirmed_row_has_candidate_urls' from d where not status_ok and (image_url <> '' or source_url <> '')
    union all select pos, product_id, 'duplicate_image_content_in_batch' from (select *, count(*) over (partition by sha256) as n from d where status_ok and decoded) where n > 1""",
)
def research(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("research_part")
    derived = lambda text: spark.sql(text.replace("from part", "from research_part"))
    queue = derived("select p_partkey as pos, cast(p_partkey as string) as product_id from part")
    return research_errors(queue, derived(_RESULTS), derived(_PAGES), derived(_IMAGES))


_BASELINE = (
    "case when p_partkey % 37 = 5 then '7' else '{\"id\":' || case p_partkey % 11 when 1 then '\" \"' when 2 then '5' else '\"' || (p_partkey - case when p_partkey % 13 = 4 then 1 else 0 end) || '\"' end"
    " || ',\"name\":\"x\",\"source_order\":' || case p_partkey % 17 when 3 then '\"1\"' when 4 then '0' else cast(p_partkey as string) end || ',\"official_match_status\":' || case p_partkey % 3 when 0 then '\"confirmed\"' when 1 then '\"not_found\"' else 'null' end"
    " || case when p_partkey % 3 = 0 and p_partkey % 19 <> 6 or p_partkey % 23 = 7 then ',\"official_content\":{}' else '' end || case when p_partkey % 29 = 8 then '' else ',\"price\":1' end || '}' end"
)


@query(
    "v02_baseline_errors",
    f"""with r as (select p_partkey as place, {_BASELINE} as record from part), g as (select place, record as j from r where json_type(record) = 'OBJECT'),
    f as (select *, json_extract_string(j, '$.official_match_status') is not distinct from 'confirmed' as ok, json_keys(j) as k, case when json_type(j, '$.id') = 'VARCHAR' then trim(json_extract_string(j, '$.id')) else '' end as id from g)
    select place, 'not_an_object' as code from r where json_type(record) <> 'OBJECT' union all select place, 'id_missing' from f where id = ''
    union all select place, 'source_order' from f where json_type(j, '$.source_order') = 'VARCHAR' or json_extract_string(j, '$.source_order') <> cast(place as varchar)
    union all select place, 'row_fields' from f where list_sort(k) <> list_sort(case when ok then ['id', 'name', 'official_content', 'official_match_status', 'price', 'source_order'] else ['id', 'name', 'official_match_status', 'price', 'source_order'] end)
    union all select place, 'official_content' from f where list_contains(k, 'official_content') <> ok
    union all select place, 'repeated_id' from f where id <> '' and id in (select id from f group by id having count(*) > 1)
    union all select null, 'row_count' from (select count(*) as n from part) where n <> 1""",
)
def baseline(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey as place", f"{_BASELINE} as record")
    return baseline_errors(rows, "place", "record", 1, ["id", "name", "source_order", "official_match_status", "official_content", "price"])
