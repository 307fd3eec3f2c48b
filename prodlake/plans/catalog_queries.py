"""Filters, sorts, pages, facets and aggregates of the catalogue (F, O, P, A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.functions.text import comparable_date, csv_cell, full_name, trim_space
from prodlake.operators import catalog as C
from prodlake.operators.records import batches, balanced_batches, duplicate_groups, fill_rates, portable, transitions
from prodlake.operators.ranks import median
from prodlake.plans.registry import query
from prodlake.session import CATALOG_SQL, catalog, table

PAGE = C.CatalogQuery(search="ring", min_price=900, max_price=2000, sort="price_asc", page=2, columns=("category", "price"))


@query(
    "f01_o02_filtered_page",
    f"""with c as {CATALOG_SQL},
    f as (select *, row_number() over (order by price, pos) as place from c
      where contains(lower(concat_ws(' ', name, capacity, category, etc, document_id, id, official_match_status, official_item_name)), 'ring') and price >= 900 and price <= 2000)
    select cast(place as int) as place, name, category, price from f
    where (place - 1) // 25 + 1 = (select least(2, greatest(1, cast(ceil(count(*) / 25.0) as bigint))) from f)""",
)
def filtered_page(spark, sf_dir):
    return C.run(catalog(spark, sf_dir), PAGE)


@query("f03_categories", f"select document_id, category from {CATALOG_SQL} where category in ('ECONOMY', 'SMALL')")
def categories(spark, sf_dir):
    return C.filter_catalog(catalog(spark, sf_dir), C.CatalogQuery(categories=("ECONOMY", "SMALL"))).select("document_id", "category")


@query(
    "f05_date_range",
    f"""select document_id, substr(regexp_replace(updated, '[^0-9]', '', 'g'), 1, 8) as day from {CATALOG_SQL}
    where length(regexp_replace(updated, '[^0-9]', '', 'g')) >= 8 and substr(regexp_replace(updated, '[^0-9]', '', 'g'), 1, 8) between '20240301' and '20240831'""",
)
def date_range(spark, sf_dir):
    q = C.CatalogQuery(min_date="2024-03-01", max_date="2024-08-31")
    return C.filter_catalog(catalog(spark, sf_dir), q).select("document_id", comparable_date(F.col("updated")).alias("day"))


@query("f06_with_note", f"select document_id, trim(etc) as note from {CATALOG_SQL} where length(trim(etc)) > 0")
def with_note(spark, sf_dir):
    return C.filter_catalog(catalog(spark, sf_dir), C.CatalogQuery(note="with")).select("document_id", trim_space(F.col("etc")).alias("note"))


_OFFICIAL = """case when lower(trim(official_match_status)) in ('confirmed','linked','verified') then true
    when lower(trim(official_match_status)) in ('unlinked','pending','candidate','not_found','not_applicable','review_required') then false
    else trim(official_item_name) <> '' end"""
_IMAGE = "(image_url <> '' and regexp_matches(lower(image_rights_status), 'approved|verified|official|public_domain|open_license'))"


@query("f07_f09_linked", f"select document_id from {CATALOG_SQL} where {_OFFICIAL}")
def linked(spark, sf_dir):
    return C.filter_catalog(catalog(spark, sf_dir), C.CatalogQuery(official="linked")).select("document_id")


@query("f08_f10_with_image", f"select document_id from {CATALOG_SQL} where {_IMAGE}")
def with_image(spark, sf_dir):
    return C.filter_catalog(catalog(spark, sf_dir), C.CatalogQuery(image="with")).select("document_id")


@query(
    "f11_approved_image",
    f"select document_id from {CATALOG_SQL} where image_rights_status in ('approved','verified','official','official_source_preview','public_domain','open_license') and starts_with(image_url, 'https://')",
)
def approved_image(spark, sf_dir):
    return catalog(spark, sf_dir).where(C.approved_image()).select("document_id")


@query("f12_point_lookup", f"select document_id, name from {CATALOG_SQL} where id = '17' or document_id = '17' order by pos limit 1")
def point_lookup(spark, sf_dir):
    return catalog(spark, sf_dir).where("id = '17' or document_id = '17'").orderBy("pos").limit(1).select("document_id", "name")


@query("f13_selection", f"select document_id from {CATALOG_SQL} where id in (select cast(l_partkey as varchar) from lineitem where l_quantity > 49)")
def selection(spark, sf_dir):
    chosen = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").cast("string").alias("id"))
    return catalog(spark, sf_dir).join(chosen, "id", "left_semi").select("document_id")


@query(
    "f14_missing_image_slice",
    f"select document_id, cast(n as int) as place from (select document_id, row_number() over (order by pos) as n from {CATALOG_SQL} where image_url = '') where n between 11 and 30",
)
def missing_image_slice(spark, sf_dir):
    from pyspark.sql import Window

    first = catalog(spark, sf_dir).where("image_url = ''").orderBy("pos").limit(30)
    return first.select("document_id", F.row_number().over(Window.orderBy("pos")).alias("place")).where("place > 10")


@query(
    "f17_image_hosts",
    f"select lower(regexp_extract(image_url, '^[a-z]+://([^/]+)/', 1)) as host, starts_with(image_url, 'https') as secure, count(*) as n from {CATALOG_SQL} where image_url <> '' group by all",
)
def image_hosts(spark, sf_dir):
    from prodlake.functions.text import host

    df = catalog(spark, sf_dir).where("image_url <> ''")
    return df.groupBy(host(F.col("image_url")).alias("host"), F.startswith("image_url", F.lit("https")).alias("secure")).agg(F.count("*").alias("n"))


@query(
    "o01_category_order",
    f"select cast(place as int) as place, name, category from (select name, category, row_number() over (order by lower(category), lower(name), pos) as place from {CATALOG_SQL}) where place <= 25",
)
def category_order(spark, sf_dir):
    return C.run(catalog(spark, sf_dir), C.CatalogQuery(sort="category", columns=("category",)))


@query(
    "o02_clamped_page",
    f"""with c as {CATALOG_SQL}, n as (select greatest(0, cast(ceil(count(*) / 100.0) as bigint) - 1) * 100 as first from c),
    s as (select name, row_number() over (order by price desc, pos) as place from c)
    select cast(place as int) as place, name from s, n where place > first""",
)
def clamped_page(spark, sf_dir):
    return C.run(catalog(spark, sf_dir), C.CatalogQuery(sort="price_desc", page=10**6, page_size=100, columns=()))


@query(
    "a01_catalog_summary",
    f"""select count(*) as total, count(distinct category) as categories, coalesce(min(price) filter (price > 0), 0) as min_price, coalesce(max(price) filter (price > 0), 0) as max_price,
    coalesce(median(price) filter (price > 0), 0) as median_price, count(*) filter (length(trim(etc)) > 0) as with_note, count(*) filter ({_OFFICIAL}) as with_official, count(*) filter ({_IMAGE}) as with_image from {CATALOG_SQL}""",
)
def catalog_summary(spark, sf_dir):
    return C.summary(catalog(spark, sf_dir))


@query(
    "a02_facets",
    f"select coalesce(nullif(trim(category), ''), '미분류') as category, count(*) as n, min(pos) as first_pos from {CATALOG_SQL} group by 1",
)
def facets(spark, sf_dir):
    return C.facets(catalog(spark, sf_dir), "category")


@query("a03_event_histogram", "select event_type, count(*) as n from events group by 1")
def event_histogram(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type")


@query(
    "a04_profile",
    f"""select count(*) as n_rows, count(distinct document_id) as n_ids, count(*) filter (trim(category) = '') as missing_category, count(*) filter (image_url = '') as missing_image,
    count(*) filter (length(regexp_replace(updated, '[^0-9]', '', 'g')) < 8) as bad_dates, min(price) as min_price, cast(trunc(median(price)) as bigint) as median_price, max(price) as max_price from {CATALOG_SQL}""",
)
def profile(spark, sf_dir):
    """Counts are made by document first, so that different ids are rows; the middle price by counts of ranges."""
    rows = catalog(spark, sf_dir)
    middle = median(rows, F.col("price"))
    by_id = rows.groupBy("document_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(trim_space(F.col("category")) == "").alias("missing_category"),
        F.count_if(F.col("image_url") == "").alias("missing_image"),
        F.count_if(comparable_date(F.col("updated")) == "").alias("bad_dates"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )
    added = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "missing_category", "missing_image", "bad_dates")]
    return by_id.agg(*added, F.count("document_id").alias("n_ids"), F.min("min_price").alias("min_price"), F.lit(None if middle is None else int(middle)).cast("bigint").alias("median_price"), F.max("max_price").alias("max_price"))


@query(
    "a06_status_counts",
    f"select official_match_status, image_rights_status, count(*) as n from {CATALOG_SQL} group by all",
)
def status_counts(spark, sf_dir):
    return catalog(spark, sf_dir).groupBy("official_match_status", "image_rights_status").agg(F.count("*").alias("n"))


@query(
    "a07_fill_rates",
    """with j as (select d.lang, l.quality, l.toxic from documents d left join labels l using (doc_id)),
    g as (select lang, count(*) as rows, count(quality) as quality, count(toxic) as toxic from j group by lang)
    select lang, rows, 'quality' as field, quality as filled, round_even(quality / rows, 4) as rate from g
    union all select lang, rows, 'toxic', toxic, round_even(toxic / rows, 4) from g""",
)
def label_fill_rates(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return fill_rates(joined, ["lang"], ["quality", "toxic"])


@query(
    "a08_duplicate_groups",
    f"""with c as (select document_id, regexp_replace(lower(name), '[^0-9a-z가-힣]+', '', 'g') as group_key from {CATALOG_SQL}),
    s as (select group_key, count(*) as group_size from c group by 1),
    d as (select group_key, printf('dup-%04d', row_number() over (order by group_key)) as group_id from s where group_size > 1 and group_key <> '')
    select document_id, group_size, coalesce(group_id, '') as group_id from c join s using (group_key) left join d using (group_key)""",
)
def name_groups(spark, sf_dir):
    return duplicate_groups(catalog(spark, sf_dir).select("document_id", "name", "pos"), full_name(F.col("name"))).select("document_id", "group_size", "group_id")


@query(
    "a08_document_groups",
    """with k as (select doc_id, sha256(regexp_replace(lower(coalesce(text, '')), '[^0-9a-z가-힣]+', '', 'g')) as group_key from documents)
    select group_key, count(*) as n, min(doc_id) as first_doc from k group by 1 having count(*) > 1""",
)
def document_groups(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", F.sha2(full_name(F.col("text")), 256).alias("group_key"))
    return keyed.groupBy("group_key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query(
    "a13_rollup",
    """select coalesce(o_orderstatus, 'all') as status, coalesce(o_orderpriority, 'all') as priority, count(*) as n, round(sum(o_totalprice), 2) as total
    from orders group by rollup (o_orderstatus, o_orderpriority)""",
)
def order_rollup(spark, sf_dir):
    rolled = table(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return rolled.select(F.coalesce("o_orderstatus", F.lit("all")).alias("status"), F.coalesce("o_orderpriority", F.lit("all")).alias("priority"), "n", "total")


@query(
    "a14_transitions",
    """with r as (select user_id, arg_min(event_type, (ts, event_id)) as before, arg_max(event_type, (ts, event_id)) as after from events group by user_id)
    select before, after, count(*) as n from r group by all""",
)
def event_transitions(spark, sf_dir):
    key = F.struct("ts", "event_id")
    ends = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", key).alias("before"), F.max_by("event_type", key).alias("after"))
    return transitions(ends, "before", "after")


@query("a16_names_per_brand", "select p_brand, count(distinct p_name) as n_names, array_to_string(list_sort(list(distinct p_name)), ',') as names from part group by 1")
def names_per_brand(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.countDistinct("p_name").alias("n_names"), F.array_join(F.array_sort(F.collect_set("p_name")), ",").alias("names")
    )


@query(
    "w01_w07_batches",
    "select document_id, n as number, (n - 1) // 25 + 1 as batch_no from (select document_id, row_number() over (order by pos) as n from " + CATALOG_SQL + ")",
)
def numbered_batches(spark, sf_dir):
    return batches(catalog(spark, sf_dir).select("document_id", "pos"), "pos", 25).select("document_id", F.col("number").cast("long").alias("number"), F.col("batch_no").cast("long").alias("batch_no"))


@query("w08_balanced_batches", "select document_id, cast(ntile(7) over (order by pos) as int) as batch from " + CATALOG_SQL)
def even_batches(spark, sf_dir):
    df = catalog(spark, sf_dir).select("document_id", "pos")
    return balanced_batches(batches(df, "pos", 25), 7, df.count()).select("document_id", "batch")


@query(
    "p06_p07_portable",
    f"""select document_id as product_id, name as display_name, price as price_krw, case when official_match_status = 'confirmed' then nullif(official_item_name, '') end as medicine_name,
    case when image_url <> '' then image_url end as image,
    concat_ws(chr(10) || chr(10), 'Name: ' || name, case when trim(category) <> '' then 'Category: ' || category end, 'Capacity: ' || capacity, case when trim(etc) <> '' then 'Note: ' || trim(etc) end) as ai_context from {CATALOG_SQL}""",
)
def portable_records(spark, sf_dir):
    return portable(catalog(spark, sf_dir)).select(
        "product_id", F.col("display.name").alias("display_name"), "display.price_krw", F.col("medicine.name").alias("medicine_name"), F.col("media.primary_image.image_url").alias("image"), "ai_context"
    )


@query(
    "k05_csv_cells",
    """with t as (select doc_id, coalesce(text, '') as x from documents), g as (select doc_id, case when regexp_matches(x, '^[=+\\-@\\t\\r]') then '''' || x else x end as x from t)
    select doc_id, sha256(case when regexp_matches(x, '[",\\r\\n]') then '"' || replace(x, '"', '""') || '"' else x end) as cell from g""",
)
def csv_cells(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(csv_cell(F.col("text")), 256).alias("cell"))


@query(
    "k06_json_rows",
    f"""select document_id, '{{"name":"' || name || '","price":' || price || '}}' as row from {CATALOG_SQL}""",
)
def json_rows(spark, sf_dir):
    return catalog(spark, sf_dir).select("document_id", F.to_json(F.struct("name", "price")).alias("row"))
