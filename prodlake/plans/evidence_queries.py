"""Probes, picks, confirmations, reconciliation and hydration over the catalogue (S-24, J-17, E-09, E-11, E-19, E-20, M-09, M-11, P-16, D-12, D-14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.functions.deep import deep_scored
from prodlake.operators import evidence as V
from prodlake.operators import resolve as E
from prodlake.plans.registry import query
from prodlake.session import CATALOG_SQL, catalog, table

_PROBES = """(select case when p_partkey % 3 = 1 then concat('https://img.example.org/pack/', cast(p_partkey as string), '.png') else concat('http://img.example.org/pill/', cast(p_partkey as string), '.png') end as url,
    case when p_size % 9 = 0 then 404 else 200 end as status, case when p_size % 10 = 1 then 'https://www.bing.com/x' else 'https://img.example.org/y' end as final_url,
    case when p_size % 8 = 3 then 'text/html; charset=x' when p_size % 8 = 4 then '' else 'image/png' end as content_type, 10 * p_size as width, 400 - 5 * p_size as height from part where p_partkey % 3 <> 0 and p_size % 11 <> 0)"""


@query(
    "s24_image_probes",
    f"""select id, case when status is null then 'not_probed' when status < 200 or status >= 400 then 'http_' || status when starts_with(content_type, 'text/html') then 'non_image_content_type' else '' end as error,
    array_to_string(list_filter([case when final_url like 'https://www.bing.com%' then 'redirected_to_search_thumbnail' end,
      case when status = 200 and content_type = '' then 'missing_or_nonstandard_image_content_type' end,
      case when status = 200 and not starts_with(content_type, 'text/html') and (greatest(width, height) < 150 or width * height < 20000) then 'image_too_small' end], lambda x: x is not null), ',') as warnings
    from {CATALOG_SQL} c left join {_PROBES} p on p.url = c.image_url""",
)
def image_probes(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    url = F.when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("https://img.example.org/pack/"), key, F.lit(".png"))).otherwise(F.concat(F.lit("http://img.example.org/pill/"), key, F.lit(".png")))
    probes = part.where("p_partkey % 3 <> 0 and p_size % 11 <> 0").select(
        url.alias("url"), F.when(size % 9 == 0, 404).otherwise(200).alias("status"), F.when(size % 10 == 1, "https://www.bing.com/x").otherwise("https://img.example.org/y").alias("final_url"),
        F.when(size % 8 == 3, "text/html; charset=x").when(size % 8 == 4, "").otherwise("image/png").alias("content_type"), (10 * size).alias("width"), (400 - 5 * size).alias("height"),
    )
    return V.image_probes(catalog(spark, sf_dir).select("id", "image_url"), probes).select("id", "error", F.array_join("warnings", ",").alias("warnings"))


@query(
    "s24_page_errors",
    """select c_custkey, case when c_custkey % 7 = 0 or c_custkey % 5 = 0 then 'invalid_or_search_page_url' when c_custkey % 4 = 0 then 'not_probed' when c_custkey % 3 = 0 then 'redirected_to_search_page'
    when c_nationkey % 3 = 0 then '' when c_nationkey % 3 = 1 then '' else 'http_500' end as error from customer""",
)
def page_errors(spark, sf_dir):
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    url = F.when(key % 7 == 0, "ftp://shop.example.org/a").when(key % 5 == 0, "https://www.google.com/search?q=a").otherwise("https://shop.example.org/a")
    status = F.when(key % 4 == 0, F.lit(None)).when(nation % 3 == 0, 200).when(nation % 3 == 1, 403).otherwise(500)
    final = F.when(key % 3 == 0, "https://www.bing.com/x").otherwise("https://shop.example.org/b")
    return table(spark, sf_dir, "customer").select("c_custkey", V.page_error(url, status, final).alias("error"))


@query(
    "d12_d14_urls_and_keys",
    """select p_partkey, case when p_size % 2 = 0 then 'https://a.example.org/' || p_partkey else '' end as first, case when p_size % 2 = 0 then 2 else 0 end as n,
    regexp_replace(lower(p_name || p_size || ' ML'), '[^0-9a-z가-힣]', '', 'g') as full_key from part""",
)
def urls_and_keys(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    text = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("x@ https://a.example.org/"), F.col("p_partkey").cast("string"), F.lit(" |https://b.example.org"))).otherwise("http://c@|")
    valid = lambda u: F.startswith(u, F.lit("https://"))
    return part.select(
        "p_partkey", V.first_valid(text, valid).alias("first"), F.size(V.all_valid(text, valid)).alias("n"), V.full_key(F.col("p_name"), F.concat(F.col("p_size").cast("string"), F.lit(" ML"))).alias("full_key")
    )


@query(
    "e11_best_names",
    """with c as (select c_custkey, c_mktsegment as q, n_name as name, n_nationkey as place, 100.0 * least(length(c_mktsegment), length(replace(n_name, '_', ''))) / greatest(length(c_mktsegment), length(replace(n_name, '_', ''))) as r
      from customer join nation on n_regionkey = c_nationkey % 5), b as (select *, row_number() over (partition by c_custkey order by r desc, place) as rn from c)
    select c_custkey, case when r >= 78 then name end as match, cast(floor(r) as int) as score from b where rn = 1""",
)
def best_names(spark, sf_dir):
    """With the lengths' ratio in place of the similarity."""
    lengths = lambda a, b: 100.0 * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", (F.col("c_nationkey") % 5).alias("n_regionkey"))
    pairs = customers.join(table(spark, sf_dir, "nation"), "n_regionkey")
    return V.best_name(pairs, "c_custkey", "c_mktsegment", "n_name", "n_nationkey", ratio=lengths)


@query(
    "e19_retail_pick",
    """with c as (select o_custkey, lower(c_mktsegment) as name, case when o_orderkey % 3 = 0 then 'New ' || c_mktsegment || '!' else o_orderpriority end as candidate, cast(o_orderkey % 50 as int) as score, o_orderkey as rank,
      case when o_orderkey % 4 = 0 then '' else 'https://x/' || o_orderkey end as url from orders join customer on c_custkey = o_custkey),
    b as (select *, o_custkey, contains(regexp_replace(lower(candidate), '[^0-9a-z가-힣]', '', 'g'), name) as safe, row_number() over (partition by o_custkey order by contains(regexp_replace(lower(candidate), '[^0-9a-z가-힣]', '', 'g'), name) desc, score desc, rank) as rn from c)
    select o_custkey, candidate as candidate_name, score as match_score, url as image_url, safe, case when url <> '' then 'review_required' else 'not_found' end as status from b where rn = 1""",
)
def retail_pick(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    key = F.col("o_orderkey")
    candidates = orders.select(
        "o_custkey", F.lower("c_mktsegment").alias("catalog_name"), F.when(key % 3 == 0, F.concat(F.lit("New "), "c_mktsegment", F.lit("!"))).otherwise(F.col("o_orderpriority")).alias("candidate_name"),
        (key % 50).cast("int").alias("match_score"), key.alias("rank"), F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("https://x/"), key.cast("string"))).alias("image_url"),
    )
    return V.retail_pick(candidates, "o_custkey")


@query(
    "j17_reconciled",
    f"""select id, case when official_match_status = 'confirmed' and not (pos % 3 = 0 and pos % 2 = 0) then 'disagreement' when pos % 3 = 0 and official_match_status <> 'confirmed' then 'manual_confirmation' else 'agreement' end as outcome
    from {CATALOG_SQL} where pos % 7 <> 0""",
)
def reconciled(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    products = rows.select("id", F.col("official_match_status").alias("automatic_status"), F.when(F.col("pos") % 2 == 0, "A").otherwise("B").alias("automatic_code"))
    reviews = rows.where("pos % 7 <> 0").select("id", F.when(F.col("pos") % 3 == 0, "confirmed").otherwise("rejected").alias("decision"), F.lit("A").alias("manual_code"))
    return V.reconcile(products, reviews, "id").select("id", "outcome")


@query(
    "e20_manual_confirmations",
    f"""select id, case when pos % 11 = 0 then 'no_detail' when pos % 5 = 0 then 'name_differs' else '' end as problem, case when pos % 11 = 0 or pos % 5 = 0 then 'review_required' else 'confirmed' end as status,
    case when pos % 11 = 0 or pos % 5 = 0 then official_match_score else greatest(95, official_match_score) end as score,
    case when pos % 11 = 0 or pos % 5 = 0 then image_url when image_url <> '' then image_url else 'https://page/' || id end as image_url from {CATALOG_SQL}""",
)
def manual_confirmations(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    pos = F.col("pos")
    reviews = rows.select("id", F.col("id").alias("code"), F.when(pos % 5 == 0, "other").otherwise(F.replace("name", F.lit(" "), F.lit(""))).alias("reviewed_name"), F.lit("seen  twice").alias("rationale"))
    details = rows.where("pos % 11 <> 0").select(F.col("id").alias("code"), F.col("name").alias("official_name"), F.concat(F.lit("https://page/"), "id").alias("image_url"))
    current = rows.select("id", F.col("official_match_score").alias("score"), "image_url")
    return V.manual_confirmation(reviews, details, current).select("id", "problem", "status", "score", "image_url")


@query(
    "m09_review_materialised",
    f"""select id, case when pos % 4 = 0 then 'confirmed' when official_match_status = 'confirmed' then 'review_required' else official_match_status end as status,
    case when pos % 4 <> 0 and official_match_status = 'confirmed' then '' else image_url end as image_url, pos % 4 = 0 and not (official_match_status = 'confirmed' and pos % 3 = 0) as refused,
    case when pos % 4 = 0 then true when official_match_status = 'confirmed' then false end as visual_verified from {CATALOG_SQL}""",
)
def review_materialised(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    records = rows.select("id", F.col("official_match_status").alias("status"), "image_url", (F.col("pos") % 3 == 0).alias("automated_valid"))
    return V.review_materialised(records, rows.where("pos % 4 = 0"), "id").select("id", "status", "image_url", "refused", "visual_verified")


@query(
    "m11_hydrated",
    f"""select id, case when pos % 2 = 0 then case when pos % 3 = 0 or official_match_score < 50 then 'review_required' when pos % 5 <> 0 then 'confirmed' else 'image_missing' end else 'not_found' end as status,
    case when pos % 2 = 0 and pos % 3 <> 0 and official_match_score >= 50 and pos % 5 <> 0 then 'https://page/' || id else '' end as image_url from {CATALOG_SQL}""",
)
def hydrated(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    pos = F.col("pos")
    matches = rows.select("id", F.col("id").alias("code"), F.when(pos % 2 == 0, "image_missing").otherwise("not_found").alias("status"), F.col("official_match_score").alias("score"), (pos % 3 != 0).alias("safe"), F.lit("").alias("image_url"))
    details = rows.select(F.col("id").alias("code"), F.when(pos % 5 == 0, "").otherwise(F.concat(F.lit("https://page/"), "id")).alias("page_image"))
    return V.hydrate(matches, details, 50).select("id", "status", "image_url")


@query(
    "p16_verified_details",
    f"""select id, case when pos % 13 = 0 then 'empty_payload' when pos % 5 = 0 or pos % 7 = 0 then 'code_differs' when pos % 3 = 0 then 'name_differs' when pos % 4 = 0 then 'unsafe_name' else '' end as error,
    case when pos % 13 = 0 or pos % 5 = 0 or pos % 7 = 0 or pos % 3 = 0 or pos % 4 = 0 then 'review_required' else 'collected' end as status from {CATALOG_SQL}""",
)
def verified_details(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    pos = F.col("pos")
    requests = rows.select("id", F.col("id").alias("code"), "name", F.when(pos % 3 == 0, 95).otherwise(96).alias("score"), (pos % 4 != 0).alias("safe"))
    pages = rows.select(F.col("id").alias("code"), F.when(pos % 5 == 0, "x").otherwise(F.col("id")).alias("page_code"), F.col("id").alias("endpoint_code"))
    payloads = rows.where("pos % 13 <> 0").select(F.col("id").alias("code"), F.when(pos % 7 == 0, "y").otherwise(F.col("id")).alias("payload_code"), F.col("name").alias("drug_name"))
    return V.verified_details(requests, pages, payloads).select("id", "error", "status")


@query("e09_two_phase")
def two_phase(spark, sf_dir):
    """Pairs of a name's first word and brand; pages are read for those with 38 points before."""
    part = table(spark, sf_dir, "part")
    items = part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.concat("p_size", F.lit("정")).alias("capacity"), F.col("p_brand").alias("upso"))
    found = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").cast("string").alias("code"), F.min("p_size").alias("size"))
    products = found.select("code", F.create_map(F.lit("drug_name"), "p_name", F.lit("drug_code"), "code").alias("product"), F.col("p_brand").alias("upso"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"))
    pages = found.select("code", F.create_map(F.lit("drug_name"), F.col("p_name"), F.lit("drug_box"), F.concat("size", F.lit("정"))).alias("page"))

    def decide(kinds):
        pairs = kinds.withColumn("word", F.split_part("name", F.lit(" "), F.lit(1))).join(products, ["upso", "word"]).withColumns({"specification": F.lit(""), "known_code": F.lit("")})
        scored = E.two_phase(pairs.drop("upso", "word"), pages, deep_scored)
        return scored.select("item_id", "code", "score", "detailed", F.size("conflicts").alias("n_conflicts"))

    return E.each_kind_once(items, ["name", "capacity", "upso"], decide)
