"""Smaller operators: gates, ladders, report rows, hashes, order checks (remaining D, E, F, H, K, M, N, O, P, R, S, U, V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.functions import text as X
from prodlake.operators import official as O
from prodlake.operators import records as R
from prodlake.operators import resolve as E
from prodlake.plans.registry import query
from prodlake.session import CATALOG_SQL, catalog, table
from prodlake.sources.readers import cache_key
from prodlake.sources.writers import as_text

def _pos():
    return F.col("pos")


@query("s09_cache_key", "select s_suppkey, sha256('https://api.example.org?a=' || s_name || '&b=' || s_nationkey) as key from supplier")
def request_keys(spark, sf_dir):
    params = F.create_map(F.lit("b"), F.col("s_nationkey").cast("string"), F.lit("a"), F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", cache_key(F.lit("https://api.example.org"), params).alias("key"))


@query("s25_cache_lookup", "select p_partkey, case when p_size > 25 then p_name end as cached from part")
def cache_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    key = F.sha2(F.col("p_partkey").cast("string"), 256)
    cache = part.where("p_size > 25").select(key.alias("key"), F.col("p_name").alias("cached"))
    return part.withColumn("key", key).join(cache, "key", "left").select("p_partkey", "cached")


@query("s18_fetch_once", "select count(distinct l_partkey) as fetched, count(*) as served from lineitem")
def fetch_once(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey")
    fetched = lines.dropDuplicates(["l_partkey"])
    return lines.join(fetched, "l_partkey").agg(F.countDistinct("l_partkey").alias("fetched"), F.count("*").alias("served"))


@query(
    "s08_s18_answered",
    """with r as (select l_orderkey, l_partkey % 300 as k from lineitem), d as (select distinct k from r)
    select l_orderkey, k, case when k % 3 = 0 then 'old' when k % 7 = 1 then '' else 'new' end as answer, k % 3 = 0 as cached, case when k % 3 <> 0 and k % 7 = 1 then 'TimeoutError' else '' end as error from r""",
)
def answered_requests(spark, sf_dir):
    """S-08, S-18: a third of the numbers is in the cache, some never answer, others at the second try; each is asked for once."""
    from prodlake.sources.registry import answered

    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 300).alias("k"))
    requests = lines.select("k").distinct().select("k", F.lit("https://api.example.org").alias("endpoint"), F.create_map(F.lit("n"), F.col("k").cast("string")).alias("params"))
    known = requests.where("k % 3 = 0").select(cache_key(F.col("endpoint"), F.col("params")).alias("key"), F.lit('{"a": "old"}').alias("payload"))
    tried: set[str] = set()

    def fetch(endpoint: str, params: dict[str, str]) -> str:
        n = int(params["n"])
        if n % 7 == 1 or (n % 5 == 0 and params["n"] not in tried):
            tried.add(params["n"])
            raise TimeoutError
        return '{"a": "new"}'

    got = answered(requests.select("endpoint", "params"), known, fetch, interval=0.0, retries=1, pause=0.0, at_once=4)
    back = got.select(F.element_at("params", "n").cast("long").alias("k"), F.coalesce(F.get_json_object("payload", "$.a"), F.lit("")).alias("answer"), "cached", F.coalesce("error", F.lit("")).alias("error"))
    return lines.join(back, "k").select("l_orderkey", "k", "answer", "cached", "error")


@query("s11_source_routing", f"select document_id, case category when 'ECONOMY' then 'a' when 'SMALL' then 'b' else 'any' end as source from {CATALOG_SQL}")
def source_routing(spark, sf_dir):
    a, b = (O.Source(k, k, "drug", "", "", (), (), categories=c) for k, c in (("a", ("ECONOMY",)), ("b", ("SMALL",))))
    return catalog(spark, sf_dir).select("document_id", R.choose_status((a.supports(), "a"), (b.supports(), "b"), otherwise="any").alias("source"))


@query("f19_safe_records", f"select document_id from {CATALOG_SQL} where pos % 5 = 0 and official_match_score >= 96 and image_url <> ''")
def safe_records(spark, sf_dir):
    safe = (F.col("official_match_status") == "confirmed") & (F.col("official_match_score") >= 96) & (F.col("image_url") != "")
    return catalog(spark, sf_dir).where(safe).select("document_id")


@query("f22_verified_pages", "select page_id from pages where contains(html, '<article>') and contains(html, '</article>') and contains(html, '<title>') and contains(html, '</body>')")
def verified_pages(spark, sf_dir):
    marks = ("<article>", "</article>", "<title>", "</body>")
    whole = F.lit(True)
    for m in marks:
        whole = whole & F.contains("html", F.lit(m))
    return table(spark, sf_dir, "pages").where(whole).select("page_id")


@query("k04_nested_text", "select p_partkey, '{\"brand\":\"' || p_brand || '\",\"size\":' || p_size || '}' as cell from part")
def nested_text(spark, sf_dir):
    nested = table(spark, sf_dir, "part").select("p_partkey", F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("s"))
    return nested.select("p_partkey", as_text(nested, "s").alias("cell"))


@query(
    "k12_review_queue",
    f"""select document_id, name, case official_match_status when 'confirmed' then 'found' when 'review_required' then 'found' when 'not_found' then 'not_found' else 'pending' end as lookup, n as number, (n - 1) // 25 + 1 as batch_no
    from (select *, row_number() over (order by pos) as n from {CATALOG_SQL} where official_match_status <> 'confirmed')""",
)
def review_queue(spark, sf_dir):
    waiting = catalog(spark, sf_dir).where("official_match_status <> 'confirmed'")
    rows = R.batches(waiting, "pos", 25)
    return rows.select("document_id", "name", O.lookup_status(F.col("official_match_status")).alias("lookup"), F.col("number").cast("long").alias("number"), F.col("batch_no").cast("long").alias("batch_no"))


@query(
    "h02_dataset_hash",
    """with r as (select row_number() over (order by c_custkey) - 1 as p, sha256(concat_ws(chr(31), c_custkey, c_name)) as h from customer),
    n as (select p // 1000 as p, sha256(string_agg(h, '' order by p)) as h from r group by 1) select case when count(*) > 1 then sha256(string_agg(h, '' order by p)) else min(h) end as hash from n""",
)
def dataset_hash(spark, sf_dir):
    return R.dataset_hash(table(spark, sf_dir, "customer"), "c_custkey", [F.col("c_custkey"), F.col("c_name")])


@query("p05_reset_columns", f"select document_id, case when official_match_status = 'not_found' then '' else image_url end as image_url, case when official_match_status = 'not_found' then 'none' else image_rights_status end as image_rights_status from {CATALOG_SQL}")
def reset_columns(spark, sf_dir):
    cleared = R.stale_cleared(catalog(spark, sf_dir), F.col("official_match_status") == "not_found", {"image_url": "", "image_rights_status": "none"})
    return cleared.select("document_id", "image_url", "image_rights_status")


@query("p14_alternatives", "select o_custkey, string_agg(o_orderkey, ',' order by rn) as best from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders) where rn <= 8 group by 1")
def alternatives(spark, sf_dir):
    scored = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("item_id"), F.col("o_orderkey").alias("official_product_key"), F.col("o_totalprice").alias("score"))
    listed = E.alternatives(scored, 8)
    return listed.select(F.col("item_id").alias("o_custkey"), F.array_join(F.transform("alternatives", lambda a: a["official_product_key"].cast("string")), ",").alias("best"))


@query("a15_rights_counts", f"select image_rights_status, count(*) as n, count(*) filter (image_url = '') as without from {CATALOG_SQL} group by 1")
def rights_counts(spark, sf_dir):
    return catalog(spark, sf_dir).groupBy("image_rights_status").agg(F.count("*").alias("n"), F.count_if(F.col("image_url") == "").alias("without"))


@query("a17_missing_counts", f"select count(*) filter (trim(category) = '') as category, count(*) filter (trim(etc) = '') as etc, count(*) filter (official_item_name = '') as official_item_name from {CATALOG_SQL}")
def missing_counts(spark, sf_dir):
    return catalog(spark, sf_dir).agg(*[F.count_if(X.trim_space(F.col(c)) == "").alias(c) for c in ("category", "etc", "official_item_name")])


@query(
    "e10_adapter_status",
    f"select document_id, case when (pos % 3 = 0 and pos % 2 = 0) or official_match_score >= 95 then 'confirmed' when official_match_score >= 85 then 'review_required' else 'not_found' end as status from {CATALOG_SQL}",
)
def adapter_status(spark, sf_dir):
    status = E.adapter_status(F.col("official_match_score"), _pos() % 3 == 0, _pos() % 2 == 0)
    return catalog(spark, sf_dir).select("document_id", status.alias("status"))


@query(
    "e15_e18_ladders",
    f"""select document_id, case when image_url = '' then 'no_image' when pos % 4 = 2 then 'rejected' when official_match_score < 50 then 'low_score' else 'approved' end as reason from {CATALOG_SQL}""",
)
def ladders(spark, sf_dir):
    reason = R.choose_status((F.col("image_url") == "", "no_image"), (_pos() % 4 == 2, "rejected"), (F.col("official_match_score") < 50, "low_score"), otherwise="approved")
    return catalog(spark, sf_dir).select("document_id", reason.alias("reason"))


@query(
    "e16_e17_preferred",
    "select user_id, event_id from (select *, row_number() over (partition by user_id order by case when event_type = 'purchase' then 0 else 1 end, value desc, event_id) as rn from events) where rn = 1",
)
def preferred(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    order = [F.when(F.col("event_type") == "purchase", 0).otherwise(1), -F.col("value"), F.col("event_id")]
    return R.best_per_key(events, ["user_id"], order).select("user_id", "event_id")


@query(
    "m04_keep_confirmed",
    """select c_custkey, case when c_custkey % 3 <> 0 or (c_custkey % 2 = 0 and 60 >= c_custkey % 100) then case when c_custkey % 2 = 0 then 'confirmed' else 'pending' end else 'fresh' end as status,
    case when c_custkey % 3 <> 0 or (c_custkey % 2 = 0 and 60 >= c_custkey % 100) then 60 else c_custkey % 100 end as score from customer""",
)
def keep_confirmed(spark, sf_dir):
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(key % 2 == 0, "confirmed").otherwise("pending").alias("status"), F.lit(60).cast("long").alias("score"))
    fresh = rows.where(key % 3 == 0).select("c_custkey", F.lit("fresh").alias("status"), (key % 100).alias("score"))
    return R.keep_confirmed(rows, fresh, "c_custkey")


@query("m08_enforced", "select s_suppkey, case when s_suppkey % 4 = 0 then 'approved' else s_name end as s_name from supplier")
def enforced(spark, sf_dir):
    base = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    changed = base.withColumn("s_name", F.lit("changed"))
    approved = base.where("s_suppkey % 4 = 0").withColumn("s_name", F.lit("approved"))
    return R.enforce(changed, base, approved, "s_suppkey", ["s_name"])


@query("m10_candidate_lists", "select l_suppkey, l_returnflag, string_agg(distinct l_linenumber, ',' order by l_linenumber) as numbers from lineitem group by all")
def candidate_lists(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    sets = lines.groupBy("l_suppkey", "l_returnflag").agg(F.array_sort(F.collect_set("l_linenumber")).alias("n"))
    return sets.select("l_suppkey", "l_returnflag", F.array_join(F.transform("n", lambda x: x.cast("string")), ",").alias("numbers"))


@query("n02_half_even", "select o_orderkey, cast(round_even(o_totalprice / 100.0, 0) as bigint) as hundreds from orders")
def half_even(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.bround(F.col("o_totalprice") / 100.0).cast("long").alias("hundreds"))


@query("n03_grouped_digits", "select p_partkey, format('{:,}', p_partkey * 1234567) as n from part")
def grouped_digits(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.format_number(F.col("p_partkey") * 1234567, 0).alias("n"))


def _rank():
    return F.array_position(F.array(*[F.lit(p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]), F.col("o_orderpriority"))


@query("o05_o07_priority", "select o_orderkey, cast(row_number() over (order by o_orderpriority, o_totalprice desc, o_orderkey) as int) as place from orders order by place limit 50")
def priority(spark, sf_dir):
    from pyspark.sql import Window

    order = [_rank(), F.desc("o_totalprice"), F.col("o_orderkey")]
    top = table(spark, sf_dir, "orders").orderBy(*order).limit(50)
    return top.select("o_orderkey", F.row_number().over(Window.orderBy(*order)).alias("place"))


@query("o05_o07_priority_all", "select o_orderkey, row_number() over (order by o_orderpriority, o_totalprice desc, o_orderkey) as place from orders")
def priority_all(spark, sf_dir):
    """The whole order; o05_o07_priority is its first 50."""
    price = F.col("o_totalprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.struct(_rank(), price.isNull(), -price, "o_orderkey").alias("_key"))
    return R.numbered(orders, "_key").select("o_orderkey", F.col("number").alias("place"))


@query("o06_slice", f"select document_id, n as number from (select document_id, row_number() over (order by pos) as n from {CATALOG_SQL}) where n between 31 and 60")
def place_slice(spark, sf_dir):
    return R.sliced(catalog(spark, sf_dir), "pos", 30, 30).select("document_id", F.col("number").cast("long").alias("number"))


@query("r03_d11_image_rights", f"select document_id, case when starts_with(image_url, 'https') then image_url else '' end as url, 'verified' as rights from {CATALOG_SQL}")
def image_rights(spark, sf_dir):
    return catalog(spark, sf_dir).select("document_id", O.valid_image(F.col("image_url")).alias("url"), O.rights_of(F.col("image_url"), F.lit("https://health.kr/p")).alias("rights"))


@query("u02_ordered_distinct", "select o_custkey, array_to_string(list(o_orderpriority order by first), ',') as seen from (select o_custkey, o_orderpriority, min(o_orderkey) as first from orders group by all) group by 1")
def ordered_distinct(spark, sf_dir):
    listed = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("l"))
    return listed.select("o_custkey", F.array_join(F.array_distinct(F.transform("l", lambda s: s["o_orderpriority"])), ",").alias("seen"))


@query(
    "v13_order_errors",
    "select p_partkey as pos, p_name as wanted, case when p_partkey % 50 = 0 then null else 'x' end as found from part where p_partkey % 50 = 0 or p_partkey % 70 = 1 and p_name <> 'x'",
)
def order_errors(spark, sf_dir):
    queue = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), "p_name")
    results = queue.where("pos % 50 <> 0").withColumn("p_name", F.when(_pos() % 70 == 1, "x").otherwise(F.col("p_name")))
    return R.order_errors(queue, results, "p_name", "pos")


@query("v02_row_widths", "select case when p_size % 5 = 0 then 4 else 3 end as width, count(*) as n from part group by 1")
def row_widths(spark, sf_dir):
    from prodlake.operators.audit import field_widths

    extra = F.when(F.col("p_size") % 5 == 0, F.col("p_type"))
    return field_widths(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", extra.alias("conditional")))


@query("v12_unchanged", "select 0::bigint as changed")
def unchanged(spark, sf_dir):
    before = table(spark, sf_dir, "customer")
    found = O.protected_changes(before, before.withColumn("c_acctbal", F.col("c_acctbal") + 1), "c_custkey", before.columns, ["c_acctbal"])
    return found.agg(F.count("*").alias("changed"))


@query(
    "v16_missing_report",
    f"""select case when image_url <> '' then 'has_image' when official_match_status = 'not_found' then 'not_found' when official_item_name = '' then 'no_identity' else 'open' end as reason, count(*) as n from {CATALOG_SQL} group by 1""",
)
def missing_report(spark, sf_dir):
    reason = R.choose_status((F.col("image_url") != "", "has_image"), (F.col("official_match_status") == "not_found", "not_found"), (F.col("official_item_name") == "", "no_identity"), otherwise="open")
    return catalog(spark, sf_dir).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("j13_fold_by_key", "select o_custkey, count(*) as n, min(o_orderdate) as first_day, max(o_orderdate) as last_day from orders join customer on c_custkey = o_custkey where c_mktsegment = 'BUILDING' group by 1")
def fold_by_key(spark, sf_dir):
    some = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(some, "o_custkey").groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))


@query("j15_prior_research", "select c_custkey, coalesce(last_order, -1) as last_order from customer left join (select o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) as last_order from orders group by 1) on o_custkey = c_custkey")
def prior_research(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    last = R.last_wins(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(last, "c_custkey", "left").select("c_custkey", F.coalesce("last_order", F.lit(-1)).alias("last_order"))
