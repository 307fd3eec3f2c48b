"""Joins, merges, windows over keys and set operations (J, M, W, U)."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from prodlake.functions.text import compact
from prodlake.operators import alignment as L
from prodlake.operators import records as R
from prodlake.operators import sequence as S
from prodlake.operators.audit import digest_groups
from prodlake.operators.folding import REFERENCE, Rule, fold_lookback
from prodlake.plans.registry import query
from prodlake.session import table

_BEST_LINE = "select * from (select *, row_number() over (partition by l_partkey order by l_extendedprice desc, l_orderkey, l_linenumber) as rn from lineitem) where rn = 1"


@query(
    "j01_j03_best_line_join",
    f"""with b as ({_BEST_LINE}) select p_partkey, b.l_orderkey as order_key, round(b.l_extendedprice, 2) as price, s_name,
    case when b.l_partkey is null then 'pending' when b.l_returnflag = 'R' then 'review_required' else 'confirmed' end as status
    from part left join b on l_partkey = p_partkey left join supplier on s_suppkey = l_suppkey""",
)
def best_line_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_extendedprice")
    best = R.best_per_key(lines, ["l_partkey"], [-F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")])
    joined = table(spark, sf_dir, "part").select("p_partkey").join(best, F.col("p_partkey") == F.col("l_partkey"), "left")
    joined = joined.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("s_suppkey") == F.col("l_suppkey"), "left")
    status = R.choose_status((F.col("l_partkey").isNull(), "pending"), (F.col("l_returnflag") == "R", "review_required"), otherwise="confirmed")
    return joined.select("p_partkey", F.col("l_orderkey").alias("order_key"), F.round("l_extendedprice", 2).alias("price"), "s_name", status.alias("status"))


@query("j03_orphans", "select count(*) as n from lineitem where l_partkey not in (select p_partkey from part where p_size > 10)")
def orphans(spark, sf_dir):
    parts = table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, sf_dir, "lineitem").select("l_partkey").join(parts, "l_partkey", "left_anti").agg(F.count("*").alias("n"))


@query(
    "j02_first_alternative",
    """with t as (select o_custkey, arg_max(o_orderpriority, (o_totalprice, -o_orderkey)) as alt from orders group by 1)
    select c_custkey, coalesce(nullif(case when c_acctbal > 5000 then c_mktsegment else '' end, ''), alt, '') as label from customer left join t on o_custkey = c_custkey""",
)
def first_alternative(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    alt = orders.groupBy("o_custkey").agg(F.max_by("o_orderpriority", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("alt"))
    joined = table(spark, sf_dir, "customer").join(alt, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.withColumn("own", F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).otherwise("")).select("c_custkey", R.prefer("own", "alt").alias("label"))


@query(
    "j04_unique_link",
    "select l_partkey, count(distinct l_suppkey) as values, case when count(distinct l_suppkey) = 1 then min(l_suppkey) end as linked from lineitem group by 1",
)
def unique_link(spark, sf_dir):
    return R.link_unique(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey")


_AFTER = """select c_custkey, c_name, case when c_custkey % 17 = 0 then 'OTHER' else c_mktsegment end as c_mktsegment, case when c_custkey % 23 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal
    from customer where c_custkey % 101 <> 0"""


@query(
    "j06_snapshot_diff",
    f"""with b as ({_AFTER}) select a.c_custkey, case when b.c_custkey is null then 'removed' when a.c_mktsegment <> b.c_mktsegment or a.c_acctbal <> b.c_acctbal then 'changed' else 'kept' end as kind,
    coalesce(case when b.c_custkey is not null then concat_ws(',', case when a.c_mktsegment <> b.c_mktsegment then 'c_mktsegment' end, case when a.c_acctbal <> b.c_acctbal then 'c_acctbal' end) end, '') as fields
    from customer a left join b on a.c_custkey = b.c_custkey""",
)
def customer_diff(spark, sf_dir):
    before = table(spark, sf_dir, "customer")
    after = before.where("c_custkey % 101 <> 0").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_custkey") % 17 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 23 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
    )
    return R.snapshot_diff(before, after, "c_custkey", ["c_mktsegment", "c_acctbal"])


@query(
    "j05_corrections",
    """select c_custkey, case when c_custkey % 10 = 0 and c_mktsegment = 'BUILDING' then 'HOUSING' else c_mktsegment end as c_mktsegment,
    case when c_custkey % 10 <> 0 then 'none' when c_mktsegment = 'BUILDING' then 'applied' else 'conflict' end as correction from customer""",
)
def corrections(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    wanted = customer.where("c_custkey % 10 = 0").select("c_custkey", F.lit("BUILDING").alias("expected"), F.lit("HOUSING").alias("corrected"))
    return R.overlay(customer, wanted, "c_custkey", "c_mktsegment")


@query(
    "j07_coverage",
    """select doc_id, 'missing' as kind from documents where doc_id not in (select doc_id from labels)
    union all select doc_id, 'extra' from labels where doc_id not in (select doc_id from documents)""",
)
def label_coverage(spark, sf_dir):
    return R.coverage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    "j08_upsert",
    """select s_suppkey, s_name, s_acctbal from supplier where s_suppkey % 3 <> 0
    union all select s_suppkey, 'new ' || s_name, s_acctbal from supplier where s_suppkey % 3 = 0
    union all select s_suppkey + 1000000, s_name, s_acctbal from supplier where s_suppkey % 5 = 0""",
)
def supplier_upsert(spark, sf_dir):
    base = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    replaced = base.where("s_suppkey % 3 = 0").withColumn("s_name", F.concat(F.lit("new "), F.col("s_name")))
    added = base.where("s_suppkey % 5 = 0").withColumn("s_suppkey", F.col("s_suppkey") + 1_000_000)
    return R.upsert(base, R.union_all([replaced, added]), "s_suppkey")


@query(
    "j10_banded_pairs",
    """with n as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events)
    select a.user_id, a.event_id as left_id, b.event_id as right_id from n a join n b on a.user_id = b.user_id and b.rn > a.rn and b.rn <= a.rn + 29
    and epoch_us(b.ts) - epoch_us(a.ts) <= 3600000000""",
)
def close_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    return S.banded_pairs(events, ["user_id"], "ts", "event_id", 29, 3600)


@query(
    "j12_latest_before",
    """select a.event_id, (select arg_max(b.value, (b.ts, b.value)) from events b where b.event_type = 'view' and b.user_id = a.user_id and b.ts <= a.ts) as view_value
    from events a where a.event_type = 'purchase'""",
)
def view_before_purchase(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    viewed = events.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("view_value"))
    return S.latest_before(bought, viewed, ["user_id"], "ts", "view_value").select("event_id", "view_value")


@query(
    "j14_conflicting_names",
    """with d as (select distinct p_brand, p_name from part) select a.p_brand, count(*) as pairs, count(*) filter (levenshtein(a.p_name, b.p_name) > 8) as conflicts
    from d a join d b on a.p_brand = b.p_brand and a.p_name < b.p_name group by 1""",
)
def conflicting_names(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_brand", "p_name").distinct()
    a, b = names.alias("a"), names.alias("b")
    pairs = a.join(b, (F.col("a.p_brand") == F.col("b.p_brand")) & (F.col("a.p_name") < F.col("b.p_name")))
    return pairs.groupBy("a.p_brand").agg(F.count("*").alias("pairs"), F.count_if(F.levenshtein("a.p_name", "b.p_name") > 8).alias("conflicts"))


@query(
    "m01_fused_orders",
    """select l_orderkey, arg_min(l_returnflag, (l_linenumber, l_returnflag)) as flag,
    array_to_string(list_transform(list_sort(list((l_linenumber, l_suppkey))), lambda x: x[2]), ',') as suppliers from (
    select l_orderkey, l_linenumber, l_returnflag, l_suppkey from lineitem) group by 1""",
)
def fused_orders(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey")
    ordered = lines.groupBy("l_orderkey").agg(
        F.min(F.struct("l_linenumber", "l_returnflag"))["l_returnflag"].alias("flag"), F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("all")
    )
    return ordered.select("l_orderkey", "flag", F.array_join(F.transform("all", lambda s: s["l_suppkey"].cast("string")), ",").alias("suppliers"))


@query(
    "m01_first_seen_union",
    """with f as (select l_orderkey, l_suppkey, min(l_linenumber) as first from lineitem group by all)
    select l_orderkey, array_to_string(list(l_suppkey order by first, l_suppkey), ',') as suppliers from f group by 1""",
)
def first_seen_union(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    fused = R.fuse(lines, ["l_orderkey"], "l_linenumber", [], ["l_suppkey"])
    return fused.select("l_orderkey", F.array_join(F.transform("l_suppkey", lambda s: s.cast("string")), ",").alias("suppliers"))


@query(
    "m02_best_order",
    "select o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) as o_orderkey, max(o_totalprice) as o_totalprice from orders group by 1",
)
def best_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return R.best_per_key(orders, ["o_custkey"], [-F.col("o_totalprice"), F.col("o_orderkey")])


@query(
    "m07_completeness",
    """select p_partkey, case when n = 3 then 'complete' when n > 0 then 'partial' else 'pending' end as status from (select p_partkey,
    cast(p_partkey % 2 = 0 as int) + cast(p_partkey % 3 = 0 as int) + cast(p_partkey % 5 = 0 as int) as n from part)""",
)
def completeness(spark, sf_dir):
    key = F.col("p_partkey")
    filled = F.filter(F.array(*[F.when(key % k == 0, F.lit(k)) for k in (2, 3, 5)]), lambda x: x.isNotNull())
    status = R.choose_status((F.size(filled) == 3, "complete"), (F.size(filled) > 0, "partial"), otherwise="pending")
    return table(spark, sf_dir, "part").select("p_partkey", status.alias("status"))


@query(
    "w03_last_wins",
    "select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(event_type, (ts, event_id)) as event_type from events group by 1",
)
def last_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return R.last_wins(events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(
    "w04_runner_up_margin",
    """select o_custkey, o_orderkey, round(margin, 2) as margin from (select *, o_totalprice - lead(o_totalprice) over w as margin, row_number() over w as rn
    from orders window w as (partition by o_custkey order by o_totalprice desc, o_orderkey)) where rn = 1""",
)
def order_margin(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return R.runner_up_margin(orders, ["o_custkey"], "o_totalprice", "o_orderkey").select("o_custkey", "o_orderkey", F.round("margin", 2).alias("margin"))


@query(
    "o04_top3_orders",
    "select o_custkey, o_orderkey, cast(rn as int) as rank from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders) where rn <= 3",
)
def top3_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return R.top_per_key(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@query(
    "w09_interpolated",
    """select user_id, event_id, round(10 + 90 * (row_number() over (partition by user_id order by event_id) - 1) / greatest(count(*) over (partition by user_id) - 1, 1), 6) as at from events""",
)
def interpolated(spark, sf_dir):
    return S.interpolate(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], "event_id", 10.0, 100.0).select("user_id", "event_id", F.round("at", 6).alias("at"))


@query("u01_union", "select event_type, count(*) as n from events where event_type in ('view', 'click', 'error') group by 1")
def event_union(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return R.union_all([events.where(F.col("event_type") == k) for k in ("view", "click", "error")]).groupBy("event_type").agg(F.count("*").alias("n"))


@query("u04_shared_words", "select a.p_brand as a, b.p_brand as b, count(*) as n from (select distinct p_brand, p_name from part) a join (select distinct p_brand, p_name from part) b on a.p_name = b.p_name and a.p_brand < b.p_brand group by all")
def shared_names(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_brand", "p_name").distinct()
    a, b = names.alias("a"), names.alias("b")
    return a.join(b, (F.col("a.p_name") == F.col("b.p_name")) & (F.col("a.p_brand") < F.col("b.p_brand"))).groupBy(F.col("a.p_brand").alias("a"), F.col("b.p_brand").alias("b")).agg(F.count("*").alias("n"))


@query("u05_repeated_texts", "select sha256(text) as digest, count(*) as members, count(distinct lang) as identities, min(doc_id) as first_member, count(distinct lang) > 1 as unrelated from documents group by 1 having count(*) > 1")
def repeated_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("digest"))
    return digest_groups(docs, "digest", "doc_id", "lang")


@query("m05_w05_lookback_fold")
def lookback_fold(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"), F.col("event_type").alias("text"), F.lit(1).alias("observations")
    )
    return fold_lookback(events, ["user_id"], ["event_id"], Rule(24, 7200.0, 88.0))


@query("m05_w05_weak_sightings")
def weak_sightings(spark, sf_dir):
    """Events as sightings of one list by confidence: rows seen once join at a lower ratio; properties must agree."""
    events = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 50).alias("list"), "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"), F.concat("event_type", F.col("user_id") % 7).alias("text"),
        (F.col("event_id") % 3 + 1).alias("observations"), (F.col("event_id") % 10 / 10).alias("confidence"), (F.col("event_id") % 2).alias("price"),
    )
    return fold_lookback(events, ["list"], ["event_id"], dataclasses.replace(REFERENCE, seconds=3600.0, same=("price",)))


@query("j11_aligned_turns")
def aligned_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where("conv_id is not null")
    return L.align(turns.where("role = 'user'"), turns.where("role = 'assistant'"), "conv_id", "turn", "text", L.likeness, 30.0)


@query("j11_aligned_passes")
def aligned_passes(spark, sf_dir):
    """Turns against a second reading that misses each fifth, cuts the last word and has some other prices."""
    turns = table(spark, sf_dir, "conversations").where("conv_id is not null")
    first = turns.selectExpr("conv_id", "turn", "text as name", "role as specification", "turn % 3 as price", "role as category", "turn * 2.0D as second")
    second = first.where("(conv_id + turn) % 5 <> 0").withColumns(
        {
            "name": F.regexp_replace("name", "\\s+\\S+$", ""),
            "price": F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, -1).otherwise(F.col("price")),
            "second": F.col("second") + 1,
        }
    )
    whole = lambda df: df.withColumn("key", compact(F.concat("name", "specification")))
    return L.align(whole(first), whole(second), "conv_id", "turn", "key", L.pass_score, L.LEAST_ALIKE, same=("price",), carried=("category", "second"))
