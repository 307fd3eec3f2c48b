"""Queries over hash trees and the markers of batch sets."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from prodlake.operators.hash_tree import hash_tree, marker_errors, tree_changes
from prodlake.plans.registry import query
from prodlake.session import spread, table


@query(
    "h03_tree_changes",
    """select o_orderkey as place, case when o_orderkey % 509 = 1 then 'removed' when o_orderkey % 601 = 2 then 'added' else 'changed' end as change from orders
    where o_orderkey % 509 = 1 and o_orderkey % 601 <> 2 or o_orderkey % 509 <> 1 and o_orderkey % 601 = 2 or o_orderkey % 509 <> 1 and o_orderkey % 601 <> 2 and o_orderkey % 401 = 3""",
)
def changed_orders(spark, sf_dir):
    """Orders and a later state of them, compared by the trees of their rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws("|", "o_custkey", "o_orderstatus", "o_orderdate").alias("row"))
    key = F.col("o_orderkey")
    later = orders.where(key % 509 != 1).withColumn("row", F.when(key % 401 == 3, F.concat("row", F.lit("!"))).otherwise(F.col("row")))
    trees = [hash_tree(t, "o_orderkey", F.sha2("row", 256)) for t in (orders.where(key % 601 != 2), later)]
    return tree_changes(*trees)


@query("h03_tree_root", "select cast(max(p_partkey) + 1 as bigint) as places, count(*) as n, min(p_partkey) as first from part")
def tree_root(spark, sf_dir):
    """The root covers all rows; its own hash is held against plain hashing in tests."""
    tree = hash_tree(table(spark, sf_dir, "part"), "p_partkey", F.sha2("p_name", 256))
    return tree.orderBy(F.desc("level")).limit(1).select((F.col("last") + 1).alias("places"), "n", "first")


def _sha(text: str) -> str:
    return re.sub(r"SHA\(([^()]*)\)", r"sha2(\1, 256)", text)


_FILE = "SHA('b' || k || '-{i}')"
_ENTRY = (
    "'{{\"batch_id\":\"batch-0{i}\",\"file_name\":\"batch-0{i}.json\",\"sha256\":\"' || case when (k + {i}) % 53 = 14 then 'w' else " + _FILE + " end || '\",\"product_count\":' || case when (k + {i}) % 59 = 15 then '9' else '10' end"
    " || ',\"source_order_start\":' || case when (k + {i}) % 61 = 16 then '0' else '{start}' end || ',\"source_order_end\":{end}' || case when (k + {i}) % 67 = 17 then ',\"x\":1' else '' end || '}}'"
)
_E = [_ENTRY.format(i=i, start=10 * i - 9, end=10 * i) for i in (1, 2, 3)]
_MARKER = (
    "case when k % 43 = 12 then '[]' else '{\"schema_version\":\"' || case when k % 11 = 1 then '2.0' else '1.0' end || '\",\"complete\":' || case k % 13 when 2 then 'false' when 3 then '\"true\"' else 'true' end"
    " || ',\"set_id\":\"' || case when k % 17 = 4 then 'x' else set_id end || '\",\"generated_at\":' || case k % 19 when 5 then '\" \"' when 6 then '7' else '\"now\"' end || ',\"baseline_sha256\":\"' || case when k % 23 = 7 then 'y' else SHA('base') end"
    " || '\",\"baseline_count\":' || case when k % 29 = 8 then '31' else '30' end || ',\"batch_count\":' || case when k % 31 = 9 then '4' else '3' end || ',\"field_union_sha256\":\"' || case when k % 37 = 10 then 'z' else SHA('fields') end || '\"'"
    " || case when k % 41 = 11 then ',\"more\":1' else '' end || ',\"batches\":[' || " + " || ',' || ".join(_E[:2]) + " || case when k % 47 = 13 then '' else ',' || " + _E[2] + " end || ']}' end"
)


@query(
    "v11_v14_marker_errors",
    """with s as (select c_custkey as k from customer), m as (select k from s where k % 43 <> 12 and k % 41 <> 11), l as (select k from m where k % 47 <> 13), e as (select k, unnest([1, 2, 3]) as i from l), f as (select * from e where (k + i) % 67 <> 17)
    select k as "set", 'not_an_object' as code from s where k % 43 = 12 union all select k, 'marker_keys' from s where k % 43 <> 12 and k % 41 = 11
    union all select k, 'not_complete' from m where k % 11 = 1 or k % 13 in (2, 3) union all select k, 'baseline_sha256' from m where k % 23 = 7 union all select k, 'baseline_count' from m where k % 29 = 8
    union all select k, 'batch_count' from m where k % 31 = 9 union all select k, 'field_union_sha256' from m where k % 37 = 10 union all select k, 'generated_at' from m where k % 19 in (5, 6) union all select k, 'batches' from m where k % 47 = 13
    union all select k, 'entry_keys:' || i from e where (k + i) % 67 = 17 union all select k, 'entry:' || i || ':product_count' from f where (k + i) % 59 = 15 union all select k, 'entry:' || i || ':source_order_start' from f where (k + i) % 61 = 16
    union all select k, 'missing_file:' || i from f where (k + i) % 71 = 18 union all select k, 'changed_file:' || i from f where (k + i) % 71 <> 18 and (k + i) % 53 = 14
    union all select k, 'set_id' from l where k % 17 = 4 and not exists (select 1 from e where e.k = l.k and ((e.k + i) % 67 = 17 or (e.k + i) % 71 = 18))""",
)
def markers(spark, sf_dir):
    """A set of three batches for each customer, whose marker is wrong in one way or another."""
    inner = "concat('{\"baseline_sha256\":\"', sha2('base', 256), '\",\"batch_sha256\":[\"', " + ", '\",\"', ".join(_sha(_FILE.format(i=i)) for i in (1, 2, 3)) + ", '\"]}')"
    sets = spread(table(spark, sf_dir, "customer").selectExpr("c_custkey as k")).selectExpr("k", f"sha2({inner}, 256) as set_id")
    made = sets.selectExpr("k as set", f"{_sha(_MARKER)} as marker")
    expected = sets.selectExpr("k as set", "sha2('base', 256) as baseline_sha256", "30L as baseline_count", "3L as batch_count", "sha2('fields', 256) as fields_sha256", "10 as size")
    each = sets.select("k", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("i")).where("(k + i) % 71 <> 18")
    files = each.selectExpr("k as set", "concat('batch-0', i, '.json') as file_name", "sha2(concat('b', k, '-', i), 256) as sha256")
    return marker_errors(made, expected, files)
