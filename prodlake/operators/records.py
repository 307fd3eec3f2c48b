"""Keyed merges, windows over keys, snapshot joins and set operations.

Ties always go by an explicit order column. Every operator shuffles once on its key; folds that can be
aggregates are aggregates, so that they combine before the shuffle.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from prodlake.functions.text import changed_fields, first_text, row_hash, trim_space


#: Ranges into which rows are cut to be numbered.
SLOTS, MOST_SLOTS = 128, 4096


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """M-02 and W-02: the first row of each key in an order.

    An aggregate, not a window: the smallest struct of order and row combines map-side. Columns to be
    sorted downwards must be negated numbers; use top_per_key() for other orders.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*[o.alias(f"_o{k}") for k, o in enumerate(order)], *rest))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """O-04: the first k rows of each key, with their rank; the rank filter is pushed below the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W-03: the last row of each key."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*order, *rest)).alias("_last"))
        .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in [*order, *rest]])
    )


def runner_up_margin(df: DataFrame, keys: list[str], score: str, tie: str) -> DataFrame:
    """W-04: each key's best row and by how much it leads the next, null if it is alone."""
    by = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    seen = df.withColumn("margin", F.col(score) - F.lead(score).over(by)).withColumn("_rank", F.row_number().over(by))
    return seen.where("_rank = 1").drop("_rank")


def duplicate_groups(df: DataFrame, key: Column) -> DataFrame:
    """A-08 and W-06: group id `dup-%04d` by rank of the repeated keys, and the group's size."""
    keyed = df.withColumn("group_key", key)
    sizes = keyed.groupBy("group_key").agg(F.count("*").alias("group_size"))
    repeated = sizes.where("group_size > 1 and group_key <> ''").select("group_key")
    ids = numbered(repeated, "group_key").select("group_key", F.format_string("dup-%04d", "number").alias("group_id"))
    found = sizes.join(ids, "group_key", "left").withColumn("group_id", F.coalesce("group_id", F.lit("")))
    return keyed.join(found, "group_key")


def numbered(df: DataFrame, order: str) -> DataFrame:
    """W-01: `number` from 1 in the order of a column whose values are unique; for several, a struct of them.

    No task orders all rows: a sample of the values, those of smallest hash, gives the bounds of ranges, SLOTS at least and as
    many as there are shuffle partitions or millions of rows, up to MOST_SLOTS; rows are numbered inside their range, after the
    counts of the ranges before. The bounds are constants of the plan, so that a task that runs again puts its rows in the
    same ranges; a row finds its range in two steps, by groups of ranges and then inside its group.
    """
    total = df.count()
    slots = min(MOST_SLOTS, max(SLOTS, total // 1_000_000, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    share = max(1, total // (32 * slots))
    sampled = df.select(order).where((F.pmod(F.xxhash64(order), F.lit(share)) == 0) & F.col(order).isNotNull())
    values = [r[0] for r in sampled.orderBy(F.xxhash64(F.col(order), F.lit(1)), order).limit(128 * slots).orderBy(order).collect()]
    bounds = list(dict.fromkeys(values[:: max(1, len(values) // slots)]))
    constant = lambda b: F.struct(*[F.lit(v) for v in b]).cast(df.schema[order].dataType) if isinstance(b, Row) else F.lit(b)
    reached = lambda some: F.size(F.filter(some, lambda b: F.col(order) >= b))
    size = max(1, math.isqrt(len(bounds)))
    groups = [bounds[k : k + size] for k in range(0, len(bounds), size)]
    if bounds:
        group = reached(F.array(*[constant(g[0]) for g in groups])) - 1
        members = F.array(*[F.array(*[constant(b) for b in g]) for g in groups])
        placed = df.withColumn("_group", F.coalesce(group, F.lit(-1)))
        placed = placed.withColumn("_slot", F.when(F.col("_group") < 0, 0).otherwise(F.col("_group") * size + F.coalesce(reached(F.get(members, F.greatest("_group", F.lit(0)))), F.lit(0)))).drop("_group")
    else:
        placed = df.withColumn("_slot", F.lit(0))
    counts = placed.groupBy("_slot").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = placed.withColumn("_in", F.row_number().over(Window.partitionBy("_slot").orderBy(order)))
    out = own.join(F.broadcast(counts.select("_slot", before.alias("_before"))), "_slot")  # MOST_SLOTS rows at most, and a few
    return out.withColumn("number", F.col("_before") + F.col("_in")).drop("_slot", "_in", "_before")


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """W-07: number in order and batch of fixed size, both from 1."""
    return numbered(df, order).withColumn("batch_no", F.floor((F.col("number") - 1) / size) + 1)


def balanced_batches(rows: DataFrame, n: int, total: int) -> DataFrame:
    """W-08: contiguous batches whose sizes differ by one at most, the larger ones first; rows have `number`."""
    small, extra = divmod(total, n)
    place = F.col("number") - 1
    large = extra * (small + 1)
    batch = F.when(place < large, F.floor(place / (small + 1))).otherwise(extra + F.floor((place - large) / max(small, 1)))
    return rows.withColumn("batch", (batch + 1).cast("int"))


def fuse(df: DataFrame, keys: list[str], order: str, first: list[str], lists: list[str]) -> DataFrame:
    """M-01: per key the first non-empty value of scalars, and ordered distinct values of others."""

    def earliest(c: str) -> Column:
        return F.min(F.when(F.col(c).isNotNull() & (trim_space(F.col(c)) != ""), F.struct(order, c)))[c].alias(c)

    def ordered(c: str) -> Column:
        kept = F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(order), F.col(c).alias("_value")))))
        return F.array_distinct(F.transform(kept, lambda s: s["_value"])).alias(c)

    scalars, gathered = [earliest(c) for c in first], [ordered(c) for c in lists]
    return df.groupBy(*keys).agg(*scalars, *gathered)


def overlay(base: DataFrame, corrections: DataFrame, key: str, column: str) -> DataFrame:
    """J-05: corrections (key, expected, corrected) applied where the old value is the expected one.

    Adds `correction`: applied, conflict (another old value) or none.
    """
    joined = base.join(corrections, key, "left")
    hit = F.col("corrected").isNotNull()
    same = F.col(column).eqNullSafe(F.col("expected"))
    return joined.withColumn("correction", F.when(hit & same, "applied").when(hit, "conflict").otherwise("none")).withColumn(
        column, F.when(hit & same, F.col("corrected")).otherwise(F.col(column))
    ).drop("expected", "corrected")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """J-06, V-12, X-06: per key whether it was added, removed, changed or kept, and the changed fields."""
    a, b = before.alias("a"), after.alias("b")
    old, new = ({c: F.col(f"{side}.{c}") for c in columns} for side in "ab")
    gone, fresh = F.col(f"b.{key}").isNull(), F.col(f"a.{key}").isNull()
    names = changed_fields(old, new)
    kind = F.when(fresh, "added").when(gone, "removed").when(F.size(names) > 0, "changed").otherwise("kept")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    return both.select(
        F.coalesce(f"a.{key}", f"b.{key}").alias(key), kind.alias("kind"), F.when(kind == "changed", F.array_join(names, ",")).otherwise("").alias("fields")
    )


def coverage(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """J-07, U-03, U-06: keys missing from or extra in a table."""
    e, f = expected.select(key).distinct(), found.select(key).distinct()
    return e.join(f, key, "left_anti").withColumn("kind", F.lit("missing")).union(f.join(e, key, "left_anti").withColumn("kind", F.lit("extra")))


def upsert(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """J-08: rows of the same key are replaced, others added."""
    return base.join(changes.select(key), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def link_unique(df: DataFrame, key: str, value: str) -> DataFrame:
    """J-04: the key's value where it is the only one, else null; with the number of values."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("values"), F.min(value).alias("only")).select(
        key, "values", F.when(F.col("values") == 1, F.col("only")).alias("linked")
    )


def transitions(df: DataFrame, before: str, after: str) -> DataFrame:
    """A-14."""
    return df.groupBy(before, after).agg(F.count("*").alias("n"))


def fill_rates(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A-07: filled values of columns by key, in long form."""
    filled = [F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")).alias(c) for c in columns]
    wide = df.groupBy(*keys).agg(F.count("*").alias("rows"), *filled)
    return wide.unpivot([*keys, "rows"], columns, "field", "filled").withColumn("rate", F.bround(F.col("filled") / F.col("rows"), 4))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """U-01."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def choose_status(*ladder: tuple[Column, str], otherwise: str) -> Column:
    """E-15, E-18, V-16: the name of the first condition that holds."""
    return F.coalesce(*[F.when(c, F.lit(n)) for c, n in ladder], F.lit(otherwise))


def portable(df: DataFrame) -> DataFrame:
    """P-06 and P-07: the nested record with its text rendering."""
    medicine = F.when(
        F.col("official_match_status") == "confirmed",
        F.struct(F.nullif("official_item_name", F.lit("")).alias("name"), F.col("official_match_score").alias("score")),
    )
    lines = [("Name", "name"), ("Category", "category"), ("Capacity", "capacity"), ("Note", "etc")]
    text = F.concat_ws("\n\n", *[F.when(trim_space(F.col(c)) != "", F.concat(F.lit(f"{label}: "), trim_space(F.col(c)))) for label, c in lines])
    return df.select(
        F.lit("1.0").alias("schema_version"),
        F.col("document_id").alias("product_id"),
        F.struct("name", F.col("capacity").alias("specification"), "category", F.col("price").alias("price_krw"), F.col("pos").alias("source_order")).alias("display"),
        F.struct(F.when(F.col("image_url") != "", F.struct("image_url", "image_rights_status")).alias("primary_image")).alias("media"),
        medicine.alias("medicine"),
        text.alias("ai_context"),
    )


def stale_cleared(df: DataFrame, stale: Column, defaults: dict[str, object]) -> DataFrame:
    """P-05 and M-03: columns reset to defaults where a condition holds."""
    return df.withColumns({c: F.when(stale, F.lit(v)).otherwise(F.col(c)) for c, v in defaults.items()})


def prefer(*columns: str) -> Column:
    """J-02, J-16: the first non-blank of several columns."""
    return first_text(*[F.col(c) for c in columns])


def dataset_hash(df: DataFrame, key: str, columns: list[Column], fan: int = 1000) -> DataFrame:
    """H-02: one hash over all rows in the order of a unique key, as a tree of `fan` hashes a node.

    A node's hash is that of its children's hashes in order; levels are added until one row is left.
    """
    rows = numbered(df.select(key, row_hash(*columns).alias("hash")), key).select((F.col("number") - 1).alias("at"), "hash")
    left = df.count()
    while True:
        inside = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda s: s["hash"]), "")
        rows = rows.groupBy(F.floor(F.col("at") / fan).alias("node")).agg(F.sha2(inside, 256).alias("hash")).select(F.col("node").alias("at"), "hash")
        left = -(-left // fan)
        if left <= 1:
            return rows.select("hash")


def keep_confirmed(current: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """M-04: fresh (status, score) replaces the current one unless that is confirmed with no lower score."""
    joined = current.join(fresh.select(key, F.col("status").alias("_status"), F.col("score").alias("_score")), key, "left")
    stay = F.col("_status").isNull() | ((F.col("status") == "confirmed") & (F.col("score") >= F.col("_score")))
    return joined.withColumn("status", F.when(stay, F.col("status")).otherwise(F.col("_status"))).withColumn(
        "score", F.when(stay, F.col("score")).otherwise(F.col("_score"))
    ).drop("_status", "_score")


def enforce(df: DataFrame, baseline: DataFrame, approved: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """M-08: approved rows take the approved values, all others go back to the baseline's."""
    b = baseline.select(key, *[F.col(c).alias(f"_b_{c}") for c in columns])
    a = approved.select(key, F.lit(True).alias("_approved"), *[F.col(c).alias(f"_a_{c}") for c in columns])
    joined = df.join(b, key, "left").join(a, key, "left")
    values = {c: F.when(F.col("_approved"), F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")) for c in columns}
    return joined.withColumns(values).select(*df.columns)


def order_errors(queue: DataFrame, results: DataFrame, key: str, pos: str) -> DataFrame:
    """V-13, U-06: places at which two ordered tables hold different keys, or one none."""
    q, r = queue.select(pos, F.col(key).alias("wanted")), results.select(pos, F.col(key).alias("found"))
    return q.join(r, pos, "full_outer").where(~F.col("wanted").eqNullSafe(F.col("found")))


def sliced(df: DataFrame, order: str, start: int, limit: int) -> DataFrame:
    """O-06, F-14: rows of these places in an order."""
    return numbered(df, order).where((F.col("number") > start) & (F.col("number") <= start + limit))
