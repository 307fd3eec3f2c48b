"""Sequences in time: banded self-join, nearest-row join, even spacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _slot(time: str, seconds: float) -> Column:
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / int(seconds * 1_000_000))


def banded_pairs(df: DataFrame, keys: list[str], time: str, order: str, rows: int, seconds: float) -> DataFrame:
    """J-10: pairs of rows of a key within the next `rows` rows and `seconds`.

    Rows are numbered inside their time slot, after the counts of the key's slots before, so that no task sorts a key. Blocks of `rows`
    numbers are then joined with themselves and the next: a row meets twice `rows` others at most, however dense its slot is.
    """
    placed = df.withColumn("_slot", _slot(time, seconds))
    inside = Window.partitionBy(*keys, "_slot").orderBy(time, order)
    slots = placed.groupBy(*keys, "_slot").agg(F.count("*").alias("_size"))
    upto = F.coalesce(F.sum("_size").over(Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("_in", F.row_number().over(inside)).join(slots.select(*keys, "_slot", upto.alias("_upto")), [*keys, "_slot"])
    numbered = numbered.withColumn("_n", F.col("_upto") + F.col("_in")).withColumn("_block", F.floor(F.col("_n") / rows))
    left = numbered.select(*keys, F.explode(F.array("_block", F.col("_block") + 1)).alias("_block"), F.col("_n").alias("_ln"), F.col(time).alias("left_time"), F.col(order).alias("left_id"))
    right = numbered.select(*keys, "_block", F.col("_n").alias("_rn"), F.col(time).alias("right_time"), F.col(order).alias("right_id"))
    gap = (F.unix_micros("right_time") - F.unix_micros("left_time")) / 1_000_000
    joined = left.join(right, [*keys, "_block"])
    return joined.where((F.col("_rn") > F.col("_ln")) & (F.col("_rn") <= F.col("_ln") + rows) & (gap <= seconds)).select(*keys, "left_id", "right_id")


def latest_before(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str, seconds: float = 86_400.0) -> DataFrame:
    """J-12 as an as-of join: for every left row the value of the latest right row of its key not after it.

    Both sides are united and the last right value is carried along each time slot of a key; rows with none
    before them in their slot take that of the latest slot before, from one row a slot. So a key with a long
    history is spread over its slots.
    """
    a = left.withColumn("_value", F.lit(None).cast(right.schema[value].dataType)).withColumn("_side", F.lit(1))
    b = right.where(F.col(value).isNotNull()).select(*keys, time, F.col(value).alias("_value")).withColumn("_side", F.lit(0))
    inside = Window.partitionBy(*keys, "_slot").orderBy(time, "_side", F.col("_value").asc_nulls_last())
    carried = F.last("_value", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_slot", _slot(time, seconds))
    ends = both.groupBy(*keys, "_slot").agg(F.max(F.when(F.col("_side") == 0, F.struct(time, "_value"))).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(*keys, "_slot", F.last("_end", ignorenulls=True).over(earlier)["_value"].alias("_before"))
    found = both.withColumn("_own", carried).where("_side = 1").join(before, [*keys, "_slot"])
    return found.withColumn(value, F.coalesce("_own", "_before")).select(*left.columns, value)


def interpolate(df: DataFrame, keys: list[str], order: str, start: float, end: float) -> DataFrame:
    """W-09: places spread evenly between two times."""
    whole = Window.partitionBy(*keys)
    n = F.count("*").over(whole)
    place = F.row_number().over(whole.orderBy(order)) - 1
    return df.withColumn("at", F.lit(start) + (F.lit(end) - F.lit(start)) * place / F.greatest(n - 1, F.lit(1)))
