"""Exact medians by counting: values are never sorted and no task sees them all.

A pass counts the values of a range in BUCKETS parts of equal width, with the least and the largest value of each; the part
that holds the wanted rank is the next range, until it is one value. Parts are made by a function that never falls, so
ranks are exact whatever the rounding. Two or three passes are usual, and each sends at most BUCKETS rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _bucket(value: Column, low: float, high: float) -> Column:
    """0 for the least value, BUCKETS - 1 for the largest; halves, so that differences of the widest numbers are finite."""
    reach = high / 2 - low / 2
    if reach <= 0:
        return F.when(value > low, BUCKETS - 1).otherwise(0)
    share = (value.cast("double") / 2 - low / 2) / reach
    return F.least(F.greatest(F.floor(share * (BUCKETS - 1)), F.lit(0)), F.lit(BUCKETS - 1)).cast("int")


def value_at(values: DataFrame, rank: int, low, high, ahead: int = 0):
    """The value of `rank` (from 0) in the one column of `values`, whose values in [low, high] have `ahead` others before them."""
    name = values.columns[0]
    v = F.col(name)
    while low != high:
        part = F.when(v == F.lit(high), BUCKETS - 1).when(v == F.lit(low), 0).otherwise(_bucket(v, float(low), float(high)))
        inside = values.where(v.between(F.lit(low), F.lit(high)))
        rows = inside.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).orderBy("part").collect()
        for row in rows:
            if rank < ahead + row["n"]:
                if (row["low"], row["high"]) == (low, high):  # too narrow for doubles to tell its values apart
                    return _among(inside, rank - ahead)
                low, high = row["low"], row["high"]
                break
            ahead += row["n"]
    return low


def _among(inside: DataFrame, rank: int):
    """By their counts: whole numbers that are one double, so few different ones."""
    name = inside.columns[0]
    for row in inside.groupBy(name).agg(F.count("*").alias("n")).orderBy(name).toLocalIterator():
        if rank < row["n"]:
            return row[name]
        rank -= row["n"]
    raise ValueError("rank beyond the values")


def median(df: DataFrame, value: Column) -> float | None:
    """The middle value, or the mean of the two middle ones; null and NaN do not count; None without values."""
    values = df.select(value.alias("v")).where("v is not null")
    if values.schema["v"].dataType.simpleString() in ("double", "float"):
        values = values.where(~F.isnan("v"))
    n, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    upper = value_at(values, n // 2, low, high)
    return float(upper) if n % 2 else (float(value_at(values, n // 2 - 1, low, high)) + float(upper)) / 2
