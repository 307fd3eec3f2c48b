"""J-11: global alignment of two sequences of items a key, in bounded memory.

Only pairs whose score reaches two gaps can be part of a best alignment: any other pair is worth less than leaving both
items alone. These pairs are found by an equi-join on what must agree, less those whose common letters bound their ratio
too low, and scored in parallel, whatever key they belong to. A key's task then holds its scored pairs only, and goes
through the table of sums by anti-diagonals in NumPy: two diagonals at a time, with those at every BLOCK-th kept, so that
the way back computes the directions of one block of diagonals again. Sums are made in the order of the plain recurrence,
so that its choice among equal sums is kept: a match before leaving out a left item, that before a right one.

Time of a key is the product of its lengths, memory their sum times the root of a diagonal's number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.functions.similarity import indel_ratio
from prodlake.functions.text import blank
from prodlake.operators.resolve import common_letters, letter_counts

#: Diagonals of a block.
BLOCK = 256
GAP = -12.0
# Scores of two readings of one list.
LEAST_ALIKE, MIDDLE, SAME_CATEGORY, OTHER_CATEGORY, A_SECOND, LATEST = 52.0, 54.0, 10.0, -4.0, 3.0, 25.0


class _Table:
    """Diagonals d of cells (r, d - r) of an n by m alignment; row r of a diagonal stands at place r."""

    def __init__(self, n: int, m: int, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, gap: float):
        self.n, self.m, self.gap = n, m, gap
        d = rows + columns + 2
        order = np.argsort(d, kind="stable")
        self.rows, self.scores = (rows + 1)[order], scores[order]
        self.first = np.searchsorted(d[order], np.arange(n + m + 2))

    def start(self) -> tuple[np.ndarray, np.ndarray]:
        """Diagonals -1 (nothing) and 0."""
        before, now = np.full(self.n + 1, -np.inf), np.full(self.n + 1, -np.inf)
        now[0] = 0.0
        return before, now

    def step(self, d: int, before: np.ndarray, now: np.ndarray, ways: np.ndarray | None = None) -> np.ndarray:
        """Diagonal d from the two before it; `ways` takes the directions: 0 a match, 1 a left item alone, 2 a right one."""
        low, high = max(0, d - self.m), min(self.n, d)
        out = np.full(self.n + 1, -np.inf)
        match = np.full(self.n + 1, -np.inf)
        at = slice(self.first[d], self.first[d + 1])
        rows = self.rows[at]
        match[rows] = before[rows - 1] + self.scores[at]
        up = np.full(self.n + 1, -np.inf)
        up[1:] = now[:-1] + self.gap
        left = now + self.gap
        out[low : high + 1] = np.maximum(np.maximum(match, up), left)[low : high + 1]
        if d <= self.m:
            out[0] = d * self.gap
        if d <= self.n:
            out[d] = d * self.gap
        if ways is not None:
            ways[:] = np.where(out == match, 0, np.where(out == up, 1, 2))
            if d <= self.m:
                ways[0] = 2
            if d <= self.n:
                ways[d] = 1
        return out


def best_matches(n: int, m: int, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, gap: float = GAP, block: int = BLOCK) -> list[tuple[int, int]]:
    """Pairs (row, column) that the best alignment matches with a score over 0; other pairs are worth less than two gaps."""
    table = _Table(n, m, rows, columns, scores, gap)
    lookup = dict(zip(zip(rows.tolist(), columns.tolist(), strict=True), scores.tolist(), strict=True))
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    before, now = table.start()
    for d in range(1, n + m + 1):
        if (d - 1) % block == 0:
            kept.append((before, now))
        before, now = now, table.step(d, before, now)
    found: list[tuple[int, int]] = []
    r, c = n, m
    while r or c:
        k = (r + c - 1) // block
        begin = k * block + 1
        before, now = kept[k]
        ways = np.empty((r + c - begin + 1, n + 1), dtype=np.int8)
        for d in range(begin, r + c + 1):
            before, now = now, table.step(d, before, now, ways[d - begin])
        while r + c >= begin and (r or c):
            way = ways[r + c - begin, r]
            if way == 0:
                r, c = r - 1, c - 1
                if lookup[r, c] > 0:
                    found.append((r, c))
            elif way == 1:
                r -= 1
            else:
                c -= 1
    return found[::-1]


def pass_score(ratio: Column) -> Column:
    """J-11b: the ratio of whole keys less 54, with points for the category and a penalty for time; under 52 they are no pair.

    Columns l_category, r_category, l_second, r_second. Prices must agree: that is what the pairs are joined on.
    """
    second = lambda side: F.coalesce(F.col(f"{side}_second").cast("double"), F.lit(0.0))
    late = F.least(F.lit(LATEST), F.abs(second("l") - second("r")) * A_SECOND)
    category = F.when(F.col("l_category").eqNullSafe(F.col("r_category")), SAME_CATEGORY).otherwise(OTHER_CATEGORY)
    return F.when(ratio >= LEAST_ALIKE, ratio - MIDDLE + category - late)


def likeness(ratio: Column) -> Column:
    return ratio - MIDDLE


def align(left: DataFrame, right: DataFrame, key: str, order: str, text: str, score: Callable[[Column], Column], least_ratio: float, same: tuple[str, ...] = (), carried: tuple[str, ...] = (), gap: float = GAP) -> DataFrame:
    """Rows (key, left_id, right_id) with the items' `order`, one side null where an item stands alone.

    Both sides have key, order (a whole number, each once a key), text and the columns `same`, which must be equal (null
    to null) in a pair, and `carried`, which score() finds as l_... and r_...; score() takes the ratio of the texts.
    A pair of a ratio under `least_ratio` must score under two gaps, or null. Items of a null key are left out.
    """
    columns = (*same, *carried)

    def side(df: DataFrame, letter: str) -> DataFrame:
        named = df.where(F.col(key).isNotNull()).select(key, F.col(order).cast("long").alias(f"{letter}_id"), blank(F.col(text)).alias(f"{letter}_text"), *[F.col(c).alias(f"{letter}_{c}") for c in columns])
        place = F.row_number().over(Window.partitionBy(key).orderBy(f"{letter}_id")) - 1
        return named.withColumns({f"{letter}_place": place, f"{letter}_letters": letter_counts(F.col(f"{letter}_text"))})

    a, b = side(left, "l"), side(right, "r")
    on = F.col(key) == F.col("_key")
    for c in same:
        on = on & F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))
    total = F.length("l_text") + F.length("r_text")
    bound = F.when(total == 0, 100.0).otherwise(200.0 * common_letters(F.col("l_letters"), F.col("r_letters")) / total)
    shorter = F.when(total == 0, 100.0).otherwise(200.0 * F.least(F.length("l_text"), F.length("r_text")) / total)
    near = a.join(b.withColumnRenamed(key, "_key"), on)
    near = near.where((shorter >= least_ratio) & (bound >= least_ratio)).drop("_key", "l_letters", "r_letters")
    scored = near.withColumn("score", score(indel_ratio(F.col("l_text"), F.col("r_text")))).where(F.col("score") >= 2 * gap)
    lengths = a.groupBy(key).agg(F.max("l_place").alias("_n")).join(b.groupBy(key).agg(F.max("r_place").alias("_m")), key)
    # a key column and the numbers that its task needs
    pairs = scored.select(key, F.col("l_place").alias("i"), F.col("r_place").alias("j"), "score").join(lengths, key)
    kind = left.schema[key].dataType.simpleString()

    def matched(table: pa.Table) -> pa.Table:
        i, j, s = (np.asarray(table.column(c).combine_chunks()) for c in ("i", "j", "score"))
        found = best_matches(table.column("_n")[0].as_py() + 1, table.column("_m")[0].as_py() + 1, i.astype(np.int64), j.astype(np.int64), s, gap)
        keys = table.column(key).combine_chunks().take(pa.array(np.zeros(len(found), dtype=np.int64)))
        return pa.table({key: keys, "l_place": pa.array([f[0] for f in found], pa.int32()), "r_place": pa.array([f[1] for f in found], pa.int32())})

    matches = pairs.groupBy(key).applyInArrow(matched, f"{key} {kind}, l_place int, r_place int")
    ids = a.select(key, "l_place", "l_id").join(matches, [key, "l_place"], "left")
    return ids.join(b.select(key, "r_place", "r_id"), [key, "r_place"], "full").select(key, F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id"))
