"""W-05 and M-05: sightings of one item within a bounded look-back become one row, in batches and on streams.

Rows of a key are taken in the order of their time. A row joins the newest kept row of the last `rows` that is near in
time and alike in text; of the two the better sighted one stays, with the sum of both's observations and the earlier
time. As the winner takes the place of what it beats, the result is a fold, not groups of an equivalence.

A kept row keeps its first time, so no row that comes more than `seconds` later joins it. Hence a key can be cut at
pauses: `fold_lookback` finds pauses between slots of time from one row a slot, makes each stretch between pauses a task's
stream in order, and holds no more than the last `rows` kept ones.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodlake.functions.similarity import indel


#: Look-back times in a slot: pauses are found between slots, so longer ones mean fewer cuts and fewer rows to find them by.
SLOT = 16


@dataclass(frozen=True)
class Rule:
    """When a row joins a kept one.

    rows, seconds: how far back. least: ratio of the texts; weak_least: enough where one of the two was seen once at most.
    short: texts under this length join only equal ones. same: columns that must be equal. text: what is compared; names: the
    columns whose lengths decide among winners, else text. firsts: columns of which the smaller stays.
    """

    rows: int = 24
    seconds: float = 12.0
    least: float = 88.0
    weak_least: float | None = None
    short: int = 0
    same: tuple[str, ...] = ()
    text: str = "text"
    time: str = "at"
    names: tuple[str, ...] = ()
    firsts: tuple[str, ...] = ()


# The three look-backs.
LIVE = Rule(24, 12.0, 88.0)
PASS = Rule(29, 5.0, 96.0, short=5)
REFERENCE = Rule(11, 5.0, 94.0, weak_least=78.0)


def joins(kept: dict, row: dict, rule: Rule) -> bool:
    if any(kept[c] != row[c] for c in rule.same) or abs(kept[rule.time] - row[rule.time]) > rule.seconds:
        return False
    a, b = kept[rule.text] or "", row[rule.text] or ""
    if a == b:
        return True
    if min(len(a), len(b)) < rule.short:
        return False
    like = indel(a, b)
    weak = rule.weak_least is not None and min(_seen(kept), _seen(row)) <= 1
    return like >= rule.least or (weak and like >= rule.weak_least)


def _seen(row: dict) -> int:
    n = row.get("observations")
    return 1 if n is None else n


def preferred(kept: dict, row: dict, rule: Rule) -> dict:
    """M-05: the better sighted by observations, confidence and length (the kept one if equal), with what both add up to."""
    names = rule.names or (rule.text,)
    quality = lambda r: (_seen(r), r.get("confidence") or 0.0, sum(len(r[c] or "") for c in names))
    out = dict(max((kept, row), key=quality))
    if "observations" in row:
        out["observations"] = _seen(kept) + _seen(row)
    for c in (rule.time, *rule.firsts):
        out[c] = min(kept[c], row[c])
    return out


@dataclass
class Fold:
    """The kept rows that later rows may still join, oldest first; `add` returns those that none can join any more."""

    rule: Rule
    kept: deque = field(default_factory=deque)

    def add(self, row: dict) -> list[dict]:
        for k in range(len(self.kept) - 1, -1, -1):
            if joins(self.kept[k], row, self.rule):
                self.kept[k] = preferred(self.kept[k], row, self.rule)
                return []
        self.kept.append(row)
        return [self.kept.popleft()] if len(self.kept) > self.rule.rows else []

    def rest(self) -> list[dict]:
        out = list(self.kept)
        self.kept.clear()
        return out


def _folded(batches: Iterator[pa.RecordBatch], keys: list[str], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Rows sorted by keys, stretch and time; the last column is the stretch."""
    fold, now = Fold(rule), None
    for batch in batches:
        schema = pa.schema(list(batch.schema)[:-1])
        out: list[dict] = []
        for row in batch.to_pylist():
            stretch = (*(row[k] for k in keys), row.pop("_stretch"))
            if stretch != now:
                out += fold.rest()
                now = stretch
            out += fold.add(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist(fold.rest(), schema=schema)


def fold_lookback(df: DataFrame, keys: list[str], order: list[str], rule: Rule = LIVE) -> DataFrame:
    """The folded rows, with df's columns. Rows are taken by rule.time (seconds as a number), then by `order`.

    observations (1 if absent or null) and confidence are read where they exist. Rows without a time stay as they are. A
    key without a pause is one task's stream; it needs the memory of `rows` rows.
    """
    time = rule.time
    slot = F.floor(F.col(time) / max(rule.seconds * SLOT, 1e-6))
    placed = df.where(F.col(time).isNotNull()).withColumn("_slot", slot)
    slots = placed.groupBy(*keys, "_slot").agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    by = Window.partitionBy(*keys).orderBy("_slot")
    pause = F.coalesce(F.col("_first") - F.lag("_last").over(by) > rule.seconds, F.lit(True))
    cuts = slots.withColumn("_cut", pause.cast("long")).select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col("_slot").alias("_s"), F.sum("_cut").over(by).alias("_stretch"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(keys)] + [F.col("_slot") == F.col("_s")]
    dealt = placed.join(cuts, on).select(*df.columns, "_stretch").repartition(*keys, "_stretch")
    ordered = dealt.sortWithinPartitions(*keys, "_stretch", time, *order)
    folded = ordered.mapInArrow(lambda b: _folded(b, keys, rule), df.schema)
    return folded.union(df.where(F.col(time).isNull()))
