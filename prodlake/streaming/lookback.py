"""W-05 on a stream: the same fold with state, which emits each merged row once no later row can join it.

State of a key is a list of rows that the watermark has not passed yet, and a list of the kept rows, `rows` at most.
A row may come late by as much as the watermark allows: it waits until the watermark passes its time, and then is folded
in order. A timer wakes the key at the time of its earliest waiting row, and when its oldest kept row is out of reach.
So the stream's rows are those of the batch fold, whatever the batches they came in; rows later than the watermark are
dropped by it, as in every stateful query.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from prodlake.operators.folding import Fold, Rule

SCHEMA = "at double, sequence long, text string, observations long, confidence double"
COLUMNS = ["at", "sequence", "text", "observations", "confidence"]


class Lookback(StatefulProcessor):
    """Rows (key, ts, at, sequence, text, observations, confidence) of a key; at: seconds, ts: the same as a timestamp."""

    def __init__(self, key: str, rule: Rule):
        self.key, self.rule = key, rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "row string")
        self.kept = handle.getListState("kept", "row string")

    def _read(self, state) -> list[dict]:
        return [json.loads(r[0]) for r in state.get()] if state.exists() else []

    def _write(self, state, rows: list[dict]) -> None:
        if rows:
            state.put([(json.dumps(r),) for r in rows])
        else:
            state.clear()

    def _wake(self, now: int, rows: list[dict], later: float = 0.0) -> None:
        """A timer for the moment when the watermark has passed the earliest of these rows (by `later` seconds)."""
        if rows:
            self.handle.registerTimer(max(now + 1, int((min(r["at"] for r in rows) + later) * 1000) + 1))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = [dict(zip(COLUMNS, r, strict=True)) for pdf in rows for r in pdf[COLUMNS].astype(object).where(pdf[COLUMNS].notna(), None).itertuples(index=False)]
        self.waiting.appendList([(json.dumps(r),) for r in fresh])
        self._wake(timerValues.getCurrentWatermarkInMs(), fresh)
        yield pd.DataFrame(columns=[self.key, *COLUMNS])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        passed = lambda r, later=0.0: (r["at"] + later) * 1000 < mark
        waiting = self._read(self.waiting)
        ready = sorted((r for r in waiting if passed(r)), key=lambda r: (r["at"], r["sequence"]))
        fold = Fold(self.rule, deque(self._read(self.kept)))
        out = [r for row in ready for r in fold.add(row)]
        # no row that is still to come reaches these; the others keep their places in the look-back
        while fold.kept and passed(fold.kept[0], self.rule.seconds):
            out.append(fold.kept.popleft())
        later = [r for r in waiting if not passed(r)]
        self._write(self.waiting, later)
        self._write(self.kept, list(fold.kept))
        self._wake(mark, later)
        self._wake(mark, list(fold.kept), self.rule.seconds)
        yield pd.DataFrame([(key[0], *(r[c] for c in COLUMNS)) for r in out], columns=[self.key, *COLUMNS])


def stream_lookback(rows: DataFrame, key: str, rule: Rule, late: str = "10 seconds") -> DataFrame:
    """The merged rows (key, at, sequence, text, observations, confidence) of a stream with these columns and `ts`.

    Needs the RocksDB state store: spark.sql.streaming.stateStore.providerClass. `sequence` orders rows of one time and must
    differ among them. Rows without a time or text are left out.
    """
    kind = rows.schema[key].dataType.simpleString()
    timed = rows.where("ts is not null and text is not null").withWatermark("ts", late)
    tidy = timed.select(key, "ts", (F.unix_micros("ts") / 1_000_000).alias("at"), F.col("sequence").cast("long").alias("sequence"), "text", F.coalesce(F.col("observations").cast("long"), F.lit(1).cast("long")).alias("observations"), F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)).alias("confidence"))
    return tidy.groupBy(key).transformWithStateInPandas(statefulProcessor=Lookback(key, rule), outputStructType=f"{key} {kind}, {SCHEMA}", outputMode="append", timeMode="eventtime")
