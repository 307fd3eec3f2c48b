"""The look-back fold against a plain loop, its rules, and the stream against the batch."""

from __future__ import annotations

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from prodlake.functions.similarity import indel
from prodlake.operators.folding import LIVE, PASS, REFERENCE, Rule, fold_lookback, joins, preferred
from prodlake.streaming.lookback import stream_lookback

SCHEMA = "k int, at double, id long, text string, observations int, confidence double, price int"


def rows_of(seed, n=400, gap=3.0):
    draw = random.Random(seed)
    out, at = [], {}
    for i in range(n):
        k = draw.choice([1, 1, 1, 1, 2, None])
        at[k] = at.get(k, 1000.0) + draw.choice([0.0, 0.5, 1.0, gap, 40.0 if draw.random() < 0.2 else 2.0, 400.0 if draw.random() < 0.1 else 0.25])
        out.append((k, at[k], i, draw.choice(["가나다라정", "가나다라", "abcdefgh", "abcdefgi", "ab", "ac", "", None]), draw.choice([1, 1, 2, 5]), draw.choice([0.5, 0.9, None]), draw.randrange(2)))
    return out


def plain(rows, rule):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    out = []
    for k in {r[0] for r in rows}:
        kept = []
        for row in sorted((dict(zip(names, r, strict=True)) for r in rows if r[0] == k), key=lambda r: (r["at"], r["id"])):
            for i in range(len(kept) - 1, max(-1, len(kept) - 1 - rule.rows), -1):
                if joins(kept[i], row, rule):
                    kept[i] = preferred(kept[i], row, rule)
                    break
            else:
                kept.append(row)
        out += [tuple(r.values()) for r in kept]
    return sorted(out, key=repr)


@pytest.mark.parametrize("rule", [LIVE, PASS, REFERENCE, dataclasses.replace(REFERENCE, same=("price",), rows=3), Rule(2, 100.0, 50.0, firsts=("id",))])
def test_against_a_loop(spark, rule):
    rows = rows_of(rule.rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in fold_lookback(df, ["k"], ["id"], rule).collect()), key=repr)
    assert got == plain(rows, rule)


def test_rules():
    a = {"at": 0.0, "text": "가나다라마", "observations": 2, "confidence": 0.5, "price": 1}
    b = {**a, "text": "가나다라바", "observations": 1, "confidence": 0.9}
    assert indel(a["text"], b["text"]) == 80
    assert joins(a, b, REFERENCE) and not joins(a, {**b, "observations": 2}, REFERENCE) and not joins(a, {**b, "at": 5.5}, REFERENCE)
    assert not joins(a, {**b, "price": 2}, dataclasses.replace(REFERENCE, same=("price",)))
    assert joins({**a, "text": "ab"}, {**b, "text": "ab"}, PASS) and not joins({**a, "text": "abcd" * 9}, {**b, "text": "ab"}, PASS)
    won = preferred(a, {**b, "at": -1.0}, LIVE)
    assert (won["text"], won["observations"], won["at"]) == ("가나다라마", 3, -1.0)
    assert preferred(a, {**b, "observations": 2}, LIVE)["text"] == "가나다라바"  # more confident
    assert preferred(a, {**a, "text": "가나다라마바"}, LIVE)["text"] == "가나다라마바"  # longer
    assert preferred(a, {**a, "text": "바나다라마"}, LIVE)["text"] == "가나다라마"  # equal: the kept one


def test_rows_without_a_time_stay(spark):
    df = spark.createDataFrame([(1, None, 1, "a", 1, 0.5, 1), (1, None, 2, "a", 1, 0.5, 1), (1, 0.0, 3, "a", 1, 0.5, 1)], SCHEMA)
    assert fold_lookback(df, ["k"], ["id"]).count() == 3
    assert fold_lookback(df.limit(0), ["k"], ["id"]).collect() == []


def test_stream_equals_batch(spark, tmp_path):
    """Rows come late and out of order; each merged row is emitted once, when nothing can join it any more."""
    rule = dataclasses.replace(REFERENCE, rows=4)
    rows = [r for r in rows_of(3, 150) if r[0] is not None and r[3] is not None]
    draw = random.Random(1)
    arriving = sorted(rows, key=lambda r: r[1] + draw.uniform(0, 8))
    columns = "k int, ts timestamp, sequence long, text string, observations int, confidence double"
    as_ts = lambda df: df.select("k", F.timestamp_micros((F.col("at") * 1_000_000).cast("long")).alias("ts"), F.col("id").alias("sequence"), "text", "observations", "confidence")
    far = [(k, 1e6, 10_000 + k, "end", 1, 0.0, 0) for k in (1, 2)] + [(1, 2e6, 20_000, "end of all", 1, 0.0, 0)]
    for n in range(4):
        part = arriving[n * len(arriving) // 3 : (n + 1) * len(arriving) // 3] if n < 3 else far
        as_ts(spark.createDataFrame(part, SCHEMA)).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        found = stream_lookback(stream, "k", rule, "10 minutes")
        q = found.writeStream.outputMode("append").format("memory").queryName("merged").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted((r["k"], round(r["at"], 3), r["sequence"], r["text"], r["observations"]) for r in spark.table("merged").collect() if not r["text"].startswith("end"))
    want = fold_lookback(spark.createDataFrame(rows, SCHEMA), ["k"], ["id"], rule).collect()
    assert got == sorted((r["k"], round(r["at"], 3), r["id"], r["text"], r["observations"]) for r in want)
