"""Shared storage, lineage cuts and connected components for the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodlake.session import lean_batches, shared_dir, stash


def clear_stash(spark: SparkSession) -> None:
    """Delete the tables that operators and the pipeline wrote; call it when no frame of theirs will be read any more."""
    for name in ("stash", "pipeline", "media"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece stay under `limit` bytes (or the piece is one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        if sizes.sum() <= limit:
            yield batch
            continue
        part, at = np.cumsum(sizes) // limit, 0
        for to in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]:
            yield batch.slice(at, to - at)
            at = to


def carried(docs: DataFrame, *own: Column) -> DataFrame:
    """Columns of our own beside `row`, a struct of all the input's columns, so that no names clash.

    unpacked() is the way back.
    """
    return docs.select(*own, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def text_of(docs: DataFrame) -> list[Column]:
    """doc_id and text in the types that the operators take."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning stars of one partition's edges: at most one edge a node leaves the task."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    def out() -> pa.RecordBatch:
        pairs = [(x, root(x)) for x in list(parent) if root(x) != x]
        return pa.record_batch(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"]
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                low, high = min(x, y), max(x, y)
                parent[high] = low
                parent.setdefault(low, low)
        if len(parent) > 500_000:  # bounded memory: emit what is known and begin anew
            yield out()
            parent.clear()
    yield out()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root) for every node that has an edge.

    root is the smallest node of the component. Alternating large-star and small-star steps, each an
    aggregation with map-side combine and an equi-join, after a union-find inside every partition. The
    aggregates are written first, so that the joins shuffle both sides themselves and a node with very many
    edges can be split.
    """
    tidy = edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).where("a <> b")
    current = stash(tidy.mapInArrow(_forest, "a long, b long").distinct())
    state = None
    while True:
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stash(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")))
        large = (
            both.where("b > a")
            .join(low, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = stash(large)
        small_low = stash(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"))
        joined = large.join(small_low, F.col("a") == F.col("u"))
        small = (
            joined.select(F.col("b").alias("x"), F.col("m").alias("y"))
            .union(small_low.select(F.col("u").alias("x"), F.col("m").alias("y")))
            .where("x <> y")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
            .distinct()
        )
        current = stash(small)
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def u64(column: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark longs."""
    return pa.array(column.view(np.int64), pa.int64())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan rows (key, doc_id, place) in order; see shared_runs()."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("open", pa.bool_())])
    held: tuple | None = None  # key, leader, places of the leader, last document: the run not yet ended
    at_start = True

    def frame(k, d, p, first, last, is_open) -> pa.RecordBatch:
        n = len(d)
        fill = lambda x, kind: pa.array(np.broadcast_to(np.asarray(x, dtype=kind), n))
        return pa.record_batch([fill(k, np.int64), fill(d, np.int64), fill(p, np.int32), fill(first, np.int64), fill(last, np.int64), fill(is_open, bool)], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        k, d, p = (np.asarray(batch.column(i)) for i in range(3))
        begun = None
        if held is not None:
            if held[0] == k[0]:
                begun = held
            else:
                if at_start or held[1] != held[3]:
                    yield frame(held[0], np.full(len(held[2]), held[1]), held[2], held[1], held[3], at_start)
                at_start = False
        edge = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        length = np.diff(np.concatenate([edge, [len(k)]]))
        leader, last = d[edge].copy(), d[edge + length - 1].copy()
        if begun is not None:
            leader[0] = begun[1]
            last[0] = max(last[0], begun[3])
        own = np.repeat(leader, length)
        later = d != own
        if later.any():
            yield frame(k[later], d[later], p[later], own[later], np.repeat(last, length)[later], False)
        multi = np.repeat(leader != last, length)
        multi[: length[0]] = False
        multi[edge[-1] :] = False
        inner = ~later & multi
        if inner.any():
            yield frame(k[inner], d[inner], p[inner], own[inner], own[inner], False)
        places = p[: length[0]][~later[: length[0]]]
        if begun is not None:
            places = np.concatenate([begun[2], places])
        if len(edge) == 1:
            held = (k[0], leader[0], places, last[0])
            continue
        if at_start or leader[0] != last[0]:
            yield frame(k[0], np.full(len(places), leader[0]), places, leader[0], last[0], at_start)
        at_start = False
        held = (k[-1], leader[-1], p[edge[-1] :][~later[edge[-1] :]], last[-1])
    if held is not None:
        yield frame(held[0], np.full(len(held[2]), held[1]), held[2], held[1], held[3], True)


def shared_runs(rows: DataFrame) -> DataFrame:
    """Order rows (key, doc_id, place), compare neighbours, and keep the keys that several documents hold.

    Returns (key, doc_id, place, first) with `first` the smallest document of the key. Ranges are cut by key and
    document, so that a key with very many rows is spread over tasks; only the first document of the runs at
    the ends of a range waits for the ranges beside it, and these few rows are joined afterwards.
    """
    ordered = rows.select("key", "doc_id", "place").repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id")
    seen = stash(ordered.mapInArrow(_runs, "key long, doc_id long, place int, first long, last long, open boolean"))
    ends = seen.where("open").select("key", "doc_id", "place", "first", "last")
    whole = ends.groupBy("key").agg(F.min("first").alias("f"), F.max("last").alias("l")).where("f < l").withColumnRenamed("key", "k")
    # no more keys than two for each range, of which there are as many as shuffle partitions
    joined = ends.join(F.broadcast(whole), F.col("key") == F.col("k")).select("key", "doc_id", "place", F.col("f").alias("first"))
    return seen.where("not open").select("key", "doc_id", "place", "first").union(joined)
