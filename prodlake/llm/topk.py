"""Exact top-k by inner product with a pivot-distance index.

Components become floor(1024 * x). With one more coordinate that brings all vectors to the largest norm,
the largest inner products are the smallest distances. Vectors are keyed by their nearest pivot and the
distance to it; the distances of a pivot are cut into rings (annuli). For a query the rings are ordered by
the largest inner product that the triangle inequality allows in them. The first rings that hold enough
vectors are searched, which gives the query a bound; then only those rings are searched whose largest
possible score reaches it. Every step is exact: pivots and ring bounds come from a bounded sample, but
the extent and count of each ring from all rows.

Queries and vectors are compared block by block. Rings with many vectors, such as copies of one, are cut
into blocks by id, and these dealt in groups of GROUP blocks, so that no ring is one task's work. The number
of pivots grows with the square root of the number of vectors, from PIVOTS up to MOST_PIVOTS; the table of
rings, bounded by MOST_PIVOTS * RINGS rows, is the only thing sent to all tasks.

Defined cases: vectors null or with null or non-finite components take no part; vectors of other
lengths than the query's are no candidates; equal scores go to the smaller id; repeated rows of an id
each count as candidates, as the rows of a table, but an id asks once, with the smallest of its vectors;
rows with a null id take no part; fewer candidates than k give all of them; an empty table gives no rows;
extra columns are ignored. Components and scores beyond 64 bits are held to their ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm.session import stash

PIVOTS, MOST_PIVOTS, RINGS = 32, 1024, 16
#: Sampled vectors for each pivot.
SAMPLE = 128
BLOCK, QUERY_BLOCK, GROUP = 2048, 256, 64
_LONG = 1 << 63


@dataclass
class Rings:
    """Pivots (in the space with one more coordinate), the largest squared norm, and what is known of each ring.

    `group` is the number of vectors that one task compares at a time.
    """

    pivots: np.ndarray
    top: float
    edges: np.ndarray
    group: int
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    count: np.ndarray | None = None

    def distances(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """To every pivot; a query's further coordinate is 0."""
        v = vectors.astype(np.float64)
        norm = (v * v).sum(axis=1)
        more = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.top - norm, 0))
        dots = v @ self.pivots[:, :-1].T + more[:, None] * self.pivots[:, -1]
        squared = (norm + more * more)[:, None] - 2 * dots + (self.pivots**2).sum(axis=1)
        return np.sqrt(np.maximum(squared, 0))

    def best_scores(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product that each ring can hold for each query, with room for rounding."""
        d = np.repeat(self.distances(queries, query=True), RINGS, axis=1)
        gap = np.maximum(0, np.maximum(self.low - d, d - self.high))
        norm = (queries.astype(np.float64) ** 2).sum(axis=1)[:, None]
        bound = (norm + self.top - np.maximum(gap * (1 - 1e-9) - 1e-3, 0) ** 2) / 2
        return np.where(self.count > 0, bound + 1 + 1e-9 * (np.abs(bound) + self.top), -np.inf)


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(usable rows, their components floor(1024 * x)) of a list column whose lists have one length."""
    rows = np.flatnonzero(np.asarray(column.is_valid()))
    flat = np.array(column.take(pa.array(rows)).to_pylist(), dtype=np.float64)
    if not len(rows):
        return rows, np.zeros((0, 0), dtype=np.int64)
    fine = np.isfinite(flat).all(axis=1)
    scaled = np.floor(1024 * flat[fine])
    inside = np.abs(scaled) < _LONG
    held = np.where(scaled > 0, _LONG - 1, -_LONG)
    return rows[fine], np.where(inside, np.where(inside, scaled, 0).astype(np.int64), held.astype(np.int64))


def choose_pivots(sample: np.ndarray, top: float, pivots_wanted: int = PIVOTS) -> Rings:
    """Farthest-first pivots moved to the means of their vectors, and ring bounds at quantiles, from a sample."""
    norm = (sample.astype(np.float64) ** 2).sum(axis=1)
    points = np.column_stack([sample, np.sqrt(np.maximum(top - norm, 0))]).astype(np.float64)
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(pivots_wanted, len(points)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    pivots = points[chosen]
    for _ in range(5):
        own = (-2 * points @ pivots.T + (pivots**2).sum(axis=1)).argmin(axis=1)
        pivots = np.array([points[own == k].mean(axis=0) if (own == k).any() else pivots[k] for k in range(len(pivots))])
    rings = Rings(pivots, top, np.zeros((len(pivots), RINGS - 1)), BLOCK * GROUP)
    d = rings.distances(sample)
    own = d.argmin(axis=1)
    for k in range(len(pivots)):
        mine = d[own == k, k]
        rings.edges[k] = np.quantile(mine, np.arange(1, RINGS) / RINGS) if len(mine) else 0
    return rings


def _keyed(batches: Iterator[pa.RecordBatch], rings: Rings) -> Iterator[pa.RecordBatch]:
    """(vec_id, ring, distance, vector): the ring's number is pivot * RINGS + place."""
    for batch in batches:
        rows, v = integers(batch.column(1))
        if not len(rows):
            continue
        d = rings.distances(v)
        own = d.argmin(axis=1)
        mine = d[np.arange(len(own)), own]
        place = (mine[:, None] > rings.edges[own]).sum(axis=1)
        yield pa.record_batch(
            [batch.column(0).take(pa.array(rows)), pa.array((own * RINGS + place).astype(np.int32)), pa.array(mine), pa.array([x.tobytes() for x in v], pa.binary())],
            names=["vec_id", "ring", "distance", "vector"],
        )


def _packed(table: pa.Table) -> pa.Table:
    ids = np.asarray(table.column("vec_id"), dtype=np.int64)
    return pa.table(
        {"ring": [table.column("ring")[0].as_py()], "part": [table.column("part")[0].as_py()], "ids": [ids.tobytes()], "vectors": [b"".join(table.column("vector").to_pylist())]},
        schema=pa.schema([("ring", pa.int32()), ("part", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())]),
    )


def _pack(keyed: DataFrame, parts: DataFrame, size: int) -> DataFrame:
    """Blocks (ring, part, ids, vectors) of about `size` vectors each; parts: the count of each ring."""
    dealt = keyed.join(F.broadcast(parts), "ring").withColumn(
        "part", F.pmod(F.xxhash64("vec_id", "vector"), F.ceil(F.col("n") / size).cast("long"))
    )
    return dealt.select("vec_id", "ring", "part", "vector").groupBy("ring", "part").applyInArrow(
        _packed, "ring int, part long, ids binary, vectors binary"
    )


def _matrix(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int64).reshape(n, -1)


def _nearest(order: np.ndarray, held: np.ndarray, k: int) -> np.ndarray:
    """Rings of any query that come first and together hold k vectors besides the query's own."""
    return np.unique(np.concatenate([o[: int(np.searchsorted(h, k + 1)) + 1] for o, h in zip(order, held, strict=True)]))


def _asking(block: str, ring: int, rings: Rings, qids: bytes, queries: bytes, bounds: bytes) -> Iterator[pa.RecordBatch]:
    """A row for every group of the ring's blocks."""
    for group in range(-(-int(rings.count[ring]) // rings.group)):
        yield pa.record_batch(
            [pa.array([block], pa.string()), pa.array([ring], pa.int32()), pa.array([group], pa.int32()), pa.array([qids], pa.binary()), pa.array([queries], pa.binary()), pa.array([bounds], pa.binary())],
            names=["block", "ring", "group", "qids", "queries", "bounds"],
        )


def _first_rings(batches: Iterator[pa.RecordBatch], rings: Rings, k: int) -> Iterator[pa.RecordBatch]:
    """(query block, ring, group) of the rings with the best bounds that together hold enough vectors."""
    for batch in batches:
        for row in batch.to_pylist():
            q = _matrix(row["vectors"], len(row["ids"]) // 8)
            order = np.argsort(-rings.best_scores(q), axis=1, kind="stable")
            held = np.cumsum(rings.count[order], axis=1)
            for ring in _nearest(order, held, k):
                yield from _asking(row["block"], ring, rings, row["ids"], row["vectors"], b"")


def _more_rings(batches: Iterator[pa.RecordBatch], rings: Rings, k: int) -> Iterator[pa.RecordBatch]:
    """(query block, ring, group) of the further rings that some query's bound lets through."""
    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["ids"]) // 8
            q, ids = _matrix(row["vectors"], n), np.frombuffer(row["ids"], dtype=np.int64)
            found = {b["query_id"]: b["bound"] for b in row["bounds"] or []}
            least = np.array([found.get(int(i), np.iinfo(np.int64).min) for i in ids], dtype=np.int64)
            best = rings.best_scores(q)
            order = np.argsort(-best, axis=1, kind="stable")
            held = np.cumsum(rings.count[order], axis=1)
            done = _nearest(order, held, k)
            reach = best >= least[:, None].astype(np.float64)
            reach[:, done] = False
            for ring in np.flatnonzero(reach.any(axis=0)):
                some = reach[:, ring]
                yield from _asking(row["block"], ring, rings, ids[some].tobytes(), q[some].tobytes(), least[some].tobytes())


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles or longs where they hold them, else in whole numbers of any size."""
    largest = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(v.astype(np.float64)).max(initial=0)) * q.shape[1]
    if largest < 2**53:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    if largest < 2**62:
        return q @ v.T
    return np.clip(q.astype(object) @ v.T.astype(object), -_LONG, _LONG - 1).astype(np.int64)


def _compare(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k best of a block of vectors for each query, less those under its bound."""
    for batch in batches:
        for row in batch.to_pylist():
            qids, ids = np.frombuffer(row["qids"], dtype=np.int64), np.frombuffer(row["ids"], dtype=np.int64)
            q, v = _matrix(row["queries"], len(qids)), _matrix(row["vectors"], len(ids))
            scores = _products(q, v)
            least = np.frombuffer(row["bounds"], dtype=np.int64) if row["bounds"] else np.full(len(qids), np.iinfo(np.int64).min)
            out_q, out_v, out_s = [], [], []
            for i in range(len(qids)):
                s = scores[i]
                fit = np.flatnonzero((ids != qids[i]) & (s >= least[i]))
                if len(fit) > k:
                    edge = np.partition(s[fit], len(fit) - k)[len(fit) - k]
                    fit = fit[s[fit] >= edge]
                    fit = fit[np.lexsort((ids[fit], -s[fit]))[:k]]
                out_q.append(np.full(len(fit), qids[i]))
                out_v.append(ids[fit])
                out_s.append(s[fit])
            yield pa.record_batch([pa.array(np.concatenate(x), pa.int64()) for x in (out_q, out_v, out_s)], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Rows (query_id, rank, vec_id, score); both inputs have vec_id and embedding."""
    tidy = lambda df: df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where("vec_id is not null and embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null)")
    base, asked = tidy(vectors), tidy(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    lengths = sorted(r[0] for r in asked.select(F.size("embedding")).distinct().collect())  # at most the longest length
    out = None
    for n in lengths:
        part = _top_k_of_length(base.where(F.size("embedding") == n), asked.where(F.size("embedding") == n), k)
        out = part if out is None else out.union(part)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out


def _top_k_of_length(base: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = base.sparkSession
    squares = F.aggregate(F.transform("embedding", lambda x: F.floor(x * 1024).cast("double")), F.lit(0.0), lambda a, x: a + x * x)
    finite = F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    base, asked = base.where(finite), asked.where(finite)
    top, n = base.select(squares.alias("s")).agg(F.max("s"), F.count("*")).first()
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    wanted = min(MOST_PIVOTS, max(PIVOTS, math.isqrt(n) // 64))
    drawn = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE * wanted).select("vec_id", "embedding").toArrow()
    sample = integers(drawn.column("embedding").combine_chunks())[1]
    rings = choose_pivots(sample, top, wanted)
    schema = "vec_id long, ring int, distance double, vector binary"
    keyed = stash(base.mapInArrow(lambda b: _keyed(b, rings), schema))
    known = keyed.groupBy("ring").agg(F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high"))
    total = len(rings.pivots) * RINGS
    rings.low, rings.high, rings.count = np.zeros(total), np.zeros(total), np.zeros(total, dtype=np.int64)
    rows = known.collect()  # at most MOST_PIVOTS * RINGS
    for r in rows:
        rings.low[r["ring"]], rings.high[r["ring"]], rings.count[r["ring"]] = r["low"], r["high"], r["n"]
    counts = lambda rows: spark.createDataFrame([(r["ring"], r["n"]) for r in rows], "ring int, n long")
    blocks = stash(_pack(keyed.drop("distance"), counts(rows), BLOCK))
    home = asked.mapInArrow(lambda b: _keyed(b, rings), schema).withColumn("ring", (F.col("ring") / RINGS).cast("int"))
    home = stash(home.drop("distance"))
    parts = home.groupBy("ring").agg(F.count("*").alias("n")).collect()  # at most MOST_PIVOTS
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    query_blocks = stash(_pack(home, counts(parts), QUERY_BLOCK).select(F.concat_ws("-", "ring", "part").alias("block"), "ids", "vectors"))
    row = "block string, ring int, group int, qids binary, queries binary, bounds binary"
    found = "query_id long, vec_id long, score long"
    group = F.pmod("part", F.ceil(F.col("n") / rings.group).cast("long")).cast("int")
    side = blocks.join(F.broadcast(counts(rows)), "ring").select("ring", group.alias("group"), "ids", "vectors")
    first = stash(query_blocks.mapInArrow(lambda b: _first_rings(b, rings, k), row).join(side, ["ring", "group"]).mapInArrow(lambda b: _compare(b, k), found))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    members = query_blocks.mapInArrow(_members, "block string, query_id long")
    bounds = members.join(kth, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "bound")).alias("bounds"))
    asked_again = query_blocks.join(bounds, "block", "left")
    more = asked_again.mapInArrow(lambda b: _more_rings(b, rings, k), row).join(side, ["ring", "group"]).mapInArrow(lambda b: _compare(b, k), found)
    return (
        first.union(stash(more))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], dtype=np.int64)
            yield pa.record_batch([pa.array([row["block"]] * len(ids), pa.string()), pa.array(ids)], names=["block", "query_id"])
