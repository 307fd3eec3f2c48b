"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Each entry c becomes the integer x = floor(64 * c) + 1000000; the fit list is each distinct x vector once. Its rows, less
their mean, make the matrix X, which is never held: it stays in blocks of rows on the shared folder. Starting from a unit
vector v, the recurrence alternates u = X v - beta u' and v' = X^T u - alpha v, each made orthogonal to all earlier
vectors of its kind. One step is one pass over the blocks. A block adds to three sums: X^T (X v), the products of the new
u with every earlier one, and its square. The earlier u need no storage: each lies in the range of X, so a task makes its
rows of them as X M from the small matrix M that the driver keeps, and the u is made orthogonal by the sums, as the
X^T u of earlier steps are known. The driver holds vectors of one entry a dimension only. The singular values of the
small bidiagonal matrix over sqrt(n) are the deviations along the components, its right singular vectors bring the v to
the components.

Steps go on until the residuals of the components asked for and of the next one are at the level of rounding, or v spans
all dimensions. Where the recurrence breaks down (a constant dimension, repeated singular values), it goes on from a new
vector orthogonal to the others, so that components of one deviation are all found.

Defined cases: vectors null, empty, or holding null or non-finite entries are dropped; repeated rows and equal vectors
each return their rows but count once in the fit; vectors of each length are a table of their own; components along which
the fit list does not vary (deviation under 1e-12 of the largest) are left out, so one distinct vector alone gives no
rows; components of equal deviation are any orthonormal ones of their space; null ids stay; other columns are ignored.
Entries beyond 2^52 / 64 are held there, and a row's `deviation` beyond 64 bits is held at the largest long. The sign
of a component is that of its largest entry, the same for all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.session import lean_batches, stash

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
#: Rows of a block.
BLOCK = 4096
#: Deviations under this share of the largest are none; residuals under this share are rounding.
NONE, ROUNDING = 1e-12, 1e-15
_HELD = 1 << 52
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(places of usable rows, their x): lists of one length, without null lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = column.flatten()
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 0), dtype=np.int64)
    values = np.asarray(pc.fill_null(flat, float("nan")), dtype=np.float64).reshape(n, -1)
    fine = np.isfinite(values).all(axis=1)
    return np.flatnonzero(fine), (np.clip(np.floor(SCALE * values[fine]), -_HELD, _HELD)).astype(np.int64) + OFFSET


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, x): the vector as bytes, 4 an entry where all fit, else 8; equal vectors have equal bytes."""
    for batch in batches:
        rows, x = _integers(batch.column(1))
        small = (np.abs(x) < 1 << 31).all(axis=1)
        coded = [(r.astype("<i4") if s else r.astype("<i8")).tobytes() for r, s in zip(x, small.tolist(), strict=True)]
        yield pa.record_batch([batch.column(0).take(pa.array(rows)), pa.array(coded, pa.binary())], names=["vec_id", "x"])


def _decoded(column: pa.Array, d: int) -> np.ndarray:
    raw = column.to_pylist()
    return np.array([np.frombuffer(r, dtype="<i4" if len(r) == 4 * d else "<i8") for r in raw], dtype=np.int64).reshape(len(raw), d)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Distinct vectors packed into blocks (rows, x as bytes, sums of the columns of low and high halves)."""
    held: list[np.ndarray] = []

    def block() -> pa.RecordBatch:
        x = np.concatenate(held)
        low, high = (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
        return pa.record_batch([pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary()), pa.array([low.tolist()], pa.list_(pa.int64())), pa.array([high.tolist()], pa.list_(pa.int64()))], names=["rows", "x", "low", "high"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(_decoded(batch.column(0), d))
        if sum(len(h) for h in held) >= BLOCK:
            yield block()
            held = []
    if held:
        yield block()


class Centre:
    """n and the sums S of the fit list; rows less their mean, and exact deviations."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = [s // n for s in sums]
        self.rest = np.array([(s % n) / n for s in sums])

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, the whole part of the mean taken off in integers first."""
        return (x - np.array(self.whole, dtype=np.int64)).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - S)^2, exact."""
        if max(float(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums))) < 2**61:
            far = x * self.n - np.array(self.sums, dtype=np.int64)
            if float(np.abs(far).max(initial=0)) ** 2 * x.shape[1] < 2**62:
                return (far * far).sum(axis=1)
        far = x.astype(object) * self.n - np.array(self.sums, dtype=object)
        return np.array([min(v, (1 << 63) - 1) for v in (far * far).sum(axis=1)], dtype=np.int64)


def _products(batches: Iterator[pa.RecordBatch], centre: Centre, now: np.ndarray, before: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a task: X^T w, U^T w and w w over its rows, of w = X now and U = X before."""
    d, k = before.shape
    sums = np.zeros(d + k + 1)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            x = centre.rows(np.frombuffer(raw, dtype=np.int64).reshape(-1, d))
            w = x @ now
            sums[:d] += x.T @ w
            sums[d : d + k] += (x @ before).T @ w
            sums[-1] += w @ w
    yield pa.record_batch([pa.array([sums.tolist()], pa.list_(pa.float64()))], names=["sums"])


def _covariance(batches: Iterator[pa.RecordBatch], centre: Centre, basis: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a task: the products of the whitened entries of its rows, and the squares of its rows."""
    d, k = basis.shape
    sums = np.zeros(k * k + 1)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            x = centre.rows(np.frombuffer(raw, dtype=np.int64).reshape(-1, d))
            w = x @ basis
            sums[:-1] += (w.T @ w).ravel()
            sums[-1] += (x * x).sum()
    yield pa.record_batch([pa.array([sums.tolist()], pa.list_(pa.float64()))], names=["sums"])


def _added(blocks: DataFrame, task, length: int) -> np.ndarray:
    """The tasks' rows added up entry by entry; they come in the order of the tasks, so that sums are the same each time."""
    rows = blocks.select("x").mapInArrow(task, "sums array<double>").toArrow().column("sums").combine_chunks()
    if not len(rows):
        return np.zeros(length)
    return np.asarray(rows.flatten()).reshape(len(rows), length).sum(axis=0)


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """v less its parts along the basis, twice, as once leaves rounding behind."""
    for _ in range(2):
        if basis:
            q = np.array(basis)
            v = v - q.T @ (q @ v)
    return v


def _next(v: np.ndarray, basis: list[np.ndarray], least: float, draw: np.random.Generator) -> tuple[np.ndarray, float]:
    """The next unit vector and its length; after a breakdown a new one, and length 0."""
    v = _orthogonal(v, basis)
    size = float(np.linalg.norm(v))
    if size > least:
        return v / size, size
    v = _orthogonal(draw.standard_normal(len(v)), basis)
    return v / np.linalg.norm(v), 0.0


def bidiagonalised(blocks: DataFrame, centre: Centre, d: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right singular vectors as columns) of the centred fit list: the largest `wanted`."""
    draw = np.random.default_rng(12)
    vs: list[np.ndarray] = []
    ms: list[np.ndarray] = []  # u_j = X m_j
    images: list[np.ndarray] = []  # X^T u_j
    alphas: list[float] = []
    betas: list[float] = []
    v, beta = _next(draw.standard_normal(d), vs, 0.0, draw)
    beta, largest = 0.0, 0.0
    while True:
        vs.append(v)
        now = v - beta * ms[-1] if ms and beta else v
        before = np.array(ms).T if ms else np.zeros((d, 0))
        sums = _added(blocks, lambda b, now=now, before=before: _products(b, centre, now, before), d + before.shape[1] + 1)
        g, h, s = sums[:d], sums[d:-1], float(sums[-1])
        size2 = s - float(h @ h)
        largest = max(largest, *alphas, *betas, float(np.sqrt(max(s, 0.0))))
        alpha = float(np.sqrt(max(size2, 0.0)))
        if alpha <= largest * NONE:
            alpha, m, image = 0.0, np.zeros(d), np.zeros(d)  # X v lies among the earlier u
        else:
            m = (now - before @ h) / alpha
            image = (g - (np.array(images).T @ h if images else 0.0)) / alpha
        alphas.append(alpha)
        ms.append(m)
        images.append(image)
        k = len(vs)
        b = np.diag(alphas) + np.diag(betas, 1)
        p, sigma, qt = np.linalg.svd(b)
        if k == d:
            break
        v, beta = _next(image - alpha * vs[-1], vs, largest * NONE, draw)
        # what a component is off by is beta times the last entry of its left vector
        seen = min(k, wanted + 1)
        if k > wanted and beta and (beta * np.abs(p[-1, :seen]) <= ROUNDING * sigma[0]).all():
            break
        betas.append(beta)
    some = min(wanted, k)
    return sigma[:some], np.array(vs).T @ qt[:some].T


def _whitened(batches: Iterator[pa.RecordBatch], centre: Centre, basis: np.ndarray, explained: np.ndarray, error: float) -> Iterator[pa.RecordBatch]:
    d, k = basis.shape
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            x = _decoded(part.column(1), d)
            n = len(x)
            each = pa.array(np.repeat(np.arange(n), k))
            yield pa.record_batch(
                [
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, centre.n)),
                    pa.array(np.repeat(centre.deviations(x), k)),
                    pa.array((centre.rows(x) @ basis).ravel()),
                    pa.array(np.tile(explained, n)),
                    pa.array(np.full(n * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def _whiten_length(coded: DataFrame, d: int, components: int) -> DataFrame | None:
    distinct = coded.select("x").distinct()
    blocks = stash(distinct.mapInArrow(lambda b: _blocks(b, d), "rows long, x binary, low array<long>, high array<long>"))
    place = lambda c: [F.sum(F.col(c)[j].cast("decimal(38,0)")) for j in range(d)]
    n, *sums = blocks.agg(F.sum("rows"), *place("low"), *place("high")).first()
    centre = Centre(n, [int(low) + (int(high) << 32) for low, high in zip(sums[:d], sums[d:], strict=True)])
    sigma, right = bidiagonalised(blocks, centre, d, min(components, d))
    kept = sigma > (sigma[0] * NONE if len(sigma) else 0)
    if not kept.any():
        return None
    sigma, right = sigma[kept], right[:, kept]
    right = right * np.sign(right[np.abs(right).argmax(axis=0), np.arange(right.shape[1])])
    basis = right * (np.sqrt(n) / sigma)
    k = basis.shape[1]
    sums = _added(blocks, lambda b: _covariance(b, centre, basis), k * k + 1)
    error = float(np.abs(sums[:-1].reshape(k, k) / n - np.eye(k)).max())
    explained = sigma**2 / sums[-1]
    return coded.mapInArrow(lambda b: _whitened(b, centre, basis, explained, error), _OUT)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector."""
    spark = vectors.sparkSession
    lean_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("size(embedding) > 0")
    out = None
    for d in sorted(r[0] for r in rows.select(F.size("embedding")).distinct().collect()):  # as many as there are lengths
        coded = stash(rows.where(F.size("embedding") == d).mapInArrow(_coded, "vec_id long, x binary"))
        if coded.isEmpty():
            continue
        part = _whiten_length(coded, d, components)
        if part is not None:
            out = part if out is None else out.union(part)
    return spark.createDataFrame([], _OUT) if out is None else out
