"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Line features are counts by kind of byte, word repetition, length and the like,
each cut into bins at quantiles; a line sees its own bins and those of its two neighbours. The chain also
weighs which label follows which. Training maximises the conditional likelihood of line labels drawn from
the labelled documents: lines of good documents are good; those of a bad document start as bad, and lines
that a first model finds as good as those of good documents are relabelled. Forward-backward gives each
line's marginal, and the mean of these weighted by length, put on a logistic scale, is the score.

Training reads a bounded sample of the labelled rows (TRAIN_ROWS, labelled.SAMPLE_BYTES); scoring reads all rows whole.
Only the text enters a score.

Defined cases: a null text is an empty one; an empty text is one empty line and is scored as such; very
long texts are scored whole; repeated rows and equal texts get equal scores; rows with a null doc_id are
scored and not held out; without labelled rows of both kinds every score is 0.5; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.hashing import U64, mix, range_hashes, words_of
from prodlake.llm.labelled import SAMPLE, remainder, training_rows
from prodlake.llm.session import pieces, text_of

BINS = 6
#: Lines of a chain that are walked one by one.
STRETCH = 256
TRAIN_ROWS = 3000
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\f\v", ".,;:", "!?", "|", "$%&#*@^~", "\"'()-/", "<>[]{}=_+\\`"]


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES) + 1, dtype=np.uint8)  # other control bytes
    table[128:] = len(_CLASSES)
    for k, chars in enumerate(_CLASSES):
        table[[ord(c) for c in chars]] = k
    return table


_CLASS = _class_table()
N_CLASSES = len(_CLASSES) + 2


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values by line, bytes of each line, bounds of each text's lines)."""
    data = b"\n".join((t or "").encode("utf-8", "surrogatepass").replace(b"\0", b" ") for t in texts)
    # a text's own line breaks and the one between texts look alike, so the texts' bounds are counted first
    per_text = np.array([(t or "").count("\n") + 1 for t in texts], dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    breaks = np.flatnonzero(raw == 10)
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(raw)]])
    size = ends - starts
    n = len(starts)
    kind = _CLASS[raw]
    share = np.empty((n, N_CLASSES))
    for c in range(N_CLASSES):
        total = np.concatenate([[0], np.cumsum(kind == c)])
        share[:, c] = total[ends] - total[starts]
    share /= np.maximum(size, 1)[:, None]
    words, ws, we = words_of(data)
    line = np.searchsorted(starts, ws, side="right") - 1
    count = np.bincount(line, minlength=n).astype(float)
    key = words ^ mix(line.astype(U64))
    order = np.argsort(key)
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, dtype=bool)
    distinct = np.bincount(line[order][fresh], minlength=n)
    same_next = np.concatenate([(words[1:] == words[:-1]) & (line[1:] == line[:-1]), [False]]) if len(words) else np.zeros(0, dtype=bool)
    # the kinds of a word's last two bytes tell words that end in marks; a word by itself between bars tells lists
    last = kind[we - 1] if len(we) else np.zeros(0, dtype=np.uint8)
    marked = np.bincount(line, weights=(last == 7) | (last == 5), minlength=n)
    one_byte = np.bincount(line, weights=(we - ws) == 1, minlength=n)
    letters = np.bincount(line, weights=we - ws, minlength=n)
    whole = range_hashes(raw, starts, ends) if n else np.zeros(0, dtype=U64)
    doc = np.repeat(np.arange(len(texts)), per_text)
    again = whole ^ mix(doc.astype(U64))
    _, inverse, times = np.unique(again, return_inverse=True, return_counts=True)
    some = np.maximum(count, 1)
    values = np.column_stack(
        [share, np.log1p(size), np.log1p(count), letters / some, distinct / some, np.bincount(line, weights=same_next, minlength=n) / some,
         marked / some, one_byte / some, np.where(size > 0, times[inverse], 1)]
    )
    return values, size, np.concatenate([[0], np.cumsum(per_text)])


@dataclass
class Crf:
    """Bin edges by feature, weights [position, feature, bin] for `good`, transitions, and the logistic scale."""

    edges: list[np.ndarray]
    weights: np.ndarray
    turns: np.ndarray
    scale: tuple[float, float]

    def bins(self, values: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, values[:, k]) for k, e in enumerate(self.edges)])

    def emissions(self, bins: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Score of `good` less that of `bad` for each line."""
        cells = np.arange(bins.shape[1]) * (BINS + 1) + bins
        own, before, after = (self.weights[p].ravel()[cells].sum(axis=1) for p in range(3))
        out = own.copy()
        first, last = bounds[:-1], bounds[1:] - 1
        shifted = np.concatenate([[0], before[:-1]])
        shifted[first] = self.weights[3, 0, 0]
        out += shifted
        shifted = np.concatenate([after[1:], [0]])
        shifted[last] = self.weights[3, 0, 1]
        return out + shifted

    def raw_scores(self, values: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Log-odds of the length-weighted mean marginal of each text's lines."""
        good = marginals(self.emissions(self.bins(values), bounds), bounds, self.turns)[0]
        weight = size + 1.0
        mean = np.add.reduceat(good * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])
        return np.log((mean + 1e-3) / (1 - mean + 1e-3))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * self.raw_scores(*line_features(texts)) + self.scale[1], -30, 30)))


def _products(emit: np.ndarray, start: np.ndarray, length: np.ndarray, first: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Products [from, to, stretch] of the steps into every line of a stretch, in logarithms; a chain's first line has none."""
    out = np.zeros((2, 2, len(start)))
    out[0, 1] = out[1, 0] = -np.inf
    order = np.argsort(-length, kind="stable")
    alive = len(length) - np.searchsorted(np.sort(length), np.arange(int(length.max())), side="right")
    for t in range(int(length.max())):
        who = order[: alive[t]]
        who = who[~first[who]] if t == 0 else who
        now = out[:, :, who]
        e = emit[start[who] + t]
        out[:, 0, who] = np.logaddexp(now[:, 0] + turns[0, 0], now[:, 1] + turns[1, 0])
        out[:, 1, who] = np.logaddexp(now[:, 0] + turns[0, 1], now[:, 1] + turns[1, 1]) + e
    return out


def _incoming(emit: np.ndarray, start: np.ndarray, length: np.ndarray, first: np.ndarray, last: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages into the stretches of chains: from the line before their first, and from behind their last.

    Chains are walked stretch by stretch, all at once: as many steps as the longest has stretches.
    """
    step = _products(emit, start, length, first, turns)
    into, behind = np.zeros(len(start)), np.zeros(len(start))
    place = np.arange(len(start)) - np.maximum.accumulate(np.where(first, np.arange(len(start)), 0))
    for k in range(int(place.max())):
        at = np.flatnonzero((place == k) & ~last)
        f = np.where(first[at], emit[start[at]], into[at])
        into[at + 1] = np.logaddexp(step[0, 1, at], f + step[1, 1, at]) - np.logaddexp(step[0, 0, at], f + step[1, 0, at])
    for k in range(int(place.max()), 0, -1):
        at = np.flatnonzero(place == k)
        b = behind[at]
        behind[at - 1] = np.logaddexp(step[1, 0, at], step[1, 1, at] + b) - np.logaddexp(step[0, 0, at], step[0, 1, at] + b)
    return into, behind


def marginals(emit: np.ndarray, bounds: np.ndarray, turns: np.ndarray, mass: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(good) by line, sums of pair marginals [from, to], log partition functions' sum).

    Chains are cut into stretches of STRETCH lines. A stretch as a whole is a 2 by 2 matrix, and these give the messages
    that reach it, so that all stretches are then walked at once, place by place: a chain of n lines takes a few times
    STRETCH + n / STRETCH steps. Messages are ratios P(good) : P(bad), so one number a line. `mass` weighs the
    pairs of each chain, 1 if it is left out.
    """
    n = len(emit)
    pair = np.zeros((2, 2))
    if not n:
        return np.zeros(0), pair, 0.0
    lines = np.diff(bounds)
    cuts = -(-lines // STRETCH)
    chain = np.repeat(np.arange(len(lines)), cuts)
    inside = np.arange(len(chain)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    start = bounds[:-1][chain] + inside * STRETCH
    length = np.minimum(bounds[1:][chain] - start, STRETCH)
    first, last = inside == 0, inside == cuts[chain] - 1
    into, behind = _incoming(emit, start, length, first, last, turns) if len(chain) > len(lines) else (np.zeros(len(chain)), np.zeros(len(chain)))
    order = np.argsort(-length, kind="stable")
    start, length, first, last, into, behind, chain = (x[order] for x in (start, length, first, last, into, behind, chain))
    weight = np.ones(len(chain)) if mass is None else mass[chain]
    most = int(length[0])
    alive = len(length) - np.searchsorted(length[::-1], np.arange(most), side="right")
    forward, backward = np.zeros(n), np.zeros(n)
    good_good, good_bad, bad_good, bad_bad = turns[1, 1], turns[1, 0], turns[0, 1], turns[0, 0]
    z = np.zeros(len(start))
    for t in range(most):
        at = start[: alive[t]] + t
        f = into[: alive[t]] if t == 0 else forward[at - 1]
        up, down = np.logaddexp(f + good_good, bad_good), np.logaddexp(f + good_bad, bad_bad)
        fresh = first[: alive[t]] & (t == 0)
        forward[at] = emit[at] + np.where(fresh, 0.0, up - down)
        z[: alive[t]] += np.where(fresh, 0.0, down)
    ends = start + length - 1
    z += np.where(last, np.logaddexp(forward[ends], 0), 0.0)
    backward[ends] = behind

    def pairs(at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Marginals of the lines `at` with their next ones, whose backward messages are known."""
        b = backward[at + 1] + emit[at + 1]
        logs = np.array([[bad_bad + 0 * b, bad_good + b], [forward[at] + good_bad, forward[at] + good_good + b]])
        logs -= logs.max(axis=(0, 1))
        p = np.exp(logs)
        return (p / p.sum(axis=(0, 1))) @ weight

    for t in range(most - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        b = backward[at + 1] + emit[at + 1]
        backward[at] = np.logaddexp(b + good_good, good_bad) - np.logaddexp(b + bad_good, bad_bad)
        pair += pairs(at, weight[: alive[t + 1]])
    if not first.all():
        pair += pairs(start[~first] - 1, weight[~first])
    good = 1 / (1 + np.exp(-np.clip(forward + backward, -30, 30)))
    return good, pair, float(z.sum())


def fit(values: np.ndarray, size: np.ndarray, bounds: np.ndarray, label: np.ndarray, rounds: int = 120) -> Crf:
    """From the lines of the training documents and the label of each document; both labels must occur."""
    edges = [np.unique(np.quantile(values[:, k], np.arange(1, BINS + 1) / (BINS + 1))) for k in range(values.shape[1])]
    model = Crf(edges, np.zeros((4, values.shape[1], BINS + 1)), np.zeros((2, 2)), (1.0, 0.0))
    bins = model.bins(values)
    doc = np.repeat(np.arange(len(label)), np.diff(bounds))
    # documents count alike within their label, and both labels alike
    mass = np.array([0.5 / max(1, (label == 0).sum()), 0.5 / max(1, (label == 1).sum())])[label]
    line_mass = (size + 1.0) * mass[doc] / np.bincount(doc, weights=size + 1.0)[doc]
    good = label[doc].astype(float)
    cells = np.arange(values.shape[1]) * (BINS + 1) + bins
    n_cells = values.shape[1] * (BINS + 1)
    lean = np.zeros(n_cells)
    for k in range(2):  # a first model of lines by themselves tells the good lines of bad documents
        one = np.zeros(n_cells)
        zero = np.zeros(n_cells)
        for c in range(cells.shape[1]):
            one += np.bincount(cells[:, c], weights=line_mass * good, minlength=n_cells)
            zero += np.bincount(cells[:, c], weights=line_mass * (1 - good), minlength=n_cells)
        lean = np.log(one / one.sum() + 1e-5) - np.log(zero / zero.sum() + 1e-5)
        score = lean[cells].sum(axis=1)
        usual = np.quantile(score[label[doc] == 1], 0.25)
        good = np.where((label[doc] == 0) & (score < max(usual, 0)), 0.0, 1.0)
    chain_mass = mass / np.diff(bounds)
    weight = chain_mass[doc]
    turn_from, turn_to = good[:-1].astype(int), good[1:].astype(int)
    inner = doc[:-1] == doc[1:]
    observed = np.zeros((2, 2))
    np.add.at(observed, (turn_from[inner], turn_to[inner]), weight[:-1][inner])
    theta = np.zeros(3 * n_cells + 2 + 3)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    prev_ok, next_ok = np.concatenate([[False], inner]), np.concatenate([inner, [False]])

    def load(theta: np.ndarray) -> None:
        model.weights[:3] = theta[: 3 * n_cells].reshape(3, values.shape[1], BINS + 1)
        model.weights[3, 0, 0], model.weights[3, 0, 1] = theta[3 * n_cells], theta[3 * n_cells + 1]
        model.turns = np.array([[theta[-3], theta[-2]], [0.0, theta[-1]]])

    for t in range(1, rounds + 1):
        load(theta)
        p, expected, _ = marginals(model.emissions(bins, bounds), bounds, model.turns, chain_mass)
        error = (p - good) * weight
        grad = np.zeros_like(theta)
        back, ahead = np.concatenate([error[1:], [0]]), np.concatenate([[0], error[:-1]])
        back[~next_ok] = 0
        ahead[~prev_ok] = 0
        for place, e in enumerate((error, back, ahead)):
            part = grad[place * n_cells : (place + 1) * n_cells]
            for c in range(cells.shape[1]):
                part += np.bincount(cells[:, c], weights=e, minlength=n_cells)
        grad[3 * n_cells], grad[3 * n_cells + 1] = error[~prev_ok].sum(), error[~next_ok].sum()
        grad[-3:] = [expected[0, 0] - observed[0, 0], expected[0, 1] - observed[0, 1], expected[1, 1] - observed[1, 1]]
        grad += 1e-5 * theta
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta = theta - 0.08 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    load(theta)
    return model


def calibrate(model: Crf, raw: np.ndarray, label: np.ndarray) -> None:
    """Logistic scale of the raw scores by Newton steps, with a small ridge."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - label) * raw).sum() + 1e-2 * (a - 1), (p - label).sum()])
        curve = np.array([[(w * raw * raw).sum() + 1e-2, (w * raw).sum()], [(w * raw).sum(), w.sum()]])
        step = np.linalg.solve(curve, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    model.scale = (float(max(a, 1e-3)), float(b))


def train(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_ROWS) -> Crf | None:
    """Features are computed on the executors; the driver gets a few numbers for each line of the sample."""
    rows = training_rows(docs, labels, "quality", 5, 0, min(sample, SAMPLE))
    got = rows.mapInArrow(_lines, "doc_id long, y int, values binary, sizes binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["values"]))
    label = np.array([r["y"] for r in got])
    if len(set(label.tolist())) < 2:
        return None
    size = [np.frombuffer(r["sizes"], dtype=np.int64) for r in got]
    values = [np.frombuffer(r["values"], dtype=np.float32).reshape(len(s), -1).astype(np.float64) for r, s in zip(got, size, strict=True)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in size])])
    lines = np.concatenate(values), np.concatenate(size), bounds
    model = fit(*lines, label)
    calibrate(model, model.raw_scores(*lines), label)
    return model


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 1):
        values, size, bounds = line_features(batch.column(1).to_pylist())
        cut = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        yield pa.record_batch(
            [batch.column(0), batch.column(2), pa.array([values[a:e].astype(np.float32).tobytes() for a, e in cut], pa.binary()),
             pa.array([size[a:e].astype(np.int64).tobytes() for a, e in cut], pa.binary())],
            names=["doc_id", "y", "values", "sizes"],
        )


def _score(batches: Iterator[pa.RecordBatch], model: Crf | None) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 1):
        score = model.scores(batch.column(1).to_pylist()) if model else np.full(batch.num_rows, 0.5)
        yield pa.record_batch([batch.column(0), pa.array(score)], names=["doc_id", "score"])


def quality(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_ROWS) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted)."""
    model = train(docs, labels, sample)
    source = docs.select(*text_of(docs))
    return source.mapInArrow(lambda b: _score(b, model), "doc_id long, score double").select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
