"""Toxicity by weak supervision.

Voters are lexicon entries (whole words, and stems: the first bytes of a word; present, repeated, or at
some share of the words), patterns of writing, and the absence of both. Stated lexicons are joined by
entries that the labelled rows show to go with toxicity; that choice is the labels' only part in voting.
A generative label model, fitted by EM over the votes alone, estimates every voter's rates under both
classes and, from what is left unexplained, the correlations between voters, by which it discounts those
that repeat each other. A linear classifier is then trained on the posterior labels, over the same kinds
of entries and the patterns, and scores every document; labels set the line that parts its scores.

Training reads a bounded sample of the labelled rows (labelled.SAMPLE, SAMPLE_BYTES); scoring reads all
rows whole. Only the text enters a score.

Defined cases: null and empty texts get the score of a text without any known word; repeated rows and
equal texts get equal scores; rows with a null doc_id are scored and not held out; without labelled rows
the stated lexicons alone decide; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prodlake.llm.hashing import LETTER_BYTE, U64, range_hashes, texts_to_words, words_of
from prodlake.llm.labelled import SAMPLE, remainder, training_rows
from prodlake.llm.session import carried, pieces, text_of, unpacked

# Insults that start the lexicon voters (fixed values, our own choice).
LEXICON = {
    "en": "idiot moron stupid loser scum trash pathetic disgusting worthless clown dumb fool jerk imbecile filth vermin",
    "de": "idiot dummkopf trottel arschloch abschaum versager widerlich wertlos blödmann dreck",
    "fr": "idiot imbécile crétin connard ordure minable pathétique dégoûtant débile salaud",
    "es": "idiota imbécil estúpido cabrón basura patético asqueroso inútil payaso escoria",
}
#: Phrases of abuse (fixed values, our own choice), each a pattern voter with those of its language.
PHRASES = {
    "en": ("shut up", "go to hell", "you idiot", "you moron", "hate you", "kill yourself", "piece of"),
    "de": ("halt die", "halt's maul", "du idiot", "verpiss dich", "hasse dich"),
    "fr": ("ta gueule", "va te faire", "sale con", "espèce de", "je te hais"),
    "es": ("cállate", "vete a la", "hijo de", "te odio", "eres un idiota"),
}
STEMS = (4, 5, 6, 7)
#: An entry's levels: present, twice or more, then also one in 200 words, one in 50.
LEVELS = 4
VOTERS, FEATURES = 64, 4096
#: Entries that may pass the test of evidence by chance: log(candidates / CHANCE) is the least evidence in nats.
CHANCE = 1000.0
#: Weight of a stated insult that the sample shows too rarely to judge; the constant of an untrained model asks for two.
UNSEEN = 2.5
_ROUNDS = 60


def _hits(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, entry, occurrences) of the words and stems of texts, ascending, and each text's words.

    An entry is 32 bits of the hash of a word, or of its first bytes with a seed for their number; words no
    longer than a stem have none. With `wanted` (ascending entries), others are left out.
    """
    words, starts, ends, bounds, data = texts_to_words(texts, LETTER_BYTE)
    raw = np.frombuffer(data, dtype=np.uint8)
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    table = None
    if wanted is not None:
        table = np.zeros(1 << 20, dtype=bool)
        table[wanted & 0xFFFFF] = True
    found = []
    for n in (0, *STEMS):
        long = slice(None) if not n else ends - starts > n
        hashes = words if not n else range_hashes(low, starts[long], starts[long] + n) + U64(n << 32)
        keys, own = (hashes >> U64(32)).astype(np.int64), doc[long]
        if wanted is not None:
            maybe = table[keys & 0xFFFFF]
            keys, own = keys[maybe], own[maybe]
            same = wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys if len(wanted) else np.zeros(len(keys), dtype=bool)
            keys, own = keys[same], own[same]
        found.append(own << 32 | keys)
    pairs, times = np.unique(np.concatenate(found), return_counts=True)
    return pairs >> 32, pairs & 0xFFFFFFFF, times, np.diff(bounds)


def levels(times: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each entry of a document: present, twice or more, then also one in 200 words, one in 50."""
    twice = times >= 2
    return np.stack([np.ones(len(times), dtype=bool), twice, twice & (200 * times >= words), twice & (50 * times >= words)])


_BYTES = {"upper": range(65, 91), "lower": range(97, 123), "marks": [33], "stars": [42], "symbols": [ord(c) for c in "@#$%&"], "digits": range(48, 58)}
PATTERNS = ["shouting", "much shouting", "exclaiming", "rows of marks", "masked words", "symbols for words", "stretched letters", "letters as digits", *PHRASES]
_MASKED = re.compile(r"[^\W\d_]\*{2,}|\*{2,}[^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1{3}")
_AS_DIGITS = re.compile(r"[^\W\d_][013457@$][^\W\d_]")


def patterns(texts: list[str | None]) -> np.ndarray:
    """Votes of the patterns for each text, 1 or 0; every one reads the whole text."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(d) for d in data])
    raw = np.frombuffer(b"\n".join([*data, b""]), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]]) if len(size) else size
    share = {}
    for name, members in _BYTES.items():
        kind = np.zeros(256, dtype=np.int64)
        kind[list(members)] = 1
        share[name] = np.add.reduceat(kind[raw], starts) if len(size) else size
    letters = np.maximum(share["upper"] + share["lower"], 1)
    out = np.zeros((len(texts), len(PATTERNS)), dtype=np.int8)
    out[:, 0] = (share["upper"] > 0) & (share["lower"] == 0)
    out[:, 1] = 10 * share["upper"] > 3 * letters
    out[:, 2] = 100 * share["marks"] > np.maximum(size, 1)
    for k, t in enumerate(texts):
        if not t:
            continue
        out[k, 3] = "!!" in t and t.count("!!") * 40 > len(t)
        out[k, 4] = "**" in t and _MASKED.search(t) is not None
        out[k, 5] = share["symbols"][k] > 2 and any(m in t for m in ("@#$", "#$%", "$%&", "%&#", "&%$", "@$#"))
        out[k, 6] = _STRETCHED.search(t) is not None
        out[k, 7] = share["digits"][k] + share["symbols"][k] > 0 and _AS_DIGITS.search(t) is not None
        low = t.lower()
        out[k, 8:] = [any(p in low for p in phrases) for phrases in PHRASES.values()]
    return out


@dataclass
class Toxicity:
    """A fitted classifier: ascending entries, weights by entry and level, the constant term, weights by pattern."""

    keys: np.ndarray
    weights: np.ndarray
    constant: float
    marks: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        docs, keys, times, words = _hits(texts, self.keys)
        total = np.zeros(len(texts))
        if len(docs):
            held = levels(times, words[docs])
            total = np.bincount(docs, weights=(self.weights[np.searchsorted(self.keys, keys)] * held.T).sum(axis=1), minlength=len(texts))
        if self.marks.any():
            total = total + patterns(texts) @ self.marks
        return 1 / (1 + np.exp(-np.clip(total + self.constant, -30, 30)))


def stated_entries() -> np.ndarray:
    hashes = words_of(" ".join(LEXICON.values()).encode(), LETTER_BYTE)[0]
    return np.unique((hashes >> U64(32)).astype(np.int64))


def label_model(votes: np.ndarray, rounds: int = 30, prior: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of class 1, log-odds of a vote by voter, correlations) from votes in {-1, 0, 1} and the share `prior` of class 1.

    EM over P(vote | class) of every voter, from a first guess by the sum of votes. Every fifth round the
    correlation of two voters' votes within the classes is estimated, and a voter that repeats others counts
    by 1 / (1 + sum of its correlations).
    """
    n, m = votes.shape
    total = votes.sum(axis=1)
    posterior = np.where(total > 0, 0.95, np.where(total < 0, 0.03, prior))
    centred = votes - votes.mean(axis=0)
    spread = np.sqrt((centred**2).mean(axis=0)) + 1e-6
    corr = (centred.T @ centred) / n / spread[:, None] / spread
    # votes that nearly coincide are taken as repeats from the start: the classes cannot explain that
    start = 1 / (1 + (np.clip(corr - 0.7, 0, 0.3) / 0.3).sum(axis=1) - np.clip(np.diag(corr) - 0.7, 0, 0.3) / 0.3)
    share = start
    levels = [(votes == v).astype(np.float32) for v in (-1, 0, 1)]
    even = np.log((1 - prior) / prior)
    for k in range(rounds):
        one, zero = posterior.sum() + 1, (1 - posterior).sum() + 1
        odds = [np.log((v.T @ posterior + 0.1) / (one + 0.3)) - np.log((v.T @ (1 - posterior) + 0.1) / (zero + 0.3)) for v in levels]
        odds[1] = np.zeros(m)  # an abstention says nothing: a voter of one language is silent on texts of all others
        odds[2], odds[0] = np.maximum(odds[2], even), np.minimum(odds[0], 0)  # a vote is right at least as often as wrong
        log_odds = sum(v @ (o * share) for v, o in zip(levels, odds, strict=True)) + np.log(prior / (1 - prior))
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        if k % 5 == 4 and m > 1:
            means = [(votes.T @ w) / max(w.sum(), 1e-9) for w in (posterior, 1 - posterior)]
            left = votes - posterior[:, None] * means[0] - (1 - posterior)[:, None] * means[1]
            spread = np.sqrt((left**2).mean(axis=0)) + 1e-6
            corr = (left.T @ left) / n / spread[:, None] / spread
            share = 1 / (1 + np.where(corr > 0.1, corr, 0).sum(axis=1) - np.diag(corr).clip(0.1))
            share = np.minimum(np.clip(share, 0.2, 1), start)
    return posterior, odds[2] - odds[1], corr


def covering(strength: np.ndarray, inverse: np.ndarray, docs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Up to VOTERS entries of most evidence, each counted by the toxic documents that few chosen ones cover yet.

    So that entries of a rare language are not crowded out by many of a common one.
    """
    good = (strength[inverse] > 0) & (label[docs] == 1)
    column, doc = inverse[good], docs[good]
    need = label.astype(float)
    share = strength / np.maximum(np.bincount(column, minlength=len(strength)), 1)
    chosen: list[int] = []
    while len(chosen) < VOTERS and len(column):
        gain = np.bincount(column, weights=need[doc], minlength=len(strength)) * share
        gain[chosen] = 0
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        chosen.append(best)
        need[doc[column == best]] /= 2
    return np.array(chosen, dtype=np.int64)


def dividing_line(raw: np.ndarray, label: np.ndarray) -> float:
    """The raw score that parts the labels with the fewest errors; of several, that in the widest gap.

    Scores are shifted so that it comes to 0.3, from which documents count as toxic.
    """
    order = np.argsort(raw, kind="stable")
    values = raw[order]
    ones = np.concatenate([[0], np.cumsum(label[order])])
    errors = ones + (len(raw) - np.arange(len(raw) + 1)) - (ones[-1] - ones)  # toxic ones below, clean ones above
    low, high = np.concatenate([[values[0] - 1], values]), np.concatenate([values, [values[-1] + 1]])
    errors = np.where(high > low, errors, len(raw) + 1)  # equal scores cannot be parted
    best = np.flatnonzero(errors == errors.min())
    at = best[np.argmax((high - low)[best])]
    return float((low[at] + high[at]) / 2)


def evidence(count: np.ndarray, with_one: np.ndarray, n: int, ones: float) -> np.ndarray:
    """-log of about the chance that an entry of `count` documents falls so unevenly on the classes."""
    rate = np.clip(ones / n, 1e-6, 1 - 1e-6)
    share = np.clip(with_one / np.maximum(count, 1), 1e-9, 1 - 1e-9)
    return count * (share * np.log(share / rate) + (1 - share) * np.log((1 - share) / (1 - rate)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int, np.ndarray, int]]) -> Toxicity:
    """From (entries, occurrences, words, patterns, label) of the training documents."""
    stated = stated_entries()
    prior = np.zeros((len(stated), LEVELS))
    prior[:, 0] = UNSEEN
    if not rows:
        return Toxicity(stated, prior, -4.0)
    label = np.array([r[4] for r in rows])
    entries, place = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
    held = levels(np.concatenate([r[1] for r in rows]).astype(np.int64), np.repeat([r[2] for r in rows], [len(r[0]) for r in rows]))
    docs = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    inverse = np.concatenate([place[h] * LEVELS + k for k, h in enumerate(held)])
    docs = np.concatenate([docs[h] for h in held])
    size = len(entries) * LEVELS
    count = np.bincount(inverse, minlength=size)
    support = max(4, len(rows) // 2000)
    with_one = np.bincount(inverse, weights=label[docs], minlength=size)
    ones, n = label.sum(), len(rows)
    odds = np.log((with_one + 0.5) / (ones + 1)) - np.log((count - with_one + 0.5) / (n - ones + 1))
    common = count >= support
    known = np.repeat(np.isin(entries, stated), LEVELS) & common
    proof = np.where(common, evidence(count, with_one, n, ones), 0)
    enough = max(np.log(max(common.sum(), 1) / CHANCE), 0.0)
    strength = np.where((odds > 0) & (proof > enough), proof, -1)
    voters = covering(strength, inverse, docs, label)
    voters = np.union1d(voters, np.flatnonzero(known & (odds > 1)))
    column = np.full(size, -1)
    column[voters] = np.arange(len(voters))
    seen = np.stack([r[3] for r in rows])
    # a pattern votes if the labels show it to go with toxicity, as an entry does
    marks_one, marks_all = label @ seen, seen.sum(axis=0)
    voting_marks = np.flatnonzero((marks_all >= support) & (marks_one * n > marks_all * ones) & (evidence(marks_all, marks_one, n, ones) > enough))
    votes = np.zeros((n, len(voters) + len(voting_marks) + 1), dtype=np.float32)
    voting = column[inverse] >= 0
    votes[docs[voting], column[inverse[voting]]] = 1
    votes[:, len(voters) : -1] = seen[:, voting_marks]
    votes[:, -1] = np.where(votes[:, : len(voters)].any(axis=1), 0, -1)  # no entry of any lexicon
    posterior, _, _ = label_model(votes, prior=float((ones + 1) / (n + 2)))
    # the strongest features under the posterior, then logistic regression on it
    soft = np.bincount(inverse, weights=posterior[docs], minlength=size)
    all_soft = posterior.sum()
    rank = np.where(common, evidence(count, soft, n, all_soft), 0)
    picked = np.argsort(-rank, kind="stable")[:FEATURES]
    picked = np.union1d(picked[rank[picked] > enough], voters)
    column = np.full(size, -1)
    column[picked] = np.arange(len(picked))
    used = column[inverse] >= 0
    row, col = docs[used], column[inverse[used]]
    held_marks, mark = np.nonzero(seen[:, voting_marks])
    row, col = np.concatenate([row, held_marks]), np.concatenate([col, len(picked) + mark])
    size_w = len(picked) + len(voting_marks)
    w, b = np.zeros(size_w), np.log((all_soft + 1) / (n - all_soft + 1))
    first = np.zeros(size_w + 1)
    second = np.zeros(size_w + 1)
    for t in range(1, 5 * _ROUNDS + 1):  # full-batch Adam with a small ridge
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=w[col], minlength=n) + b, -30, 30)))
        error = (p - posterior) / n
        grad = np.append(np.bincount(col, weights=error[row], minlength=size_w) + 2e-4 * w, error.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        step = 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    b += np.log(0.3 / 0.7) - dividing_line(np.bincount(row, weights=w[col], minlength=n) + b, label) if ones else 0.0
    keys = np.unique(picked // LEVELS)
    weights = np.zeros((len(keys), LEVELS))
    weights[np.searchsorted(keys, picked // LEVELS), picked % LEVELS] = w[: len(picked)]
    marks = np.zeros(len(PATTERNS))
    marks[voting_marks] = w[len(picked) :]
    # stated entries that the sample shows too rarely to judge keep a weight of which two make a vote
    unseen = ~np.isin(stated, entries[(count.reshape(-1, LEVELS)[:, 0] >= support)])
    keys, weights = np.concatenate([entries[keys], stated[unseen]]), np.concatenate([weights, prior[unseen]])
    keys, first = np.unique(keys, return_index=True)
    return Toxicity(keys, weights[first], float(b), marks)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input: text, y; output: bytes of entries, occurrences and patterns, number of words, y."""
    for batch in pieces(batches, 0):
        texts = batch.column(0).to_pylist()
        docs, keys, times, words = _hits(texts)
        cut = np.searchsorted(docs, np.arange(len(texts) + 1))
        own = lambda x, kind: pa.array([x[a:e].astype(kind).tobytes() for a, e in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
        marks = pa.array([m.tobytes() for m in patterns(texts)], pa.binary())
        yield pa.record_batch([own(keys, np.uint32), own(times, np.uint32), pa.array(words, pa.int64()), marks, batch.column(1)], names=["keys", "times", "words", "marks", "y"])


def training_features(rows: list[dict]) -> list[tuple[np.ndarray, np.ndarray, int, np.ndarray, int]]:
    got = [(np.frombuffer(r["keys"], dtype=np.uint32).astype(np.int64), np.frombuffer(r["times"], dtype=np.uint32), r["words"], np.frombuffer(r["marks"], dtype=np.int8), r["y"]) for r in rows]
    return sorted(got, key=lambda r: (r[4], len(r[0]), r[0].tobytes()))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Toxicity:
    rows = training_rows(docs, labels, "toxic", 4, 2, sample).select("text", "y")
    return fit(training_features(rows.mapInArrow(_features, "keys binary, times binary, words long, marks binary, y int").toArrow().to_pylist()))


def _score(batches: Iterator[pa.RecordBatch], model: Toxicity) -> Iterator[pa.RecordBatch]:
    """The first column is the text; the others are carried along."""
    for batch in pieces(batches, 0):
        score = model.scores(batch.column(0).to_pylist())
        yield pa.record_batch([*batch.columns[1:], pa.array(score)], names=[*batch.schema.names[1:], "score"])


def _scored(df: DataFrame, model: Toxicity) -> DataFrame:
    schema = StructType(df.schema.fields[1:]).add("score", "double")
    return df.mapInArrow(lambda b: _score(b, model), schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted)."""
    model = train(docs, labels, sample)
    return _scored(docs.select(*text_of(docs)[::-1]), model).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    rows = carried(docs, F.col("text").cast("string").alias("text"))
    return unpacked(_scored(rows, train(docs, labels, sample)).where("score < 0.3"), docs)
