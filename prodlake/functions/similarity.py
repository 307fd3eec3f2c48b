"""Functions that Spark lacks, as Arrow-batched UDFs. Use them on short keys, behind a blocking join."""

from __future__ import annotations

import html
import json
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Texts of this length or more have frequent letters left out by the rule, and are compared one by one; stretches compared at a time.
POPULAR, AT_ONCE = 200, 4096


def _codes(texts: list[str], width: int, fill: int) -> np.ndarray:
    """Letters as numbers, one text a row, filled up with a number that is no letter."""
    out = np.full((len(texts), width), fill, dtype=np.int32)
    for k, t in enumerate(texts):
        out[k, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    return out


def _longest(a: np.ndarray, b: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in a, place in b, length) of the longest common block of every stretch, the first in a and then in b of equals.

    spans: rows (a from, a to, b from, b to). A row of the table of common suffixes is made for all stretches at once.
    """
    best, at_a, at_b = (np.zeros(len(spans), dtype=np.int64) for _ in range(3))
    low, high = int(spans[:, 2].min()), int(spans[:, 3].max())
    columns = np.arange(low, high)
    b = np.where((columns >= spans[:, 2:3]) & (columns < spans[:, 3:4]), b[:, low:high], -2)
    rows = np.arange(a.shape[1])
    a = np.where((rows >= spans[:, 0:1]) & (rows < spans[:, 1:2]), a, -1)
    run = np.zeros((len(spans), high - low + 1), dtype=np.int16)
    for i in range(int(spans[:, 0].min()), int(spans[:, 1].max())):
        run[:, 1:] = (run[:, :-1] + 1) * (b == a[:, i : i + 1])
        size = run.max(axis=1)
        more = np.flatnonzero(size > best)
        if len(more):
            best[more] = size[more]
            at_a[more] = i + 1 - best[more]
            at_b[more] = low + run[more].argmax(axis=1) - best[more]
    return at_a, at_b, best


def matching_letters(left: list[str], right: list[str]) -> np.ndarray:
    """Letters in the matching blocks of each pair of non-empty texts: the longest block, then those left and right of it, and so on.

    All pairs go a round together: the longest blocks of all stretches are found, and what lies beside them is the next round.
    """
    total = np.zeros(len(left), dtype=np.int64)
    a, b = _codes(left, max(map(len, left)), -1), _codes(right, max(map(len, right)), -2)
    pair = np.arange(len(left))
    spans = np.array([(0, len(x), 0, len(y)) for x, y in zip(left, right, strict=True)], dtype=np.int64)
    while len(pair):
        i, j, n = _longest(a[pair], b[pair], spans)
        np.add.at(total, pair, n)
        before = np.column_stack([spans[:, 0], i, spans[:, 2], j])
        behind = np.column_stack([i + n, spans[:, 1], j + n, spans[:, 3]])
        pair, spans = np.concatenate([pair, pair])[np.tile(n > 0, 2)], np.concatenate([before, behind])[np.tile(n > 0, 2)]
        open_ = (spans[:, 0] < spans[:, 1]) & (spans[:, 2] < spans[:, 3])
        pair, spans = pair[open_], spans[open_]
    return total


def block_ratios(pairs: list[tuple[str, str]]) -> dict[tuple[str, str], float]:
    """T-26 for different pairs: those of like length are compared together."""
    out = {p: 0.0 for p in pairs}
    short = sorted((p for p in out if p[0] and p[1] and max(len(p[0]), len(p[1])) < POPULAR), key=lambda p: (len(p[1]), len(p[0])))
    for at in range(0, len(short), AT_ONCE):
        part = short[at : at + AT_ONCE]
        for p, n in zip(part, matching_letters([p[0] for p in part], [p[1] for p in part]).tolist(), strict=True):
            out[p] = 2.0 * n / (len(p[0]) + len(p[1]))
    for p in out:
        if p[0] and p[1] and max(len(p[0]), len(p[1])) >= POPULAR:
            out[p] = SequenceMatcher(None, *p).ratio()
    return out


@F.pandas_udf(T.DoubleType())
def matching_blocks_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """T-26: Ratcliff-Obershelp ratio; not symmetric, so the order of arguments counts. 0 if either is empty or null."""
    pairs = list(zip(left.fillna(""), right.fillna(""), strict=True))
    known = block_ratios(list(dict.fromkeys(pairs)))  # a batch holds few different pairs where one side recurs
    return pd.Series([known[p] for p in pairs], dtype="float64")


def indel(a: str | None, b: str | None) -> float:
    """T-27: 200 * longest common subsequence / sum of lengths; 100 for two empty texts.

    One row of the table of subsequence lengths is a bit mask, so a character costs a few word operations.
    """
    a, b = a or "", b or ""
    if not a and not b:
        return 100.0
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    common = len(a) - row.bit_count()
    return 200.0 * common / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def indel_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    seen: dict[tuple, float] = {}
    pairs = list(zip(left, right, strict=True))
    for a, b in pairs:
        if (a, b) not in seen:
            seen[a, b] = indel(a, b)
    return pd.Series([seen[p] for p in pairs], dtype="float64")


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def unescape(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else html.unescape(t))


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """H-01: JSON with sorted keys and no blanks; null where the text is no JSON."""

    def tidy(t: str | None) -> str | None:
        try:
            return None if t is None else json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        except ValueError:
            return None

    return text.map(tidy)
