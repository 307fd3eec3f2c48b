"""Vectorised word splitting and hashing over UTF-8 bytes.

A batch of texts is one byte buffer. Words are maximal runs of bytes other than ASCII white space
(0x20, 0x09-0x0D), after A-Z are lower-cased; both rules touch ASCII only, so working on bytes
equals working on characters. Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
CHUNK = 1 << 18


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(BASE, CHUNK + 1)
_DOWN = _powers(BASE_INVERSE, CHUNK + 1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_WORD_BYTE = np.ones(256, dtype=bool)
_WORD_BYTE[[0x20, 9, 10, 11, 12, 13]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (the public splitmix64 constants), so that low bits are usable."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[starts[i]:ends[i]] for ascending starts; ranges may overlap.

    The sum of (value + 1) * BASE**place, whatever the length of a range and of those beside it.
    """
    out = np.empty(len(starts), dtype=U64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        limit = base + CHUNK
        to = at + int(np.searchsorted(starts[at:], limit - CHUNK // 4))
        over = np.flatnonzero(ends[at:to] > limit)
        if len(over) and over[0] == 0:
            # a range longer than a chunk: this one piecewise, the power of BASE carried along
            acc, scale, end = np.zeros(1, dtype=U64), np.ones(1, dtype=U64), int(ends[at])
            for k in range(base, end, CHUNK):
                part = values[k : min(k + CHUNK, end)].astype(U64) + U64(1)
                acc += scale * (part * _UP[: len(part)]).sum(dtype=U64)
                scale *= _UP[CHUNK]
            out[at] = acc[0]
            at += 1
            continue
        if len(over):
            to = at + int(over[0])
        part = values[base : int(ends[at:to].max())].astype(U64) + U64(1)
        prefix = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(part * _UP[: len(part)], out=prefix[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (prefix[e] - prefix[s]) * _DOWN[s]
        at = to
    return mix(out)


#: Letters only: ASCII letters and all bytes of other characters.
LETTER_BYTE = np.zeros(256, dtype=bool)
LETTER_BYTE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(data: bytes, word_byte: np.ndarray = _WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of every word of a buffer."""
    if not data:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=U64), none, none
    low = LOWER[np.frombuffer(data, dtype=np.uint8)]
    inside = word_byte[low]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    return range_hashes(low, starts, ends), starts, ends


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, dtype=U64)
    starts = np.arange(len(words) - n + 1, dtype=np.int64)
    return range_hashes(words, starts, starts + n)


def texts_to_words(texts: list[str | None], word_byte: np.ndarray = _WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """All words of many texts: (hash, start, end, first word of each text and a last bound, buffer).

    A null counts as empty. Texts are parted by one newline in the buffer.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    data = b"\n".join(parts)
    hashes, starts, ends = words_of(data, word_byte)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return hashes, starts, ends, np.searchsorted(starts, bounds), data
