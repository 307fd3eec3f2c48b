"""Byte-pair encoding and decoding with a given vocabulary file.

The words of a piece of a partition are encoded together. A pair occurrence index maps each pair of
neighbouring symbols that has a rank to all its places in all these words; the active ranks are applied
in ascending order, each to all its places at once, and the lists of the pairs that arise are updated.
This equals encoding word by word as long as no merge needs a symbol that a later merge makes; the
loader checks that.

Supported files: BPE models with an end-of-word suffix, over byte-level characters, whose normaliser is
NFC, white space to one blank, lower case, and whose words are the matches of a Split pattern. Added
tokens stand for themselves wherever their text occurs; unused truncation and padding are not applied.

Defined cases: null and empty texts have no tokens and decode to the empty string; repeated rows and
equal texts give equal rows; null ids are returned as they are; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.session import pieces, text_of

CACHE_WORDS = 200_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


class Bpe:
    """A vocabulary, its merges by rank, and the words met so far."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.added.values()]))
        for t, i in [*vocab.items(), *self.added.items()]:
            self.tokens[i] = t
        end = model["end_of_word_suffix"]
        self.inner = np.array([vocab[c] for c in byte_symbols()], dtype=np.int32)
        self.last = np.array([vocab[c + end] for c in byte_symbols()], dtype=np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        born = np.full(len(self.tokens), -1)
        np.maximum.at(born, self.made, np.arange(len(pairs)))
        if (np.maximum(born[self.left], born[self.right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = self.left << 32 | self.right
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # the file's classes of white space are Unicode's
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")).findall
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)))
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.bounds = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        self.decoded: list[str] = []

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.by_key[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the bounds of each word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        end = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        n = len(raw)
        symbol = self.inner[raw]
        symbol[end - 1] = self.last[raw[end - 1]]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[end - 1] = -1
        before[end - sizes] = -1
        index: dict[int, list[np.ndarray]] = {}

        def enter(places: np.ndarray, rank: np.ndarray) -> None:
            known = rank >= 0
            places, rank = places[known], rank[known]
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.concatenate([[0], cut])].tolist() if len(rank) else (), np.split(places, cut), strict=False):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(active, r)

        active: list[int] = []
        enter(np.flatnonzero(after >= 0), self.ranks(symbol, symbol[np.minimum(np.arange(1, n + 1), n - 1)])[after >= 0])
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b = self.left[r], self.right[r]
            follow = after[at]
            good = (symbol[at] == a) & (follow >= 0) & (symbol[follow] == b)
            at, follow = at[good], follow[good]
            if not len(at):
                continue
            if a == b:  # of overlapping places the first, third, ... of each row are taken
                at = np.unique(at)
                follow = after[at]
                fresh = np.concatenate([[True], at[1:] != follow[:-1]])
                start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                odd = (np.arange(len(at)) - start) % 2 == 0
                at, follow = at[odd], follow[odd]
            symbol[at] = self.made[r]
            symbol[follow] = -1
            beyond = after[follow]
            after[at] = beyond
            inside = beyond >= 0
            before[beyond[inside]] = at[inside]
            ahead = before[at]
            ahead = ahead[ahead >= 0]
            if len(ahead):
                enter(ahead, self.ranks(symbol[ahead], symbol[after[ahead]]))
            if inside.any():
                mine = at[inside]
                enter(mine, self.ranks(symbol[mine], symbol[after[mine]]))
        kept = symbol >= 0
        count = np.concatenate([[0], np.cumsum(kept)])
        return symbol[kept], np.concatenate([[0], count[end]])

    def split(self, text: str) -> list[str]:
        """Words of a text; added tokens come as themselves behind a NUL blank, which no word holds."""
        if self.added and self.special.search(text):
            out, at = [], 0
            for m in self.special.finditer(text):
                out += [*self.split_plain(text[at : m.start()]), "\0 " + m[0]]
                at = m.end()
            return out + self.split_plain(text[at:])
        return self.split_plain(text)

    def split_plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # sigma: letter by letter, never final
        return self.words(text.lower())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """(ids of all texts, bounds of each text, places of each text's words in the cache)."""
        if len(self.place) > CACHE_WORDS:
            self.clear()
        place, known = self.place, len(self.place)
        put = place.setdefault
        used = []
        for t in texts:
            row = []
            for w in self.split(t) if t else ():
                row.append(put(w, len(place)))
            used.append(row)
        fresh = list(place)[known:] if len(place) > known else []
        if fresh:
            plain = [w for w in fresh if not w.startswith("\0 ")]
            flat, bounds = self.merge([w.encode() for w in plain]) if plain else (np.zeros(0, np.int32), np.zeros(1, np.int64))
            if len(plain) < len(fresh):
                parts, k = [], 0
                for w in fresh:
                    if w.startswith("\0 "):
                        parts.append(np.array([self.added[w[2:]]], dtype=np.int32))
                    else:
                        parts.append(flat[bounds[k] : bounds[k + 1]])
                        k += 1
                flat, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            self.decoded += [" ".join([self.tokens[i] for i in flat[s:e].tolist()]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            self.bounds = np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        every = np.array([i for row in used for i in row], dtype=np.int64)
        size = (self.bounds[1:] - self.bounds[:-1])[every] if len(every) else np.zeros(0, dtype=np.int64)
        stop = np.cumsum(size)
        ids = self.flat[np.repeat(self.bounds[:-1][every] - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)]
        words = np.concatenate([[0], np.cumsum([len(row) for row in used])]).astype(np.int64)
        return ids, np.concatenate([[0], stop])[words], used

    def decode(self, ids: list[int]) -> str:
        """The tokens' own strings with a blank between two; the file names no decoder."""
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    with open(path, encoding="utf-8") as f:
        return Bpe(json.load(f))


def _encode(batches: Iterator[pa.RecordBatch], path: str, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for batch in pieces(batches, 1):
        ids, bounds, used = model.encode(batch.column(1).to_pylist())
        rows = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        raw = ids.astype("<u4")
        columns = [
            batch.column(0),
            pa.array([e - s for s, e in rows], pa.int64()),
            pa.array([hashlib.sha256(raw[s:e].tobytes()).hexdigest() for s, e in rows]),
            pa.array([hashlib.sha256(" ".join([model.decoded[w] for w in row]).encode()).hexdigest() for row in used]),
        ]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)))
            names.append("ids")
        yield pa.record_batch(columns, names=names)


def encode_documents(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]); the digest of the ids is over unsigned
    32-bit little-endian integers, that of the decoded text over its UTF-8."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    source = docs.select(*text_of(docs))
    return source.mapInArrow(lambda b: _encode(b, path, keep_ids), schema)


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for batch in batches:
        yield pa.record_batch(
            [batch.column(0), pa.array([model.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"]
        )


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, text) from rows (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: _decode(b, path), "doc_id long, text string")
