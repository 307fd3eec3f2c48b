"""Repeated passages by sparse suffix arrays.

A passage repeats when at least `length` consecutive words (maximal runs other than ASCII white space,
A-Z lower-cased) also stand in another document. Of all suffixes only those are retained that begin at
minimiser positions: the smallest hash of `gram` words in any `span` neighbouring ones. These positions
depend on content alone, and each passage of `gram + span - 1` words holds one.

1. A retained suffix whose first `gram` words stand in one document alone is in no repeat. The hashes of
   these words are ordered over all executors, and only suffixes with one from another document go on.
2. These are sorted by their content, `length` words of it, and compared with their neighbours of other
   documents: the longest common prefix is how far a match extends right. Within the suffixes of equal
   first words the words before them, read backwards, are sorted and compared likewise: that is how far it
   extends left. What both give is a stretch of words; if it is shorter than `length`, there is no repeat.
3. A stretch may owe its two ends to two different documents, so all runs of `length` words in the
   stretches are sorted once more, which proves the repeats and names the first document of each.

No pairs are formed at any step, and a passage that very many documents share is spread over the sorted
ranges. Documents with equal texts are one class from the start. The occurrence that stays is the one in
the document of smallest id; all others are to be dropped.

Defined cases: null and empty texts and those under `length` words hold no repeats; repeats inside one
document alone are left; rows with a null doc_id are ignored by the search and kept by the removal;
rows repeating a doc_id count as that document; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prodlake.llm.hashing import U64, gram_hashes, mix, texts_to_words
from prodlake.llm.session import carried, pieces, shared_runs, stash, text_of, u64

LENGTH, GRAM, SPAN = 50, 20, 20
_MANY = 1 << 20


def _minimisers(grams: np.ndarray, span: int) -> np.ndarray:
    """For each run of `span` neighbouring grams the place of its smallest (the first of equals)."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out = np.empty(n, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    for at in range(0, n, _MANY):
        out[at : at + _MANY] = view[at : at + _MANY].argmin(axis=1)
    return out + np.arange(n)


def _document_key(words: np.ndarray) -> tuple[int, int]:
    place = np.arange(len(words), dtype=U64)
    first = mix(words + mix(place)).sum(dtype=U64)
    second = mix(words ^ mix(place + U64(1 << 40))).sum(dtype=U64)
    return int(first.view(np.int64)), int(second.view(np.int64))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 1):
        words, _, _, bounds, _ = texts_to_words(batch.column(1).to_pylist())
        keys = [_document_key(words[a:e]) for a, e in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.record_batch(
            [batch.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())],
            names=["doc_id", "n_words", "k1", "k2"],
        )


def _anchors(batches: Iterator[pa.RecordBatch], length: int, gram: int, span: int) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, place): keys of the retained suffixes, each once a document and equal texts once a batch.

    Which documents hold a key is all that this step asks, so place is 0; _suffixes has the places.
    """
    for batch in pieces(batches, 1):
        first: dict[str, int] = {}
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if t and i < first.get(t, i + 1):
                first[t] = i
        words, _, _, bounds, _ = texts_to_words(list(first))
        grams = gram_hashes(words, gram)
        keys, docs, places = [], [], []
        for doc, a, e in zip(first.values(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if e - a >= length:
                own = grams[a : e - gram + 1]
                keys.append(np.unique(own[np.unique(_minimisers(own, span))]))
                places.append(np.zeros(len(keys[-1]), dtype=np.int32))
                docs.append(np.full(len(keys[-1]), doc, dtype=np.int64))
        if keys:
            yield pa.record_batch(
                [u64(np.concatenate(keys)), pa.array(np.concatenate(docs)), pa.array(np.concatenate(places))], names=["key", "doc_id", "place"]
            )


def _suffixes(batches: Iterator[pa.RecordBatch], length: int, gram: int, span: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, place, right, left) of the retained suffixes whose key is alive.

    `right` is the suffix's first `length` words and `left` the words before it, backwards, as far as a passage
    of `length` can reach; a word is four bytes of its hash, and what lies outside the text is left out.
    """
    for batch in pieces(batches, 2):
        ids, alive = batch.column(0).to_pylist(), batch.column(1)
        words, _, _, bounds, _ = texts_to_words(batch.column(2).to_pylist())
        grams, codes = gram_hashes(words, gram), (words >> U64(32)).astype(">u4")
        docs, places, right, left = [], [], [], []
        for k, (a, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if e - a < length:
                continue
            own = grams[a : e - gram + 1]
            at = np.unique(_minimisers(own, span))
            at = at[np.isin(own[at], np.asarray(alive[k].values, dtype=np.int64).view(U64))]
            raw, turned = codes[a:e].tobytes(), codes[a:e][::-1].tobytes()
            n = e - a
            places += at.tolist()
            docs += [ids[k]] * len(at)
            right += [raw[4 * p : 4 * (p + length)] for p in at.tolist()]
            left += [turned[4 * (n - p) : 4 * (n - p + length - gram)] for p in at.tolist()]
        if docs:
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(places, pa.int32()), pa.array(right, pa.binary()), pa.array(left, pa.binary())], names=["doc_id", "place", "right", "left"])


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(words by row, number of words) of a binary column, short rows filled with zeros."""
    held = np.asarray(pc.binary_length(column), dtype=np.int64) // 4
    out = np.zeros((len(held), width), dtype=np.uint32)
    out[np.arange(width) < held[:, None]] = np.frombuffer(b"".join(column.to_pylist()), dtype=">u4")
    return out, held


def _common(words: np.ndarray, held: np.ndarray, docs: np.ndarray, width: int) -> np.ndarray:
    """For sorted rows the longest common prefix with a row of another document: the nearest of them, before or behind."""
    n = len(docs)
    same = words[1:] == words[:-1]
    common = np.where(same.all(axis=1), width, same.argmin(axis=1))
    common = np.minimum(common, np.minimum(held[1:], held[:-1]))
    best = np.zeros(n, dtype=np.int64)
    other = docs[1:] != docs[:-1]
    for step in (1, -1):
        near = np.zeros(n, dtype=np.int64)
        if step == 1:
            near[1:][other] = common[other]
            chained = np.flatnonzero(~other) + 1  # after a row of its own document: what that one has, cut by what both share
            for i in chained.tolist():
                near[i] = min(near[i - 1], common[i - 1])
        else:
            near[:-1][other] = common[other]
            for i in np.flatnonzero(~other)[::-1].tolist():
                near[i] = min(near[i + 1], common[i])
        best = np.maximum(best, near)
    return best


def _extend(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, lo, hi): first words of the runs of `length` words that a suffix's match to both sides leaves possible.

    Input is sorted by content. The suffixes of equal first words at the ends of a batch may go on in another:
    for these the whole reach is assumed.
    """
    reach = length - gram
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        docs, place = np.asarray(batch.column(0)), np.asarray(batch.column(1), dtype=np.int64)
        right, n_right = _matrix(batch.column(2), length)
        left, n_left = _matrix(batch.column(3), reach)
        onward = _common(right, n_right, docs, length)
        run = np.concatenate([[0], np.cumsum((right[1:, :gram] != right[:-1, :gram]).any(axis=1))])
        order = np.lexsort([docs, *left.T[::-1], run])
        # the run as first word, so that nothing is common across runs
        backwards = _common(np.column_stack([run[order], left[order]]), n_left[order] + 1, docs[order], reach + 1)
        back = np.empty(n, dtype=np.int64)
        back[order] = np.maximum(backwards - 1, 0)
        ends = (run == 0) | (run == run[-1])
        onward[ends], back[ends] = n_right[ends], n_left[ends]
        lo, hi = place - back, place + onward - length
        good = (hi >= lo) & (onward >= gram)
        yield pa.record_batch([pa.array(docs[good]), pa.array(lo[good].astype(np.int32)), pa.array(np.minimum(hi, place)[good].astype(np.int32))], names=["doc_id", "lo", "hi"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, lo, hi, later) without overlaps, from rows sorted by document, later and lo."""
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, lo, hi, later = (np.asarray(c) if k < 3 else c.to_numpy(zero_copy_only=False) for k, c in enumerate(batch.columns))
        fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (later[1:] != later[:-1])])
        group = np.cumsum(fresh) - 1
        # running maximum of hi inside each group: the groups are lifted apart, as maxima never fall
        top = np.maximum.accumulate(hi.astype(np.int64) + (group << 32)) - (group << 32)
        cut = fresh.copy()
        cut[1:] |= lo[1:] > top[:-1] + 1
        at = np.flatnonzero(cut)
        yield pa.record_batch(
            [pa.array(doc[at]), pa.array(lo[at]), pa.array(np.maximum.reduceat(hi, at)), pa.array(later[at])], names=["doc_id", "lo", "hi", "later"]
        )


def _merged(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, lo, hi, later) with neighbouring ranges joined, so that a document's list is short.

    Documents are dealt in parts of 16,384 words, so that a very long one is not one task's work.
    """
    dealt = rows.withColumn("part", F.col("lo").bitwiseAND(~16383)).repartition("doc_id", "part")
    ordered = dealt.sortWithinPartitions("doc_id", "later", "lo").select("doc_id", "lo", "hi", "later")
    return ordered.mapInArrow(_merge, "doc_id long, lo int, hi int, later boolean")


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, place) of every run of `length` words that begins in one of a document's ranges."""
    for batch in pieces(batches, 2):
        ids, ranges = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        words, _, _, bounds, _ = texts_to_words(batch.column(2).to_pylist())
        whole = gram_hashes(words, length)
        keys, docs, places = [], [], []
        for k, (a, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            n = e - a - length + 1
            if n <= 0:
                continue
            inside = np.zeros(n + 1, dtype=np.int32)
            for r in ranges[k]:
                if r["lo"] < n:
                    inside[max(r["lo"], 0)] += 1
                    inside[min(r["hi"], n - 1) + 1] -= 1
            at = np.flatnonzero(np.cumsum(inside[:n]) > 0)
            keys.append(whole[a + at])
            places.append(at.astype(np.int32))
            docs.append(np.full(len(at), ids[k], dtype=np.int64))
        if keys:
            yield pa.record_batch(
                [u64(np.concatenate(keys)), pa.array(np.concatenate(docs)), pa.array(np.concatenate(places))], names=["key", "doc_id", "place"]
            )


def _union(ranges: list[tuple[int, int]], length: int) -> list[dict[str, int]]:
    """Spans of words [from, to) that runs of `length` words beginning in these ranges cover."""
    out: list[dict[str, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1]["to"]:
            out[-1]["to"] = max(out[-1]["to"], hi + length)
        else:
            out.append({"from": lo, "to": hi + length})
    return out


_SPANS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
_SPANS_SQL = "array<struct<from: int, to: int>>"


def _spans(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Input: doc_id, n_words, n_copies, first of its class, found [(lo, hi, later)]."""
    for batch in batches:
        rows = batch.to_pylist()
        out: dict[str, list] = {"doc_id": [], "n_words": [], "repeats": [], "drops": []}
        for r in rows:
            n, found = r["n_words"], r["found"] or []
            everything = [{"from": 0, "to": n}] if n >= length else []
            repeats = everything if r["n_copies"] > 1 else _union([(f["lo"], f["hi"]) for f in found], length)
            drops = everything if r["rep"] < r["doc_id"] else _union([(f["lo"], f["hi"]) for f in found if f["later"]], length)
            for c, v in zip(out, (r["doc_id"], n, repeats, drops), strict=True):
                out[c].append(v)
        yield pa.record_batch(
            [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_words"], pa.int64()), pa.array(out["repeats"], _SPANS), pa.array(out["drops"], _SPANS)],
            names=list(out),
        )


def repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, span: int = SPAN) -> DataFrame:
    """Rows (doc_id, n_words, repeats, drops) of the documents that hold a repeat; spans count words from 0."""
    if gram + span - 1 > length:
        raise ValueError("gram + span - 1 must not exceed length")
    source = docs.select(*text_of(docs)).where("doc_id is not null")
    sketch = stash(source.mapInArrow(_sketches, "doc_id long, n_words long, k1 long, k2 long").distinct())
    classes = stash(
        sketch.where(F.col("n_words") >= length)
        .groupBy("k1", "k2", "n_words")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"))
    )
    row = "key long, doc_id long, place int"
    anchors = source.mapInArrow(lambda b: _anchors(b, length, gram, span), row)
    alive = (
        shared_runs(anchors)
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("alive"))
        .join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
    )
    suffixes = (
        stash(alive)
        .hint("merge")
        .join(source, "doc_id")
        .select("doc_id", "alive", "text")
        .mapInArrow(lambda b: _suffixes(b, length, gram, span), "doc_id long, place int, right binary, left binary")
    )
    ordered = suffixes.repartitionByRange("right", "doc_id").sortWithinPartitions("right", "doc_id")
    stretches = ordered.mapInArrow(lambda b: _extend(b, length, gram), "doc_id long, lo int, hi int").withColumn("later", F.lit(False))
    ranges = _merged(stretches).groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    windows = (
        stash(ranges)
        .hint("merge")
        .join(source, "doc_id")
        .select("doc_id", "ranges", "text")
        .mapInArrow(lambda b: _windows(b, length), row)
    )
    proved = shared_runs(windows).select("doc_id", F.col("place").alias("lo"), F.col("place").alias("hi"), (F.col("first") < F.col("doc_id")).alias("later"))
    found = _merged(proved).groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi", "later")).alias("found"))
    members = sketch.join(classes, ["k1", "k2", "n_words"])
    rows = (
        members.join(stash(found), "doc_id", "left")
        .where("n_copies > 1 or found is not null")
        .select("doc_id", "n_words", "n_copies", "rep", "found")
    )
    return rows.mapInArrow(lambda b: _spans(b, length), f"doc_id long, n_words long, repeats {_SPANS_SQL}, drops {_SPANS_SQL}")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input: text, drops, row; output: the text without the words of the spans in drops, row."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for k, spans in enumerate(batch.column(1).to_pylist()):
            if not spans:
                continue
            _, starts, ends, _, data = texts_to_words([texts[k]])
            kept, at = [], 0
            for s in spans:
                kept.append(data[at : starts[s["from"]]])
                at = ends[s["to"] - 1]
            kept.append(data[at:])
            texts[k] = b"".join(kept).decode("utf-8", "surrogatepass")
        yield pa.record_batch([pa.array(texts, pa.string()), batch.column(2)], names=["text", "row"])


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All documents, their texts without later copies of repeated passages; n_chars follows if it is there."""
    found = repeated_passages(docs, length).where(F.size("drops") > 0).select(F.col("doc_id").alias("found"), "drops")
    rows = carried(docs, F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    joined = rows.join(stash(found).hint("merge"), F.col("key") == F.col("found"), "left").select("text", "drops", "row")
    cut = joined.mapInArrow(_cut, StructType([joined.schema["text"], joined.schema["row"]]))
    new = {"text": F.col("text"), "n_chars": F.length("text")}
    changed = [
        (new[c].cast(docs.schema[c].dataType) if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns
    ]
    return cut.select(*changed)
