"""N-gram Jaccard self-join by universe-partition pigeonhole.

Two documents link when their shingle sets have Jaccard similarity of at least 90/100 (a parameter).
Sets are split by size into bands, so that similar sets lie in one band or in neighbouring bands. For
each band the token universe is cut into m segments; two linked sets differ in at most H tokens, so
some segment differs in no token, or, where a segment indexes its one-deletion neighbourhood or the
subsets of two of its three cells, in at most one. Per band the numbers of segments of each kind are
those of least cost: index entries plus expected comparisons by chance among the band's sets, from the
measured band histogram. Entries of fewer than two tokens, or of none but frequent ones, are spared wherever
that loses no link: a line that many documents hold would else chain them all into one family.

The sorted index gives candidates as stars (document, smallest document of the entry), never as all pairs.
Stars are joined into families; the documents of a family are compared exactly, in pairs of blocks of
bounded size, and the exact links are joined into the components that are returned.

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing;
with fewer than n words the whole sequence is the only shingle; equal texts and repeated rows share
their component (doc_id names a document: rows that repeat it count as that document); rows with a null doc_id are returned with a null component and take part in no link;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.hashing import U64, gram_hashes, mix, texts_to_words
from prodlake.llm.session import carried, components, pieces, shared_runs, stash, text_of, u64, unpacked

#: Documents and tokens of a block; two blocks are compared in one task at a time.
BLOCK, BLOCK_TOKENS = 256, 200_000
#: Partitions of the universe that a set may try, with entries that hold an infrequent token, and then with any.
ROUNDS = 6
#: Frequent tokens: those that so many of about so many sampled sets hold, and how many are told apart at most.
HELD_BY, SAMPLE, FREQUENT = 8, 32_768, 32_768
#: About so many of the sample's tokens are counted together.
SHARE_TOKENS = 1 << 17
_SEED = U64(0x5851F42D4C957F2D)


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Each text's set: ascending, distinct, well-mixed 64-bit shingle hashes."""
    words, _, _, bounds, _ = texts_to_words(texts)
    grams = gram_hashes(words, n)
    out = []
    for a, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if e - a >= n:
            out.append(np.unique(grams[a : e - n + 1]))
        elif e > a:
            out.append(gram_hashes(words[a:e], e - a))
        else:
            out.append(np.zeros(0, dtype=U64))
    return out


def links(inter: np.ndarray | int, total: np.ndarray | int, percent: int):
    """100 * intersection >= percent * union, total being the sum of both sizes."""
    return 100 * inter >= percent * (total - inter)


@lru_cache(maxsize=4)
def bands(percent: int) -> np.ndarray:
    """Smallest size of every band; sizes of linked sets lie in one band or in two neighbours."""
    low, out = 1, []
    while low < 1 << 40:
        out.append(low)
        low = low * 100 // percent + 1
    return np.array(out + [low], dtype=np.int64)


def most_different(size: int, largest: int, percent: int) -> int:
    """Most tokens in which a set differs from a linked one of at most `largest` tokens.

    |a| + |b| - 2 * |a and b| <= (|a| + |b|) * (100 - percent) / (100 + percent)
    """
    partner = max(size, min(largest, size * 100 // percent))
    return (size + partner) * (100 - percent) // (100 + percent)


def _below(mean: float, most: int) -> float:
    """P(a Poisson variable <= most)."""
    term = total = math.exp(-mean)
    for k in range(1, most + 1):
        term *= mean / k
        total += term
    return total


def _failing(size: int, spare: int, x: int, near: int, parts: int) -> float:
    """About P(a set of this size holds more unsafe segments, by weight, than it can spare)."""
    if spare < 0:
        return 1.0
    fill = size / (x + near + parts)
    chances = [(x, 1, _below(fill, 1)), (near, 2, _below(fill, 2)), (parts, 2, min(1.0, 3 * _below(fill * 2 / 3, 1)))]
    mean = sum(n * w * p for n, w, p in chances)
    spread = math.sqrt(sum(n * w * w * p * (1 - p) for n, w, p in chances) + 1e-9)
    return 0.5 * math.erfc((spare + 0.5 - mean) / spread / math.sqrt(2))


def plan_bands(histogram: dict[int, int], percent: int) -> dict[int, tuple[int, int, int]]:
    """Band -> (segments, those with a one-deletion neighbourhood, those with subsets) of least cost.

    The cost is the number of a set's entries in all its rounds, and that of comparing it with unrelated
    sets if small segments have to be entered after all.
    """
    edge, out = bands(percent), {}
    for e in sorted({b + k for b in histogram for k in (0, 1)}):
        high = int(edge[e + 1]) - 1
        need = most_different(high, high, percent) + 1
        members = histogram.get(e, 0) + histogram.get(e - 1, 0)
        sizes = (int(edge[max(e - 1, 0)]), int(edge[e]), high)
        best = None
        for extra in sorted({need * k // 24 + j for k in range(13) for j in (0, 1, 2)}):
            weight = need + extra
            steps = sorted({weight // 2 * k // 2 for k in range(3)})
            for near, parts in [(n, p) for n in steps for p in steps if n + p <= weight // 2]:
                x = weight - 2 * near - 2 * parts
                m = x + near + parts
                entries = x + near * (1 + high / m) + 3 * parts
                fails = [_failing(s, weight - 1 - most_different(s, high, percent), x, near, parts) for s in sizes]
                unrelated = max(fails) ** ROUNDS * high / 2 * (1 + members / BLOCK)
                cost = entries * sum(1 / max(1 - f, 0.02) for f in fails) / 3 + unrelated
                if best is None or cost < best[0]:
                    best = (cost, m, near, parts)
        out[e] = best[1:]
    return out


@lru_cache(maxsize=4096)
def _cuts(m: int) -> np.ndarray:
    """Bounds of 3 * m equal cells of the 64-bit range; three cells make a segment."""
    return np.array([-((-k << 64) // (3 * m)) for k in range(1, 3 * m)], dtype=U64)


@lru_cache(maxsize=4096)
def _salts(e: int, m: int, turn: int) -> np.ndarray:
    return mix(np.arange(m, dtype=U64) + (U64(e + 1) << U64(32)) + (U64(turn) << U64(56)))


def _among(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which tokens stand in `known`, which ascends."""
    if not len(known):
        return np.zeros(len(tokens), dtype=bool)
    return known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens


def signatures(tokens: np.ndarray, percent: int, plan: dict[int, tuple[int, int, int]], frequent: np.ndarray = U64([])) -> np.ndarray:
    """Index entries of one set in the schemes of its band and of the next.

    Entries over fewer than two tokens, or over `frequent` ones alone, agree by chance; an entry is good
    otherwise. A segment is safe if whatever entry it shares with a set that agrees with it there is good.
    Linked sets agree on segments of more than `weight - 1 - d` weight, d being the most tokens in which
    they differ; so a set whose unsafe segments weigh no more than that meets every linked set by a good
    entry. A set that has more takes another round with another partition of the universe. After half of
    the rounds, entries over frequent tokens are good as well; two linked sets that fail in all rounds meet
    in the last, where such sets enter everything. What is good depends on the entry's tokens and the round
    alone, so that it is good for both sets, and any choice of frequent tokens gives the same links.
    """
    band = int(np.searchsorted(bands(percent), len(tokens), side="right")) - 1
    rare = ~_among(tokens, frequent)
    rounds = 2 * ROUNDS if len(frequent) else ROUNDS
    out = []
    for e in (band, band + 1):
        m, near, parts = plan[e]
        some = slice(near, near + parts)
        spare = m + near + parts - 1 - most_different(len(tokens), int(bands(percent)[e + 1]) - 1, percent)
        for turn in range(rounds):
            own = mix(tokens + _seeds(rounds)[turn]) if turn else tokens
            order = np.argsort(own) if turn else slice(None)
            own = own[order]
            weight = mix(own + _SEED)
            sums = np.zeros(len(own) + 1, dtype=U64)
            np.cumsum(weight, out=sums[1:])
            at = np.concatenate([[0], np.searchsorted(own, _cuts(m)), [len(own)]])
            cell, held = (sums[at[1:]] - sums[at[:-1]]).reshape(m, 3), np.diff(at).reshape(m, 3)
            whole, n = cell.sum(axis=1, dtype=U64) + _salts(e, m, turn), held.sum(axis=1)
            if turn < ROUNDS and not rare.all():  # of the tokens, those that an entry needs one of
                needed = rare[order]
                upto = np.concatenate([[0], np.cumsum(needed)])
                held_needed = (upto[at[1:]] - upto[at[:-1]]).reshape(m, 3)
                k = held_needed.sum(axis=1)
            else:
                needed, held_needed, k = np.ones(len(own), dtype=bool), held, n
            unsafe = (
                2 * int(((n[:near] < 3) | (k[:near] < 2)).sum())
                + 2 * int(((n[some] - held[some].max(axis=1, initial=0) < 2) | (k[some] - held_needed[some].max(axis=1, initial=0) < 1)).sum())
                + int(((n[near + parts :] < 2) | (k[near + parts :] < 1)).sum())
            )
            everything = turn == rounds - 1 and unsafe > spare
            good = lambda tokens, needed: (tokens >= 2) & (needed >= 1) | everything
            plain = np.concatenate([whole[:near], whole[near + parts :]])
            out.append(plain[np.concatenate([good(n, k)[:near], good(n, k)[near + parts :]])])
            if near:  # the first segments carry the neighbourhood: the segment without one of its tokens
                upto = at[3 * near]
                segment = np.repeat(np.arange(near), n[:near])
                out.append((whole[segment] - weight[:upto])[good(n[segment] - 1, k[segment] - needed[:upto])])
            if parts:  # the next ones the subsets: the segment without one of its three cells
                entry = (whole[some, None] - cell[some] + _seeds(3)).ravel()
                out.append(entry[good(n[some, None] - held[some], k[some, None] - held_needed[some]).ravel()])
            if unsafe <= spare:
                break
    return np.unique(mix(np.concatenate(out)))


@lru_cache(maxsize=4)
def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(n, dtype=U64) + U64(7))


def _sketches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 1):
        sets = shingle_sets(batch.column(1).to_pylist(), n)
        one = np.array([mix(s + _SEED).sum(dtype=U64) for s in sets], dtype=U64)
        two = np.array([np.bitwise_xor.reduce(mix(s ^ _SEED)) if len(s) else 0 for s in sets], dtype=U64)
        size = pa.array([len(s) for s in sets], pa.int64())
        yield pa.record_batch([batch.column(0), size, u64(one), u64(two)], names=["doc_id", "n_shingles", "k1", "k2"])


def _entries(batches: Iterator[pa.RecordBatch], n: int, percent: int, plan: dict, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 1):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        first: dict[str, int] = {}  # copies of a text in a batch give the same entries: only the smallest id's
        for i, t in zip(ids, texts, strict=True):
            if t and i is not None and i < first.get(t, i + 1):
                first[t] = i
        keys, docs = [], []
        for doc, tokens in zip(first.values(), shingle_sets(list(first), n), strict=True):
            if len(tokens):
                keys.append(signatures(tokens, percent, plan, frequent))
                docs.append(np.full(len(keys[-1]), doc, dtype=np.int64))
        if keys:
            ids = np.concatenate(docs)
            yield pa.record_batch([u64(np.concatenate(keys)), pa.array(ids), pa.array(np.zeros(len(ids), dtype=np.int32))], names=["key", "doc_id", "place"])


def _shares(batches: Iterator[pa.RecordBatch], n: int, shares: int) -> Iterator[pa.RecordBatch]:
    """(share, tokens, held): a piece's distinct tokens, a row for each share of their range, and by how many of its sets each is held."""
    cuts = np.array([(k << 64) // shares for k in range(1, shares)], dtype=U64)
    for batch in pieces(batches, 0):
        sets = shingle_sets(batch.column(0).to_pylist(), n)
        tokens, held = np.unique(np.concatenate(sets), return_counts=True)
        at = np.concatenate([[0], np.searchsorted(tokens, cuts), [len(tokens)]])
        some = np.flatnonzero(np.diff(at))
        packed = [pa.array([x[at[k] : at[k + 1]].tobytes() for k in some], pa.binary()) for x in (tokens, held.astype(np.int32))]
        yield pa.record_batch([pa.array(some, pa.int32()), *packed], names=["share", "tokens", "held"])


def _often(table: pa.Table) -> pa.Table:
    """Tokens of one share that enough sets hold."""
    tokens, held = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t) for c, t in (("tokens", U64), ("held", np.int32)))
    order = np.argsort(tokens)
    start = np.flatnonzero(np.diff(tokens[order], prepend=~tokens[order[:1]]))
    sums = np.add.reduceat(held[order], start, dtype=np.int64)
    often = sums >= HELD_BY
    return pa.table({"token": u64(tokens[order[start[often]]]), "held": pa.array(sums[often], pa.int64())})


def frequent_tokens(source: DataFrame, classes: DataFrame, n: int) -> np.ndarray:
    """Ascending tokens that many of a sample of different sets hold: the sample is bounded, and so is what the driver gets.

    They decide which entries are worth making, not which sets meet (signatures()). Nearly all tokens are held by one set,
    so they are counted in packed shares of their range: a row a token would fill tables of hundreds of MB in a task.
    """
    sets, tokens = classes.agg(F.count("*"), F.sum("n_shingles")).first()
    every = max(1, sets // SAMPLE)
    shares = 1 + (tokens or 0) // every // SHARE_TOKENS
    some = classes.where(F.pmod(F.xxhash64("rep"), F.lit(every)) == 0).select(F.col("rep").alias("doc_id"))
    packed = source.join(F.broadcast(some), "doc_id").select("text").mapInArrow(lambda b: _shares(b, n, shares), "share int, tokens binary, held binary")
    found = packed.groupBy("share").applyInArrow(_often, "token long, held long")
    rows = found.orderBy(F.desc("held"), "token").limit(FREQUENT).collect()
    return np.unique(np.array([r["token"] for r in rows], dtype=np.int64).view(U64))


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(x, y, side, doc_id, tokens): the last column of the input is the text."""
    for batch in pieces(batches, 4):
        sets = shingle_sets(batch.column(4).to_pylist(), n)
        tokens = pa.array([s.tobytes() for s in sets], pa.binary())
        yield pa.record_batch([*[batch.column(k) for k in range(4)], tokens], names=["family", "x", "y", "doc_id", "tokens"])


def link_block(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the exact links among some sets.

    Tokens are ranked by how many of these sets hold them. A set whose tokens shared with any other are
    too few cannot link; the others meet over their rarest tokens (prefix filter) and are compared exactly,
    unless the links found so far join them already.
    """
    all_tokens = np.concatenate(sets)
    _, inverse, count = np.unique(all_tokens, return_inverse=True, return_counts=True)
    rank = np.empty(len(count), dtype=np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    ranked = rank[inverse]
    single = int((count == 1).sum())  # ranks below this occur in one set only
    at, local = 0, []
    for s in sets:
        local.append(np.sort(ranked[at : at + len(s)]))
        at += len(s)
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    seen: dict[int, list[int]] = {}
    marks = np.zeros(len(count), dtype=bool)
    found = []
    for x in sorted(range(len(sets)), key=lambda k: (len(sets[k]), ids[k])):
        size = len(local[x])
        alone = int(np.searchsorted(local[x], single))
        need = -(-percent * size // 100)  # an intersection is at least this large
        prefix = size - need + 1
        if size == 0 or alone >= prefix:
            continue
        mine = local[x][alone:prefix].tolist()
        near = {y for t in mine for y in seen.get(t, ()) if 100 * len(local[y]) >= percent * size}
        if near:
            marks[local[x]] = True
            for y in sorted(near):
                if root(x) != root(y) and links(int(marks[local[y]].sum()), size + len(local[y]), percent):
                    parent[max(root(x), root(y))] = min(root(x), root(y))
                    found.append((ids[x], ids[y]))
            marks[local[x]] = False
        for t in mine:
            seen.setdefault(t, []).append(x)
    return found


def _verify(table: pa.Table, percent: int) -> pa.Table:
    ids = table.column("doc_id").to_pylist()
    sets = [np.frombuffer(t, dtype=U64) for t in table.column("tokens").to_pylist()]
    found = link_block(ids, sets, percent)
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def candidate_families(source: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Rows (node, root): representatives that share an index entry, directly or by others, have one root."""
    # a row for each band, of which there are fewer than 270 whatever the sizes
    edge = bands(percent)
    band = F.lit(0)
    top = classes.agg(F.max("n_shingles")).first()[0] or 0
    for e, low in enumerate(edge.tolist()):
        if 0 < e and low <= top:
            band = band + (F.col("n_shingles") >= low).cast("int")
    histogram = {int(r["band"]): int(r["n"]) for r in classes.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}
    plan, frequent = plan_bands(histogram, percent), frequent_tokens(source, classes, n)
    entries = source.where("doc_id is not null").mapInArrow(lambda b: _entries(b, n, percent, plan, frequent), "key long, doc_id long, place int")
    stars = shared_runs(entries).where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    kept = classes.select(F.col("rep").alias("a"))
    return stash(components(stash(stars.distinct().join(kept, "a"))))


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of docs(doc_id, text, ...)."""
    source = docs.select(*text_of(docs))
    sketch = stash(
        source.mapInArrow(lambda b: _sketches(b, n), "doc_id long, n_shingles long, k1 long, k2 long")
    )
    classes = stash(
        sketch.where("doc_id is not null and n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    )
    families = candidate_families(source, classes, n, percent)
    tokens = classes.groupBy(F.col("rep").alias("node")).agg(F.max("n_shingles").alias("n_shingles"))
    sizes = families.join(tokens, "node").groupBy("root").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("tokens")).where("members > 1")
    placed = (
        families.join(sizes, "root")
        .withColumn("blocks", F.ceil(F.greatest(F.col("members") / BLOCK, F.least(F.col("members"), F.col("tokens") / BLOCK_TOKENS))).cast("int"))
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.col("node").alias("doc_id"),
            F.col("root").alias("family"),
            F.least("mine", "other").alias("x"),
            F.greatest("mine", "other").alias("y"),
        )
    )
    # by a merge at every size: a small side that is broadcast only while it is small would hide what growth costs
    sets = placed.hint("merge").join(source.where("doc_id is not null"), "doc_id").select("family", "x", "y", "doc_id", "text")
    found = (
        sets.mapInArrow(lambda b: _sets(b, n), "family long, x int, y int, doc_id long, tokens binary")
        .groupBy("family", "x", "y")
        .applyInArrow(lambda t: _verify(t, percent), "a long, b long")
    )
    joined = components(stash(found))
    groups = classes.join(joined, F.col("rep") == F.col("node"), "left").select(
        "k1", "k2", "n_shingles", F.coalesce("root", "rep").alias("component")
    )
    out = sketch.join(stash(groups), ["k1", "k2", "n_shingles"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest of their component, with all their columns."""
    found = jaccard_components(docs, n, percent)
    kept = found.where("doc_id is null or component_id = doc_id").select(F.col("doc_id").alias("kept")).distinct()
    rows = carried(docs, F.col("doc_id").cast("long").alias("key"))
    return unpacked(rows.join(stash(kept).hint("merge"), F.col("key").eqNullSafe(F.col("kept"))), docs)
