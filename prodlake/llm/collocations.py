"""Phrase collocation mining by best-first branch-and-bound growth.

A phrase's score is the least, over its cuts into a first part and a rest, of floor(1000 * a * n / (l * r)). As a is at
most l and at most r, no phrase that begins with a prefix counted f times, or ends in a suffix counted f times, scores
more than 1000 * n / f: the count of a prefix is an admissible bound for all that grows from it, and the rarest prefixes
are the most promising. The frontier is opened in that order, a band of counts at a time: in a wave, every language has
a cap, and phrases grow from first words counted at most cap times to the right, and from last words counted at most
cap times to the left, a word a level, as long as they occur often enough. Whatever a wave leaves closed scores at most
1000 * n / (cap + 1). A language is settled when that many survivors as are asked for lie above this bound (so that no
tie is open either); the others go on with a wider band, and the last band has no cap.

A level is one pass over the texts: a task looks up prefix, suffix and end words of every place in sieves (bit sets of
bounded size), counts what passes, and sends each phrase once a batch; exact counts are made after the shuffle, keyed
by the phrase itself. A sieve lets some phrases through that need no counting; it never holds one back, and those let
through by chance are told by the exact counts of their ends.

A longer phrase that holds a phrase and is as frequent implies one that is longer by one word only and as frequent, so
survival looks at extensions by one word, all of which the same wave counts.

Defined cases: null and empty texts have no words; a null lang is `und`; repeated rows count each; ties go by a, then
phrase in UTF-8 byte order; an empty table gives no rows; other columns are ignored, whatever their names. Words are
compared by bytes. A text is never cut; phrases of the text do not cross its ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm.hashing import BASE, LOWER, U64, mix, range_hashes
from prodlake.llm.session import lean_batches, pieces, stash

LEAST, TOP, LONGEST, SHARE = 100, 2000, 5, 100
#: Shares of the occurrences of frequent words that the first words of a wave may have; the last wave takes all.
WAVES = (1 / 8, 1 / 2, 1.0)
#: Languages with fewer occurrences of frequent words take all in their first wave.
SMALL = 1 << 20
#: Bits of a sieve: 16 a key, between these bounds, whatever the number of keys.
FEWEST_BITS, MOST_BITS = 1 << 16, 1 << 27
#: Rows that a task counts together before it sends them; words of a text taken at a time.
HELD, STRETCH = 1 << 19, 1 << 19

_LOWER = LOWER.copy()
_LOWER[9] = 0x20
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_INSIDE = ~_BREAK
_INSIDE[0x20] = False
_POWERS = np.array([pow(int(BASE), k + 1, 1 << 64) for k in range(64)], dtype=U64)
_ROWS = "h long, lang string, phrase binary, head boolean, tail boolean, n long"


@dataclass
class Sieve:
    """A bit set over hashes: `has` is true for all keys put in, and for few others."""

    words: np.ndarray

    def has(self, h: np.ndarray) -> np.ndarray:
        last = U64(len(self.words) * 64 - 1)
        found = np.ones(len(h), dtype=bool)
        for place in (h & last, (h >> U64(32)) & last):
            found &= (self.words[(place >> U64(6)).astype(np.int64)] >> (place & U64(63))) & U64(1) == 1
        return found


def sieve(keys: DataFrame) -> Sieve:
    """Of column h: bits are set by an aggregate, and at most MOST_BITS of them come to the driver."""
    bits = FEWEST_BITS
    wanted = 16 * keys.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    place = F.explode(F.array(F.col("h"), F.shiftrightunsigned("h", 32))).alias("p")
    low = keys.select(place).select(F.col("p").bitwiseAND(bits - 1).alias("p"))
    one = F.expr("shiftleft(1L, cast(p & 63 as int))")
    rows = low.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(bits // 64, dtype=U64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(U64)
    return Sieve(words)


@dataclass
class Words:
    """The words of a batch: where they stand, their piece, the language of their text, their hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    salt: np.ndarray
    hashes: np.ndarray
    langs: list[str]

    def grams(self, k: int, at: int, to: int) -> np.ndarray:
        """Hashes of the k words from each place in [at, to); to + k - 1 must not pass the end."""
        total = self.salt[at:to].copy()
        for j in range(k):
            total += self.hashes[at + j : to + j] * _POWERS[j]
        return mix(total)

    def phrase(self, i: int, k: int) -> bytes:
        return b" ".join(self.data[self.starts[i] : self.ends[i + k - 1]].tobytes().split())


def words_in(batch: pa.RecordBatch) -> Words:
    """Words of a batch (lang, text as bytes)."""
    langs = ["und" if x is None else x for x in batch.column(0).to_pylist()]
    parts = [x or b"" for x in batch.column(1).to_pylist()]
    data = _LOWER[np.frombuffer(b"\n".join(parts), dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(_INSIDE[data].astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    bounds = np.cumsum([0] + [len(p) + 1 for p in parts])
    doc = np.searchsorted(bounds, starts, side="right") - 1
    piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts] if len(starts) else np.zeros(0, dtype=np.int32)
    known = list(dict.fromkeys(langs))
    number = {x: k for k, x in enumerate(known)}
    lang = np.array([number[x] for x in langs], dtype=np.int32)[doc]
    names = [x.encode("utf-8", "surrogatepass") + b"\0" for x in known]
    ahead = np.cumsum([0] + [len(x) for x in names])
    salts = range_hashes(np.frombuffer(b"".join(names), dtype=np.uint8), ahead[:-1], ahead[1:])
    return Words(data, starts, ends, piece, lang, salts[lang], range_hashes(data, starts, ends), known)


@dataclass
class Level:
    """What a pass over the texts counts: phrases of k words, and the sieves that choose them."""

    k: int
    frequent: Sieve | None = None
    heads: Sieve | None = None
    tails: Sieve | None = None


def _chosen(t: Words, level: Level, at: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places in [at, to) to count, their hashes, and whether their first and last words are open in this wave."""
    k = level.k
    if k == 1:
        found = np.arange(at, to)
        return found, t.grams(1, at, to), np.zeros(to - at, dtype=bool), np.zeros(to - at, dtype=bool)
    to = min(to, len(t.starts) - k + 1)
    if to <= at:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(U64), none.astype(bool), none.astype(bool)
    one = t.piece[at:to] == t.piece[at + k - 1 : to + k - 1]
    place = np.flatnonzero(one)
    single = level.frequent.has(t.grams(1, at, to + k - 1))
    place = place[single[place] & single[place + k - 1]]
    part = t.grams(k - 1, at, to + 1)
    head, tail = level.heads.has(part[place]), level.tails.has(part[place + 1])
    either = head | tail
    place = place[either]
    return place + at, t.grams(k, at, to)[place], head[either], tail[either]


def _merged(rows: list[tuple]) -> pa.RecordBatch:
    """One row for each hash of the rows gathered so far."""
    h = np.concatenate([r[0] for r in rows])
    uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
    n = np.bincount(back, weights=np.concatenate([r[5] for r in rows]), minlength=len(uniq)).astype(np.int64)
    take = pa.array(first)
    arrays = [pa.concat_arrays([r[c] for r in rows]).take(take) for c in (1, 2, 3, 4)]
    return pa.record_batch([pa.array(uniq.view(np.int64)), *arrays, pa.array(n)], names=["h", "lang", "phrase", "head", "tail", "n"])


def _counted(batches: Iterator[pa.RecordBatch], level: Level) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in pieces(batches, 1, 4 << 20):
        t = words_in(batch)
        for at in range(0, len(t.starts), STRETCH):
            place, h, head, tail = _chosen(t, level, at, min(at + STRETCH, len(t.starts)))
            if not len(place):
                continue
            uniq, first, n = np.unique(h, return_index=True, return_counts=True)
            spot = place[first]
            phrases = pa.array([t.phrase(i, level.k) for i in spot.tolist()], pa.binary())
            lang = pa.array([t.langs[i] for i in t.lang[spot].tolist()], pa.string())
            held.append((uniq, lang, phrases, pa.array(head[first]), pa.array(tail[first]), n))
            size += len(uniq)
            if size >= HELD:
                yield _merged(held)
                held, size = [], 0
    if held:
        yield _merged(held)


def _exact(texts: DataFrame, level: Level) -> DataFrame:
    """(h, lang, phrase, head, tail, f): the level's phrases with their counts over all texts."""
    rows = texts.mapInArrow(lambda b: _counted(b, level), _ROWS)
    return rows.groupBy("h", "lang", "phrase", "head", "tail").agg(F.sum("n").alias("f"))


def _caps(frequent: DataFrame, totals: DataFrame, share: float) -> DataFrame:
    """(lang, cap, closed): the count up to which words are open, and the best score of what stays closed (-1: none).

    Counts are taken in classes of quarter octaves, from the rarest, until their occurrences pass the share.
    """
    octave = F.floor(4 * F.log2("f"))
    classes = frequent.groupBy("lang", octave.alias("c")).agg(F.sum("f").alias("mass"), F.max("f").alias("cap"))
    upto = Window.partitionBy("lang").orderBy("c")
    whole = Window.partitionBy("lang")
    ranked = classes.select("lang", "cap", F.sum("mass").over(upto).alias("upto"), F.sum("mass").over(whole).alias("all"), F.min("cap").over(whole).alias("least"), F.max("cap").over(whole).alias("most"))
    everything = (F.lit(share) >= 1) | (F.col("all") < SMALL)
    open_cap = F.coalesce(F.max(F.when(F.col("upto") <= share * F.col("all"), F.col("cap"))), F.max("least"))
    cap = F.when(F.max(everything), F.max("most")).otherwise(open_cap)
    caps = ranked.groupBy("lang").agg(cap.alias("cap"), F.max("most").alias("most"))
    bound = F.expr("cast(1000 as decimal(4,0)) * cast(n as decimal(19,0)) div (cap + 1)").cast("long")
    return caps.join(totals, "lang").select("lang", "cap", "n", F.when(F.col("cap") < F.col("most"), bound).otherwise(F.lit(-1).cast("long")).alias("closed"))


def _words(phrase: str = "phrase") -> Column:
    return F.split(F.col(phrase), " ")


def _scored(known: DataFrame, caps: DataFrame, least: int) -> DataFrame:
    """Phrases whose both ends are open, with their lowest cut: (lang, phrase, k, a, l, r, n, score, closed)."""
    parts = known.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    w = F.col("w")
    cuts = known.where("k > 1").withColumn("w", _words()).select("lang", "phrase", "k", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("j"))
    cuts = cuts.select("lang", "phrase", "k", "a", "j", F.array_join(F.slice(w, F.lit(1), F.col("j")), " ").alias("left"), F.array_join(F.slice(w, F.col("j") + 1, F.col("k") - F.col("j")), " ").alias("right"))
    with_l = cuts.join(parts.withColumnsRenamed({"part": "left", "count": "l"}), ["lang", "left"])
    with_r = with_l.join(parts.withColumnsRenamed({"part": "right", "count": "r"}), ["lang", "right"])
    exact = F.expr("(cast(1000 * cast(a as decimal(15,0)) as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").cast("long")
    judged = with_r.join(caps, "lang").withColumn("score", exact)
    lowest = F.min(F.struct("score", "j", "l", "r")).alias("cut")
    ends = (F.max(F.when(F.col("j") == 1, F.col("l"))) <= F.max("cap")) & (F.max(F.when(F.col("j") == F.col("k") - 1, F.col("r"))) <= F.max("cap"))
    grouped = judged.groupBy("lang", "phrase", "k", "a").agg(lowest, ends.alias("open"), F.count("*").alias("cuts"), F.max("n").alias("n"), F.max("closed").alias("closed"))
    return grouped.where((F.col("cuts") == F.col("k") - 1) & F.col("open") & (F.col("a") >= least)).select("lang", "phrase", "k", "a", "cut.l", "cut.r", "n", "cut.score", "closed")


def _survivors(scored: DataFrame, known: DataFrame, share: int) -> DataFrame:
    """Less the phrases that a phrase longer by one word holds and that it is nearly always part of."""
    w, k = F.col("w"), F.col("k")
    held = (
        known.where("k > 2")
        .withColumn("w", _words())
        .select("lang", "f", F.explode(F.array(F.array_join(F.slice(w, F.lit(1), k - 1), " "), F.array_join(F.slice(w, F.lit(2), k - 1), " "))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    return scored.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")


def _first(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language, with their rank: by shares of the phrases first, so that no task ranks them all."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    shares = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(shares)).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def _wave(texts: DataFrame, frequent: DataFrame, caps: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, phrase, k, f) of all words and phrases that a wave counts often enough."""
    usual = frequent.join(caps.select("lang", "cap"), "lang")
    opened = usual.where(F.col("f") <= F.col("cap"))
    every, heads = sieve(usual), sieve(opened)
    tails = heads
    known = usual.select("lang", "phrase", F.lit(1).alias("k"), "f")
    for k in range(2, longest + 1):
        level = Level(k, every, heads, tails)
        grown = stash(_exact(texts, level).where(F.col("f") >= least).withColumn("phrase", F.col("phrase").cast("string")))
        known = known.union(grown.select("lang", "phrase", F.lit(k).alias("k"), "f"))
        if k < longest:
            if grown.isEmpty():
                break
            heads, tails = sieve(grown.where("head")), sieve(grown.where("tail"))
    return known


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, share: int = SHARE, waves: tuple[float, ...] = WAVES, small: int | None = None) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score) of each language's best phrases of 2 to `longest` words."""
    spark = docs.sparkSession
    lean_batches(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    singles = _exact(texts, Level(1))
    # frequent words stay apart, the others become one row a language, for its total
    often = F.col("f") >= least
    words = stash(singles.groupBy("lang", F.when(often, F.col("h")).alias("h"), F.when(often, F.col("phrase").cast("string")).alias("phrase")).agg(F.sum("f").alias("f")))
    totals = stash(words.groupBy("lang").agg(F.sum("f").alias("n")))
    frequent = words.where(F.col("phrase").isNotNull())
    waiting, done = totals, None
    for k, band in enumerate(waves):
        caps = stash(_caps(frequent.join(waiting.select("lang"), "lang", "left_semi"), totals, 1.0 if k == len(waves) - 1 else band))
        known = _wave(texts, frequent, caps, least, longest)
        alive = stash(_survivors(_scored(known, caps, least), known, share))
        above = alive.where(F.col("score") > F.col("closed")).groupBy("lang").agg(F.count("*").alias("above"))
        settled = caps.join(above, "lang", "left").where((F.col("closed") < 0) | (F.col("above") >= top)).select("lang")
        part = _first(alive.join(settled, "lang", "left_semi"), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        done = part if done is None else done.union(part)
        waiting = stash(caps.join(settled, "lang", "left_anti").select("lang"))
        if waiting.isEmpty():
            break
    return done
