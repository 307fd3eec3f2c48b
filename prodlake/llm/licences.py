"""Licence scan with a positional rare-token index. DataFrame functions only.

Templates are notices with a label and a mandatory key phrase; the base phrases are templates that are all
key phrase. Their postings (word -> places in templates) form the index, a map that all tasks hold; its
size is that of the templates, not of the corpus. Over the corpus the document frequency of every licence
word is counted. A file looks up its own licence words of highest IDF: as many as it takes for every
template whose key words all stand in the file to have one of them looked up. A place of such a word in
the file, less its places in the templates, proposes alignments; at each the template's postings are
intersected with the file's words by relative position, weighted by IDF, and the key phrase is verified.
As a key phrase holds a word that was looked up, no place of one is missed.

Words: after lower-casing A-Z, maximal runs of characters outside [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F].

Defined cases: a null text is an empty one; an empty text has no words, empty labels, null places and
score 0; overlapping places all count; repeated rows and rows with a null doc_id are scanned like any;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodlake.llm.licence_texts import TEMPLATES

# Base phrases with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Least share of a notice's IDF that must stand at its places.
ENOUGH = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool

    @property
    def offset(self) -> int:
        """Place of the key phrase in the notice."""
        n = len(self.key)
        return next(k for k in range(len(self.words) - n + 1) if self.words[k : k + n] == self.key)


def templates(notices: list[tuple[str, str, str]] = TEMPLATES) -> list[Template]:
    split = lambda text: tuple(re.sub(SEPARATORS, " ", text.lower()).split())
    base = [Template(label, split(phrase), split(phrase), True) for phrase, label in BASE.items()]
    return base + [Template(label, split(notice), split(key), False) for label, notice, key in notices]


def vocabulary(known: list[Template]) -> list[str]:
    return sorted({w for t in known for w in t.words})


#: More words than a template has: starts this far before a file are numbers from 0.
BEFORE = 1 << 20


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, SEPARATORS), "")


def licence_idf(docs: DataFrame, known: list[Template]) -> dict[str, float]:
    """IDF of the licence words over all documents; as many rows reach the driver as there are licence words."""
    terms = vocabulary(known)
    total = docs.count()
    held = F.array_intersect(F.from_json(F.lit(json.dumps(terms)), "array<string>"), words(F.col("text")))
    seen = {r["word"]: r["n"] for r in docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    # a word in nearly all documents still counts a little
    return {w: max(0.01, math.log((total + 1) / (seen.get(w, 0) + 0.5))) for w in terms}


def _word(file: Column, place: Column) -> Column:
    """The word at a place, null outside the file."""
    return F.when(place >= 0, F.get(file, place))


class Index:
    """The templates as constant columns: postings by word, IDF by word, and what is known of each template."""

    def __init__(self, known: list[Template], idf: dict[str, float]):
        postings: dict[str, list[dict[str, int]]] = {}
        for k, t in enumerate(known):
            for p, w in enumerate(t.words):
                postings.setdefault(w, []).append({"t": k, "p": p})
        rows = [
            {
                "label": t.label, "words": t.words, "weights": [idf[w] for w in t.words], "whole": sum(idf[w] for w in t.words),
                "key": t.key, "offset": t.offset, "peak": max(idf[w] for w in t.key), "base": t.base,
            }
            for t in known
        ]
        constant = lambda value, schema: F.from_json(F.lit(json.dumps(value)), schema)
        self.postings = constant(postings, "map<string,array<struct<t:int,p:int>>>")
        self.idf = constant(idf, "map<string,double>")
        self.known = constant(
            rows,
            "array<struct<label:string,words:array<string>,weights:array<double>,whole:double,key:array<string>,offset:int,peak:double,base:boolean>>",
        )
        self.ids = F.array(*[F.lit(k) for k in range(len(known))])
        self.vocabulary = constant(vocabulary(known), "array<string>")
        #: A file without one of these holds no key phrase.
        self.rarest = F.array(*[F.lit(w) for w in sorted({max(t.key, key=lambda w: (idf[w], w)) for t in known})])

    def of(self, t: Column, field: str) -> Column:
        return F.get(self.known, t).getField(field)


def scan(docs: DataFrame, idf: dict[str, float] | None = None, notices: list[tuple[str, str, str]] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    known = templates(notices)
    index = Index(known, licence_idf(docs, known) if idf is None else idf)
    file, present, open_ones, hits = (F.col(c) for c in ("_words", "_present", "_open", "_hits"))
    # the file's licence words, and the templates all of whose key words are among them
    looked = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("_words"))
        .withColumn("_present", F.when(F.arrays_overlap(file, index.rarest), F.array_intersect(index.vocabulary, file)))
        .withColumn("_open", F.when(present.isNotNull(), F.filter(index.ids, lambda t: F.size(F.array_except(index.of(t, "key"), present)) == 0)))
    )
    # places of its words of highest IDF, down to where each of these templates has one
    depth = F.array_min(F.transform(open_ones, lambda t: index.of(t, "peak")))
    highest = F.filter(present, lambda w: F.element_at(index.idf, w) >= depth)
    placed = looked.withColumn("_highest", F.when(F.size(open_ones) > 0, highest)).withColumn(
        "_hits",
        F.when(
            F.col("_highest").isNotNull(),
            F.filter(F.transform(file, lambda w, i: F.when(F.array_contains("_highest", w), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull()),
        ),
    )

    def aligned(h: Column) -> Column:
        """Alignments that a word at a place proposes and at which the key phrase stands, as one number each.

        Several words of a template propose the same one. Numbers become distinct in a hash set, structs by comparing all.
        """
        mine = F.filter(F.element_at(index.postings, h["w"]), lambda p: F.array_contains(open_ones, p["t"]))
        starts = F.transform(mine, lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("s")))
        key_at = lambda a: a["s"] + index.of(a["t"], "offset")
        there = F.filter(
            starts,
            lambda a: F.when(key_at(a) >= 0, F.slice(file, F.greatest(key_at(a), F.lit(0)) + 1, F.size(index.of(a["t"], "key"))) == index.of(a["t"], "key")).otherwise(False),
        )
        return F.transform(there, lambda a: F.shiftleft(a["t"].cast("long"), 40) + (a["s"] + BEFORE).cast("long"))

    def share(a: Column) -> Column:
        """IDF of the template's words that stand in the file at their relative positions, as a part of the whole."""
        held = F.transform(index.of(a["t"], "words"), lambda w, j: F.when(_word(file, a["s"] + j) == w, F.get(index.of(a["t"], "weights"), j)).otherwise(0.0))
        return F.aggregate(held, F.lit(0.0), lambda total, x: total + x) / index.of(a["t"], "whole")

    decoded = lambda n: F.struct(F.shiftright(n, 40).cast("int").alias("t"), (n.bitwiseAND((1 << 40) - 1) - BEFORE).cast("int").alias("s"))
    found = placed.withColumn("_found", F.transform(F.array_distinct(F.flatten(F.transform(hits, aligned))), decoded))
    is_base = lambda a: index.of(a["t"], "base")
    scored = found.select(
        "doc_id",
        F.size(file).cast("long").alias("n_words"),
        F.coalesce(F.transform(F.filter("_found", is_base), lambda a: F.struct(index.of(a["t"], "label").alias("label"), a["s"].alias("s"))), F.array()).alias("_base"),
        F.coalesce(
            F.filter(
                F.transform(F.filter("_found", lambda a: ~is_base(a)), lambda a: F.struct(index.of(a["t"], "label").alias("label"), share(a).alias("share"))),
                lambda a: a["share"] >= ENOUGH,
            ),
            F.array(),
        ).alias("_own"),
    )
    base, own = F.col("_base"), F.col("_own")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.greatest(F.when(F.size(base) > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.transform(own, lambda a: a["share"])), F.lit(0.0)))
    return scored.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["s"]).cast("long").alias("first_word"),
        F.array_max(base["s"]).cast("long").alias("last_word"),
        joined(base["label"]).alias("base_labels"),
        joined(F.concat(base["label"], own["label"])).alias("labels"),
        F.round(F.least(best, F.lit(1.0)), 6).alias("score"),
    )
