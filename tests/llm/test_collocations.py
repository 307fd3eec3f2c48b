"""Collocations against counting every phrase in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from tests.llm.brute import LOWER

from prodlake.llm.collocations import collocations
from prodlake.llm.queries import op11_collocations


def brute(rows, least, top, longest=5, share=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    often = {key: c for key, c in f.items() if c >= least}
    dropped = {
        (lang, w[i : i + m])
        for (lang, w), c in often.items()
        for m in range(2, len(w))
        for i in range(len(w) - m + 1)
        if 100 * c >= share * f[lang, w[i : i + m]]
    }
    found = {}
    for (lang, w), a in often.items():
        if len(w) < 2 or (lang, w) in dropped:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, all_of in found.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(all_of)[:top], 1)
    }


def texts(seed, n=160):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["Ünï", "der", "THE", "x y", "日本"]
    weights = [1 / (k + 1) for k in range(len(words))]
    fixed = ["new york city hall", "a b c d e f", "the x the x the x the x"]
    rows = []
    for k in range(n):
        body = [draw.choice(fixed) if draw.random() < 0.2 else draw.choices(words, weights)[0] + draw.choice([" ", "  ", "\t", " ", ", ", ".\n", " ; "]) for _ in range(draw.randrange(60))]
        rows.append((draw.choice(["en", "de", None, "und", ""]), " ".join(body)))
    return rows + [("en", None), ("en", ""), (None, " \t "), ("one", "word"), ("fr", "a"), ("en", "q " * 3000)]


@pytest.mark.parametrize(("least", "top", "share", "waves", "small"), [(5, 2000, 100, (1.0,), 0), (5, 7, 100, (0.05, 0.2, 0.6, 1.0), 0), (3, 20, 60, (0.1, 0.5, 1.0), 0), (4, 3, 100, (0.02, 1.0), 500)])
def test_against_counting(spark, monkeypatch, least, top, share, waves, small):
    from prodlake.llm import collocations as module

    monkeypatch.setattr(module, "SMALL", small)
    rows = texts(least + top)
    docs = spark.createDataFrame([(k, lang, text, "x", "y") for k, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, phrase string, f string").repartition(3)
    found = [tuple(r) for r in collocations(docs, least=least, top=top, share=share, waves=waves).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(rows, least, top, share=share)


def test_a_wave_settles_before_the_last(spark, monkeypatch):
    """Rare words that always stand together outscore what frequent words can reach, which is then never counted."""
    from prodlake.llm import collocations as module

    monkeypatch.setattr(module, "SMALL", 0)
    opened = []
    plain = module._wave
    monkeypatch.setattr(module, "_wave", lambda *a: opened.append(1) or plain(*a))
    rows = [("en", f"r{k} s{k}. of the of the of the {k % 7}") for k in range(9) for _ in range(6)]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "lang string, text string, doc_id long")
    found = {tuple(r) for r in collocations(docs, least=5, top=4, waves=(0.3, 1.0)).collect()}
    assert found == brute(rows, 5, 4) and len(opened) == 1


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    from prodlake.llm.collocations import _scored

    a, l, r, n = 2_999_999_999_999, 3_000_000_000_017, 4_000_000_000_001, 900_000_000_000_007
    known = spark.createDataFrame([("en", "x", 1, l), ("en", "y", 1, r), ("en", "x y", 2, a)], "lang string, phrase string, k int, f long")
    caps = spark.createDataFrame([("en", 1 << 50, n, -1)], "lang string, cap long, n long, closed long")
    assert _scored(known, caps, 100).select(F.col("score")).first()[0] == 1000 * a * n // (l * r)


def test_odd_and_empty_tables(spark, odd, empty):
    assert op11_collocations(spark, empty).collect() == []
    found = op11_collocations(spark, odd).collect()
    assert all(r["a"] >= 100 for r in found) and {r["phrase"] for r in found} >= set()
