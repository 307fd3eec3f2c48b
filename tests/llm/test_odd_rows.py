"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from prodlake.llm.main_text import main_text
from prodlake.llm.queries import QUERIES
from tests.llm.conftest import LONG, PAGES, ROWS, VECTORS

SCORED = {"op4_quality": 5, "op6_toxicity": 4}
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_document(rows):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r)
    return out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    rows = QUERIES[name](spark, empty).collect()
    # the query of op13 brings a conversation of its own
    assert [r["conv_id"] for r in rows] == [-1] if name.startswith("op13") else rows == []


@pytest.mark.parametrize("name", sorted(SCORED))
def test_scores(spark, odd, name):
    rows = QUERIES[name](spark, odd).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        mod, held = (5, 0) if name.startswith("op4") else (4, 2)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % mod == held)
    found = by_document(rows)
    assert len({r["score"] for r in found[1] + found[8]}) == 1
    if name == "op6_toxicity":
        assert found[16][0]["score"] > found[12][0]["score"]


def test_licences(spark, odd):
    found = by_document(QUERIES["op1_licence_scan"](spark, odd).collect())
    assert found[2][0]["n_words"] == found[3][0]["n_words"] == 0 and found[2][0]["first_word"] is None
    assert found[9][0]["n_words"] == len(LONG.split())
    r = found[14][0]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (3, 2, 10, "cc-by,reserved")
    assert "cc-by-nc" in r["labels"].split(",") and 0 < r["score"] <= 1
    assert found[15][0]["base_labels"] == "gpl" and "gpl-3.0" in found[15][0]["labels"]
    assert found[1][0]["labels"] == "" and found[1][0]["score"] == 0
    assert sum(map(len, found.values())) == len(ROWS)


def test_pages(spark, odd):
    rows = QUERIES["op2_html_extraction"](spark, odd).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in rows) == sorted((i or 0, main_text(h), len(main_text(h))) for i, _, h in PAGES)
    texts = {r["page_id"]: r["text"] for r in rows}
    assert texts[1] == "T a b&c" and texts[2] == "" and texts[3] == "" and texts[4] == "plain < text & more"
    assert texts[5] == "kept words" and texts[6] == "deep"


def test_top_k(spark, odd):
    good = [(i, v) for i, v in VECTORS if i is not None and v and None not in v and np.isfinite(v).all()]
    ints = {n: [(i, np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64)) for i, v in good if len(v) == n] for n in (2, 4)}
    want = []
    for group in ints.values():
        for i, v in group:
            if i % 100 == 0:
                near = sorted(((-int(v @ w), j) for j, w in group if j != i))[:10]
                want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(near)]
    assert sorted(map(tuple, QUERIES["op5_exact_top_k"](spark, odd).collect())) == sorted(want)


def test_media(spark, odd):
    rows = QUERIES["op8_media_columns"](spark, odd).collect()
    assert len(rows) == len(ROWS)
    found = by_document(rows)
    for i, t in ROWS:
        raw = (t or "").encode()
        padded = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        for r in found[i] if i is not None else []:
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
            assert r["tail_crc32"] == zlib.crc32(padded[-16:]) and r["width"] * r["height"] == len(padded)
    assert len({(r["media_sha256"], r["feature"], r["media_bytes"]) for r in found[1] + found[8]}) == 1


def test_bpe(spark, odd):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    rows = QUERIES["op9_bpe"](spark, odd).collect()
    want = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i or 0, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((r[0] or 0, *r[1:]) for r in rows) == sorted(want)


def test_jaccard(spark, odd):
    rows = QUERIES["op10_ngram_jaccard_join"](spark, odd).collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert got[2] == (0, 2) and got[3] == (0, 3) and got[4] == (0, 4) and got[5] == (1, 5)
    assert got[6] == got[7] == (1, 6) and got[1] == got[8] == (4, 1)
    assert got[9][1] == got[10][1] == 9 and got[12][1] == 12 and got[13][1] == 13
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)


def test_repeats(spark, odd):
    rows = {r["doc_id"]: r for r in QUERIES["op3_suffix_array_dedup"](spark, odd).collect()}
    assert set(rows) == {9, 10, 12, 13, 20}
    assert [tuple(s) for s in rows[20]["drops"]] == [(4, 74)]  # behind a word of 300,000 letters
    assert [tuple(s) for s in rows[12]["repeats"]] == [(4, 74)] and rows[12]["drops"] == []
    assert [tuple(s) for s in rows[13]["drops"]] == [(3, 73)]
    assert [tuple(s) for s in rows[10]["drops"]] == [(0, 60_000)]


@pytest.mark.parametrize("which", range(5))
def test_stages(spark, odd, empty, which):
    name, stage = corpus_pipeline.STAGES[which]
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    out = stage(spark, docs, odd)
    if name != "bpe":
        assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType
    rows = out.collect()
    nothing = spark.read.parquet(f"{empty}/documents.parquet")
    assert stage(spark, nothing, empty).collect() == []
    kept = {r["doc_id"] for r in rows}
    if name == "toxicity":
        assert {12, 13, 9, 2, 3, None} <= kept
    if name == "jaccard_join":
        # 12 and 13 share 66 of 78 five-word shingles
        assert {1, 2, 3, 4, 5, 6, 9, 12, None} <= kept and not {7, 8, 10, 13} & kept
    if name == "suffix_dedup":
        assert len(rows) == len(ROWS)
        texts = {r["doc_id"]: r for r in rows}
        assert texts[13]["text"] == "other words here  ending" and texts[13]["n_chars"] == len("other words here  ending")
        assert texts[12]["text"] == dict(ROWS)[12] and texts[10]["text"] == " tail"
        assert {texts[i]["row"] for i in (1, 12)} == {"row-0", f"row-{[i for i, _ in ROWS].index(12)}"}
    if name == "bpe":
        assert len(rows) == len(ROWS) and all(len(r["ids"]) == r["n_tokens"] for r in rows)


def test_whole_pipeline(spark, odd, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []
    rows = corpus_pipeline.run(spark, odd).collect()
    kept = {r["doc_id"] for r in rows}
    assert {1, 5, 6, 12} <= kept and not {7, 8, 10} & kept


def test_words_agree_with_the_stated_rule():
    from prodlake.llm.hashing import texts_to_words

    for _, t in ROWS:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        hashes, _, _, bounds, _ = texts_to_words([t, "x", t])
        assert bounds[1] == len(words) and (hashes[: bounds[1]] == hashes[bounds[2] :]).all()
        assert len(set(hashes[: bounds[1]].tolist())) == len(set(words))


def test_hashes_do_not_depend_on_what_follows():
    import numpy as np

    from prodlake.llm.hashing import BASE, U64, mix, range_hashes, texts_to_words

    text = "ab alpha beta gamma ab"
    alone = texts_to_words([text])[0]
    for size in (100_000, 300_000):
        run = "q" * size
        hashes, _, _, bounds, _ = texts_to_words([text, "short words", text + " " + "z" * 70_000 + " " + run, text, run])
        for k in (0, 2, 3):
            assert (hashes[bounds[k] : bounds[k] + 5] == alone).all()
        assert hashes[bounds[3] - 1] == hashes[bounds[4]] == texts_to_words([run])[0][0]
    rng = np.random.default_rng(8)
    for _ in range(20):  # words of any size at any offset, among any others
        words = ["".join(rng.choice(list("abcXYZ"), size=int(rng.choice([1, 3, 20, 60_000, 70_000, 263_000, 600_000], p=[0.3, 0.3, 0.2, 0.06, 0.06, 0.05, 0.03])))) for _ in range(12)]
        together = texts_to_words([" ".join(words)])[0]
        assert together.tolist() == [int(texts_to_words([w])[0][0]) for w in words]
    values = np.arange(300_000, dtype=np.uint64) % np.uint64(251)
    total = sum((int(v) + 1) * pow(int(BASE), k, 1 << 64) for k, v in enumerate(values)) % (1 << 64)
    assert range_hashes(values, np.array([0, 5]), np.array([300_000, 7])).tolist() == mix(np.array([total, 6 + 7 * int(BASE) % (1 << 64)], dtype=U64)).tolist()


def test_long_training_texts_count_whole():
    import numpy as np
    import pyarrow as pa

    from prodlake.llm.toxicity import _features, levels, patterns, training_features

    assert patterns(["A" * 1500, "A" * 1500 + " b"])[:, 0].tolist() == [1, 0]
    batch = pa.record_batch([pa.array(["word " * 300 + "other " * 14_000]), pa.array([0], pa.int32())], names=["text", "y"])
    _, times, words, _, _ = training_features(pa.Table.from_batches(list(_features(iter([batch])))).to_pylist())[0]
    assert words == 14_300 and {300, 14_000} <= set(times.tolist())
    assert levels(times, np.full(len(times), words))[3, times == 300].any()


def test_very_many_places_of_a_phrase(spark):
    """A text that is one phrase again and again: places are told apart in a hash set, not by comparing all."""
    import time

    from prodlake.llm.licences import scan

    n = 200_000
    docs = spark.createDataFrame([(1, "cc by " * n), (2, "by cc")], "doc_id long, text string")
    scan(docs.where("doc_id = 2")).collect()
    began = time.perf_counter()
    r = {x["doc_id"]: x for x in scan(docs).collect()}[1]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n, 0, 2 * n - 2, "cc-by")
    assert time.perf_counter() - began < 60
