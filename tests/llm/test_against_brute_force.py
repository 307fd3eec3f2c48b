from __future__ import annotations

import hashlib
import itertools

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from prodlake.llm import jaccard_join as J
from prodlake.llm import mixing, quality, toxicity
from prodlake.llm.mixing import Mix, mix_sources
from prodlake.llm.queries import QUERIES
from prodlake.llm.session import components, shared_runs
from prodlake.llm.suffix_dedup import repeated_passages
from tests.conftest import DATA
from tests.llm import brute


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(spark, small, texts, n, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(spark.read.parquet(f"{small}/documents.parquet"), n, percent).collect()}
    want = brute.components(texts, n, percent)
    assert got == {i: (len(brute.shingles(t, n)), want[i]) for i, t in texts.items()}


def test_no_linked_pair_is_missed_by_the_index():
    rng = np.random.default_rng(5)
    linked = 0
    for percent in (60, 80, 90):
        plan = J.plan_bands({k: int(rng.integers(0, 5000)) for k in range(min(60, len(J.bands(percent)) - 3))}, percent)
        for _ in range(400):
            size = int(rng.choice([1, 2, 3, 5, 8, 12, 20, 40, 80, 150, 400]))
            a = np.unique(rng.integers(0, 2**64, size=size, dtype=np.uint64))
            most = max(1, int(size * (1 - percent / 100)) + 2)
            b = np.unique(np.concatenate([rng.permutation(a)[int(rng.integers(0, most)) :], rng.integers(0, 2**64, size=int(rng.integers(0, most)), dtype=np.uint64)]))
            if len(b) and J.links(len(np.intersect1d(a, b)), len(a) + len(b), percent):
                linked += 1
                assert len(np.intersect1d(J.signatures(a, percent, plan), J.signatures(b, percent, plan)))
    assert linked > 300


def _random_set(rng, n):
    return np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64))


def test_no_linked_pair_is_missed_whatever_tokens_are_frequent():
    rng = np.random.default_rng(11)
    for n, percent, plan in [(40, 80, None), (150, 80, None), (90, 90, (2, 2)), (200, 80, (6, 5))]:
        for share in (0.1, 0.5, 1.0):
            for _ in range(15):
                a = _random_set(rng, n)
                gone, new = rng.permutation(len(a)), J.most_different(len(a), len(a), percent) // 2
                b = np.unique(np.concatenate([a[gone[new:]], _random_set(rng, new)]))
                assert J.links(len(np.intersect1d(a, b)), len(a) + len(b), percent)
                frequent = np.unique(a[rng.random(len(a)) < share])
                e = int(np.searchsorted(J.bands(percent), n, side="right")) - 1
                plans = J.plan_bands({k: 1000 for k in (e - 1, e, e + 1)}, percent)
                if plan:
                    need = J.most_different(int(J.bands(percent)[e + 2]), int(J.bands(percent)[e + 2]), percent) + 1
                    plans = {k: (need - sum(plan), *plan) for k in plans}
                assert len(np.intersect1d(J.signatures(a, percent, plans, frequent), J.signatures(b, percent, plans, frequent)))


def test_a_line_that_many_documents_hold_makes_no_family(spark):
    rng = np.random.default_rng(3)
    line = " ".join(f"common{k}" for k in range(14))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 80)) + " " + line for _ in range(1500)]
    texts += [t.replace("common13", "other") for t in texts[:5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = docs.select(F.col("doc_id").alias("rep"), F.lit(90).cast("long").alias("n_shingles"))
    families = J.candidate_families(docs, classes, 5, 80).groupBy("root").count().collect()
    assert max(r["count"] for r in families) < 20
    found = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(docs, 5, 80).collect()}
    assert found == {i: i - 1500 if i >= 1500 else i for i in range(1505)}


def test_frequent_tokens_are_counted_without_a_row_for_each_token(spark, monkeypatch):
    rng = np.random.default_rng(5)
    line = " ".join(f"common{k}" for k in range(14))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 150)) + (" " + line if k % 40 == 0 else "") for k in range(2000)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    classes = docs.select(F.col("doc_id").alias("rep"), F.lit(146).cast("long").alias("n_shingles"))
    tokens, held = np.unique(np.concatenate(J.shingle_sets(texts, 5)), return_counts=True)
    for share_tokens in (1 << 14, 1 << 40):
        monkeypatch.setattr(J, "SHARE_TOKENS", share_tokens, raising=False)
        group = f"frequent-{share_tokens}"
        spark.sparkContext.setJobGroup(group, group)
        found = J.frequent_tokens(docs, classes, 5)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert found.tolist() == tokens[held >= J.HELD_BY].tolist() and len(found) == 10
        tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        assert sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in stages) < len(tokens) / 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=20), min_size=2, max_size=12))
def test_block_links_connect_what_brute_force_connects(sets):
    arrays = [np.unique(np.array(s, dtype=np.uint64)) for s in sets]
    parent = list(range(len(sets)))

    def joined(pairs):
        group = list(range(len(sets)))
        for a, b in pairs:
            x, y = group[a], group[b]
            group = [min(x, y) if g in (x, y) else g for g in group]
        return group

    all_links = [(a, b) for a, b in itertools.combinations(parent, 2) if J.links(len(np.intersect1d(arrays[a], arrays[b])), len(arrays[a]) + len(arrays[b]), 80)]
    assert joined(J.link_block(parent, arrays, 80)) == joined(all_links)


def test_repeated_passages(spark, small, texts):
    every, later = brute.repeats(texts, 50)
    rows = {r["doc_id"]: r for r in repeated_passages(spark.read.parquet(f"{small}/documents.parquet")).collect()}
    places = lambda spans: {k for s in spans for k in range(s["from"], s["to"])}
    assert {i: places(r["repeats"]) for i, r in rows.items()} == every
    assert {i: places(r["drops"]) for i, r in rows.items() if r["drops"]} == later


@pytest.mark.parametrize("batch", ["7", "1000"])
def test_repeats_that_owe_their_ends_to_different_documents(spark, batch):
    """Passages are put together from a few pieces, so that suffixes share their beginnings with many and their left sides with others."""
    rng = np.random.default_rng(3)
    pieces = [" ".join(f"w{x}" for x in rng.integers(0, 40, size=int(rng.integers(3, 14)))) for _ in range(25)]
    docs = {i: " ".join(pieces[k] for k in rng.integers(0, len(pieces), size=int(rng.integers(1, 9)))) for i in range(80)}
    docs |= {100: "same " * 40, 101: "same " * 25 + "other", 102: docs[5], 103: None}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    every, later = brute.repeats(docs, 12)
    rows = {r["doc_id"]: r for r in repeated_passages(frame, length=12, gram=5, span=4).collect()}
    places = lambda spans: {k for s in spans for k in range(s["from"], s["to"])}
    assert {i: places(r["repeats"]) for i, r in rows.items()} == every
    assert {i: places(r["drops"]) for i, r in rows.items() if r["drops"]} == later


def test_neighbours_of_other_documents():
    from prodlake.llm.suffix_dedup import _common

    rng = np.random.default_rng(4)
    for _ in range(50):
        words, docs = rng.integers(0, 2, size=(20, 5)).astype(np.uint32), rng.integers(0, 3, size=20)
        held = rng.integers(2, 6, size=20)
        words[np.arange(5) >= held[:, None]] = 0
        order = np.lexsort([docs, held, *words.T[::-1]])
        words, docs, held = words[order], docs[order], held[order]
        agree = lambda i, j: min(held[i], held[j], next((k for k in range(5) if words[i, k] != words[j, k]), 5))
        want = [max([agree(i, j) for j in range(20) if docs[j] != docs[i]], default=0) for i in range(20)]
        assert _common(words, held, docs, 5).tolist() == want


def test_runs_that_span_ranges(spark):
    """Keys with more rows than a range holds keep one first document."""
    rows = spark.range(20_000).select((F.col("id") % 3).alias("key"), F.col("id").alias("doc_id"), F.lit(0).alias("place"))
    got = shared_runs(rows.repartition(7)).collect()
    assert len(got) == 20_000 and all(r["first"] == r["doc_id"] % 3 for r in got)
    alone = spark.range(100).select(F.col("id").alias("key"), F.col("id").alias("doc_id"), F.lit(0).alias("place"))
    assert shared_runs(alone.union(alone)).collect() == []


def test_top_k_with_many_blocks_copies_and_wide_numbers(spark, monkeypatch):
    from prodlake.llm import topk

    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "GROUP", 2)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(300)] + [(1000 + i, [0.5, 0.5, 0.5]) for i in range(200)]
    rows += [(2000, [1e300, -1e300, 1.0]), (2001, [1e300, 0.0, 0.0]), (2002, [1e15, 1e15, 1e15]), (300, [9.0, 0.0, 0.0]), (300, [0.0, 9.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 5).collect()))
    end = 2**63
    ints = [(i, [max(-end, min(end - 1, int(np.floor(1024 * x)))) for x in v]) for i, v in rows]
    asked = {}
    for (i, v), (_, raw) in zip(ints, rows, strict=True):
        if i % 100 == 0 and (i not in asked or raw < asked[i][0]):
            asked[i] = (raw, v)
    want = []
    for i, (_, v) in asked.items():
        near = sorted((-max(-end, min(end - 1, sum(a * b for a, b in zip(v, w, strict=True)))), j) for j, w in ints if j != i)[:5]
        want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(near)]
    assert got == sorted(want)


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (105, 101), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).distinct().collect()))
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 105: 100}


def test_mixing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    mix = Mix()
    cols = docs.select(*mixing._leaf_columns(docs), "doc_id", mixing.token_count(F.col("text")).alias("n"), F.array(*[mixing._order(F.lit(e), mix.seed) for e in range(5)]).alias("h")).collect()
    leaf = {}
    for r in cols:
        leaf.setdefault((r["_domain"], r["_lang"], r["_source"]), []).append(r)
    tokens = {k: sum(r["n"] for r in v) for k, v in leaf.items()}
    capacity = lambda *p: 4.0 * sum(t for k, t in tokens.items() if k[: len(p)] == p)
    below = lambda *p: sorted({k[len(p)] for k in leaf if k[: len(p)] == p})
    want = set()
    for d, from_root in brute.deal({d: (capacity(d), mix.domains.get(d, 1.0)) for d in below()}, float(sum(tokens.values()))).items():
        for lang, share in brute.deal({x: (capacity(d, x), mix.languages.get(x, 1.0)) for x in below(d)}, from_root).items():
            for s, budget in brute.deal({x: (capacity(d, lang, x), 1.0) for x in below(d, lang)}, share).items():
                rows, t = leaf[d, lang, s], tokens[d, lang, s]
                passes, rest = divmod(int(budget + 1e-6), t)
                want |= {(r["doc_id"], e) for r in rows for e in range(passes)}
                upto = 0
                for r in sorted(rows, key=lambda r: (r["h"][passes], r["doc_id"])):
                    upto += r["n"]
                    if upto > rest or rest <= 0:
                        break
                    want.add((r["doc_id"], passes))
    got = [(r["doc_id"], r["epoch"]) for r in mix_sources(docs, mix).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * n, lang, s, d) for i, (n, lang, s, d) in enumerate([(10, "en", "a", "web"), (100, "en", "b", "web"), (100, "de", "c", "web"), (200, "en", "e", "books")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string")
    mix = Mix(domains={"web": 1, "books": 1}, languages={"en": 1, "de": 1}, share=200 / 410, max_epochs=1)
    leaves = docs.select(*mixing._leaf_columns(docs), mixing.token_count(F.col("text")).alias("n")).groupBy("_domain", "_lang", "_source").agg(F.sum("n").alias("tokens"))
    got = {r["_source"]: r["budget"] for r in mixing.leaf_budgets(leaves, mix).collect()}
    assert got == {"a": 10, "b": 40, "c": 50, "e": 100}


def area(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    ones = label == 1
    return (rank[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()


@pytest.mark.parametrize(("name", "column", "least"), [("op4_quality", "quality", 0.97), ("op6_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, column, least):
    sf_dir = str(DATA / "sf0.01")
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    score, label = np.array([r["score"] for r in rows]), np.array([labels[r["doc_id"]] for r in rows])
    assert area(score, label) > least and ((score >= 0.3) == label).mean() > 0.93


def test_chain_marginals():
    rng = np.random.default_rng(0)
    emit, bounds, turns = rng.normal(size=9), np.array([0, 4, 5, 9]), rng.normal(size=(2, 2))
    got, pairs, total = quality.marginals(emit, bounds, turns)
    want, both, z = np.zeros(9), np.zeros((2, 2)), 0.0
    for a, e in zip(bounds[:-1], bounds[1:], strict=True):
        labels = list(itertools.product((0, 1), repeat=e - a))
        mass = [np.exp(sum(emit[a + i] * y[i] for i in range(e - a)) + sum(turns[y[i], y[i + 1]] for i in range(e - a - 1))) for y in labels]
        z += np.log(sum(mass))
        for y, m in zip(labels, mass, strict=True):
            want[a:e] += np.array(y) * m / sum(mass)
            for i in range(e - a - 1):
                both[y[i], y[i + 1]] += m / sum(mass)
    assert np.allclose(got, want) and np.allclose(pairs, both) and np.isclose(total, z)
    mass = np.array([0.5, 3.0, 2.0])
    each = [quality.marginals(emit[a:e], np.array([0, e - a]), turns)[1] for a, e in zip(bounds[:-1], bounds[1:], strict=True)]
    assert np.allclose(quality.marginals(emit, bounds, turns, mass)[1], sum(m * p for m, p in zip(mass, each, strict=True)))


def test_quality_of_a_text_does_not_depend_on_its_batch(spark, small, texts):
    model = quality.train(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))
    some = [*list(texts.values())[:30], None, "", "x" * 300_000 + "\nshort line", "a\n" * 5000]
    alone = np.concatenate([model.scores([t]) for t in some])
    assert np.allclose(alone, model.scores(some), atol=1e-12)
    got = {r["doc_id"]: r["score"] for r in QUERIES["op4_quality"](spark, small).collect()}
    assert all(abs(got[i] - model.scores([t])[0]) < 1e-12 for i, t in list(texts.items())[:40])


def plain_toxicity(model, text):
    """The score of a text from its words one by one."""
    import re
    from collections import Counter

    words = re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode())
    entries = Counter()
    for w in words:
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in w)
        entries[int(toxicity.words_of(low, toxicity.LETTER_BYTE)[0][0] >> np.uint64(32))] += 1
        for n in toxicity.STEMS:
            if len(low) > n:
                h = int(toxicity.range_hashes(np.frombuffer(low, dtype=np.uint8), np.array([0]), np.array([n]))[0])
                entries[(h + (n << 32)) % (1 << 64) >> 32] += 1
    weights = {int(k): w for k, w in zip(model.keys, model.weights, strict=True)}
    total = model.constant + float(toxicity.patterns([text])[0] @ model.marks)
    for entry, times in entries.items():
        w = weights.get(entry)
        if w is not None:
            held = [True, times >= 2, times >= 2 and 200 * times >= len(words), times >= 2 and 50 * times >= len(words)]
            total += sum(x for x, h in zip(w, held, strict=True) if h)
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def test_toxicity_of_each_text(spark, small, texts):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{small}/documents.parquet"), labels)
    got = {r["doc_id"]: r["score"] for r in QUERIES["op6_toxicity"](spark, small).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert abs(got[i] - plain_toxicity(model, t)) < 1e-9
    odd = [None, "", "YOU IDIOT!! " * 3, "x" * 300_000 + " idiot", "id**t @#$% aaaa 1d1ot"]
    assert np.allclose(model.scores(odd), [plain_toxicity(model, t) for t in odd])


def test_training_texts_stay_under_their_bound(spark):
    from prodlake.llm.labelled import training_rows

    docs = spark.createDataFrame([(i, "x" * (10 * i)) for i in range(1, 41)] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 41)] + [(99, 1)], "doc_id long, toxic int")
    whole = [r["doc_id"] for r in training_rows(docs, labels, "toxic", 4, 2).collect()]
    some = sorted((r["doc_id"] for r in training_rows(docs, labels, "toxic", 4, 2, budget=1000).collect()), key=lambda i: i % 99)
    short = sorted(whole, key=lambda i: i % 99)
    assert some == short[: len(some)] and 0 < sum(10 * (i % 99) for i in some) <= 1000 < sum(10 * (i % 99) for i in short[: len(some) + 1])


def test_media_by_another_reader(spark, small, texts):
    """The stored form, its digest and its feature, made again without the store's own code."""
    import zlib

    rows = {r["doc_id"]: r for r in QUERIES["op8_media_columns"](spark, small).collect()}
    for i, t in list(texts.items())[:60]:
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        lines = b"".join(b"\0" + payload[k : k + 192] for k in range(0, len(payload), 192))
        chunk = lambda name, data: len(data).to_bytes(4, "big") + name + data + zlib.crc32(name + data).to_bytes(4, "big")
        head = (192).to_bytes(4, "big") + (len(payload) // 192).to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])
        image = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, 3)) + chunk(b"IEND", b"")
        assert (rows[i]["media_sha256"], rows[i]["media_bytes"]) == (hashlib.sha256(image).hexdigest(), len(image))
        mean = sum(payload) / len(payload)
        spread = (sum((b - mean) ** 2 for b in payload) / len(payload)) ** 0.5
        told = rows[i]["feature"].split(":")
        assert abs(float(told[0]) - mean) < 1e-3 and abs(float(told[1]) - spread) < 1e-3 and len(told[2]) == 16


def test_label_model_discounts_repeated_voters():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    vote = lambda right: np.where(rng.random(4000) < right, y, ~y) * 2 - 1
    copy = vote(0.7)
    votes = np.column_stack([vote(0.9), vote(0.85), vote(0.8), copy, copy, copy]).astype(np.float32)
    posterior, odds, corr = toxicity.label_model(votes, prior=0.3)
    assert ((posterior > 0.5) == y).mean() > 0.9
    # only positive correlations discount; conditioning on the votes themselves makes others negative
    assert corr[3, 4] > 0.95 and corr[0, 1] < 0.2 and odds[0] > odds[3]


def test_dividing_line():
    line = toxicity.dividing_line
    assert line(np.zeros(5), np.array([1, 0, 0, 0, 0])) > 0  # equal scores: nothing is called toxic
    assert line(np.array([0.0, 1.0, 5.0, 6.0]), np.array([0, 0, 1, 1])) == 3.0
    assert 0.0 < line(np.array([0.0, 0.0, 2.0, 2.0]), np.array([0, 0, 1, 1])) < 2.0


def test_pipeline(spark, small, texts):
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    toxic = {r["doc_id"] for r in QUERIES["op6_toxicity"](spark, small).collect() if r["predicted"]}
    docs = {i: t for i, t in texts.items() if i not in toxic}
    docs = {i: docs[i] for i, c in brute.components(docs, 5, 80).items() if i == c}
    later = brute.repeats(docs, 50)[1]
    docs = {i: brute.cut(t, later[i]) if i in later else t for i, t in docs.items()}
    left = spark.createDataFrame([(i, t, rows[i]["lang"], rows[i]["source"]) for i, t in docs.items()], "doc_id long, text string, lang string, source string")
    taken = [r["doc_id"] for r in mix_sources(left).collect()]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i in taken:
        ids = library.encode(docs[i], add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, small).collect()]
    assert sorted(got) == sorted(want)
