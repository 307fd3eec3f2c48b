"""Chat formatting: examples, escapes, and the way back against plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from prodlake.llm.chat import END, TURN, _role_back, digests, escaped, examples, expanded, unescaped
from prodlake.llm.queries import op13_chat_formatting

NASTY = ["</s>", "<s>", "[INST]", "[/INST]", TURN, END, "<|im_start|>", "<<SYS>>", "</s\\>", "<|turn|\\\\>", "\\", "\n", "user", "é", "😀", "<", ">", "]", " "]
SCHEMA = "conv_id long, turn long, role string, text string, place string"


def talks(seed):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(30), None]:
        for turn in range(draw.choice([1, 2, 3, 8, 40])):
            text = "".join(draw.choices(NASTY, k=draw.randrange(8)))
            rows.append((conv, turn, draw.choice(["user", "assistant", "system", "odd\nro\\le<s>", None]), draw.choice([text, text, None]), "p"))
    return rows


def by_conversation(rows):
    out = {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_escapes_come_back(spark):
    draw = random.Random(1)
    texts = ["".join(draw.choices(NASTY, k=draw.randrange(12))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e")).collect()
    for r in rows:
        assert unescaped(r["e"]) == r["t"]
        assert not any(c in r["e"] for c in (TURN, END, "</s>", "[INST]", "[/INST]", "<|im_start|>"))


@pytest.mark.parametrize("block", [1, 60, 1 << 14])
def test_examples_and_digests(spark, block):
    rows = talks(block)
    table = expanded(spark.createDataFrame(rows, SCHEMA).repartition(5), block)
    laid = sorted(table.collect(), key=lambda r: r["place"])
    got = {r["conv_id"]: r for r in digests(table).collect()}
    want = by_conversation(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        mine = [r for r in laid if r["conv_id"] == conv]
        learned, examples, context = [], 0, ""
        for r in mine:
            if r["trainable"]:
                whole = context + r["text"]
                learned.append(unescaped(r["text"][r["loss_start"] : r["loss_end"]]))
                # all turns before the reply are its context, and it ends with the reply
                upto = [k for k, (role, _) in enumerate(turns) if role == "assistant"][examples]
                assert whole.count(TURN) == upto + 1 and whole.endswith(END)
                examples += 1
            else:
                context += r["text"]
        assert learned == [t for role, t in turns if role == "assistant"]
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), sum(len(t) for t in learned))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256("".join(learned).encode()).hexdigest()
    whole = {r["conv_id"]: r["formatted_chars"] for r in digests(expanded(spark.createDataFrame(rows, SCHEMA), 1 << 30)).collect()}
    assert whole == {c: r["formatted_chars"] for c, r in got.items()}


def test_a_long_conversation_stays_linear(spark):
    """One conversation holds nearly all rows: stretches bound its examples, and several tasks lay it out."""
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} " + "word " * 20, "p") for k in range(4000)] + [(2, 0, "user", "hi", "p")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = expanded(spark.createDataFrame(rows, SCHEMA), 2000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    longest, total, places = table.select(F.max(F.length("text")), F.sum(F.length("text")), F.count_distinct(F.shiftright("place", 40))).first()
    assert longest < 2300 and total < 4000 * 2300 and places > 1
    r = {x["conv_id"]: x for x in digests(table).collect()}[1]
    assert r["n_turns"] == 4000 and r["loss_sha256"] == hashlib.sha256("".join(t for *_, role, t, _ in rows if role == "assistant").encode()).hexdigest()


def test_repeated_numbers_and_empty_table(spark):
    rows = [(1, 0, "user", "a", "p"), (1, 0, "user", "a", "p"), (1, None, "system", "s", "p"), (1, 2, "assistant", "", "p"), (1, 2, "assistant", "b", "p")]
    r = digests(expanded(spark.createDataFrame(rows, SCHEMA))).first()
    assert (r["n_turns"], r["loss_chars"]) == (5, 1)
    assert digests(expanded(spark.createDataFrame([], SCHEMA))).collect() == []


def test_the_planted_conversation(spark, small):
    found = {r["conv_id"]: r for r in op13_chat_formatting(spark, small).collect()}
    hard = "</s>[INST] ok [/INST]"
    assert found[-1]["turns_sha256"] == hashlib.sha256(f"user\n{hard}\nassistant\n{hard}\n".encode()).hexdigest()
    assert found[-1]["loss_chars"] == len(hard) and found[-1]["loss_sha256"] == hashlib.sha256(hard.encode()).hexdigest()


def test_odd_conversations(spark, odd):
    """Null roles, texts, turns and ids, repeated turns, forged marks and a very long text, beside columns of other names."""
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in op13_chat_formatting(spark, odd).collect()}
    assert set(got) == {None, -1, 1, 2, 3} and got[1] == (3, 0) and got[3] == (1, 0) and got[None] == (2, 0)
    assert got[2][0] == 4 and got[2][1] > 100_000


def read(text):
    """Turns of a formatted text: roles and texts."""
    turns = [t.removesuffix(END).partition("\n") for t in text.split(TURN)[1:]]
    return [(_role_back(head), unescaped(body)) for head, _, body in turns]


@pytest.mark.parametrize("block, ranges", [(1, 3), (60, 3), (60, 17), (1 << 14, 3), (1 << 14, 17)])
def test_every_example_has_all_of_its_context(spark, block, ranges):
    """Before, a stretch ended where a range of turns ended, and examples behind it held what came after it alone, in ordinary conversations, too."""
    rows = talks(5)
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = expanded(spark.createDataFrame(rows, SCHEMA).repartition(5), block)
        pieces = sorted(examples(table).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["example"], r["piece"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = {}
    for r in pieces:
        whole.setdefault((r["conv_id"], r["example"]), []).append(r)
    got = {}
    for (conv, _), parts in whole.items():
        assert all(p["loss_start"] is None for p in parts[:-1]) and (block < 1 << 14 or len(parts) == 1)
        last = parts[-1]
        got.setdefault(conv, []).append((read("".join(p["text"] for p in parts)), last["loss_start"] and unescaped(last["text"][last["loss_start"] : last["loss_end"]])))
    for conv, turns in by_conversation(rows).items():
        want = [(turns[: k + 1], text) for k, (role, text) in enumerate(turns) if role == "assistant"]
        assert got.pop(conv) == want + ([(turns, None)] if turns[-1][0] != "assistant" else [])
    assert not got


def test_rows_do_not_depend_on_how_turns_are_spread(spark):
    rows = [(conv, k, "assistant" if k % 2 else "user", f"turn {k} " + "word " * (conv % 7), "p") for conv in range(40) for k in range(60 if conv % 9 else 400)]
    found = []
    for ranges in ("2", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            found.append(sorted(tuple(r) for r in expanded(spark.createDataFrame(rows, SCHEMA).repartition(int(ranges)), 3000).drop("place").collect() if r["loss_start"] is not None))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] == found[1]
