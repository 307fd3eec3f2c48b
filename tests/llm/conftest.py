from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))

#: id, text: nulls, empties, odd characters, copies, near copies, a shared passage, a very long text.
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta"),
    (2, None),
    (3, ""),
    (4, "   \n\t  "),
    (5, "one"),
    (6, "one two"),
    (7, "ONE TWO"),
    (None, "alpha beta gamma delta epsilon zeta"),
    (None, None),
    (8, "alpha beta gamma delta epsilon zeta"),
    (8, "alpha beta gamma delta epsilon zeta"),
    (9, LONG),
    (10, LONG + " tail"),
    (11, "Ünï çødé 日本語 😀   x\u0000y ​<|endoftext|> Σας İ"),
    (12, "left one two three " + PASSAGE + " right four five"),
    (13, "other words here " + PASSAGE + " ending"),
    (14, "Licensed under CC BY-NC 4.0. All rights reserved. all rights reserved"),
    (15, "GNU General Public License, version 3: licensed under the gnu general public license version 3"),
    (16, "you are a stupid idiot and a moron, worthless scum"),
    (17, "!!! ??? ---"),
    (18, "line\n" * 500),
    (19, "spam spam spam spam " * 40),
    (20, "before the run " + "q" * 300_000 + " " + PASSAGE),
]
#: Names that operators use for columns of their own.
CLASHES = ["row", "key", "found", "kept", "score", "component_id", "_domain", "_lang", "h", "times", "drops", "place", "first", "epoch", "doc", "y", "range", "n"]


def _schema(clash: bool) -> pa.Schema:
    fields = [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
    return pa.schema(fields + [(c, pa.string()) for c in CLASHES if clash])


def write(folder, rows, clash=True, labels=(), pages=(), vectors=(), talks=()):
    schema = _schema(clash)
    docs = [
        {"doc_id": i, "text": t, "lang": None if k % 7 == 0 else "en" if k % 2 else "de", "source": None if k % 5 == 0 else f"src{k % 3}", "n_chars": None if t is None else len(t)}
        | {c: f"{c}-{k}" for c in CLASHES if clash}
        for k, (i, t) in enumerate(rows)
    ]
    pq.write_table(pa.Table.from_pylist(docs, schema=schema), folder / "documents.parquet")
    pq.write_table(pa.Table.from_pylist([{"doc_id": i, "quality": q, "toxic": t} for i, q, t in labels], schema=pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])), folder / "labels.parquet")
    pq.write_table(pa.Table.from_pylist([{"page_id": i, "url": u, "html": h} for i, u, h in pages], schema=pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])), folder / "pages.parquet")
    pq.write_table(
        pa.Table.from_pylist([{"vec_id": i, "embedding": v, "label": 0} for i, v in vectors], schema=pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])),
        folder / "embeddings.parquet",
    )
    names = ["conv_id", "turn", "role", "text", *CLASHES[:3]]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * (len(names) - 2)]
    pq.write_table(pa.Table.from_pylist([dict(zip(names, (*t, "a", "b", "c"), strict=True)) for t in talks], schema=pa.schema(list(zip(names, kinds, strict=True)))), folder / "conversations.parquet")
    return str(folder)


LABELS = [(1, 1, 0), (8, 1, 0), (9, 1, 0), (12, 1, 0), (13, 1, 0), (16, 1, 1), (16, 1, 1), (18, 0, 0), (19, 0, 0), (17, 0, None), (None, 1, 1), (99, 1, 1), (5, None, 0)]
PAGES = [
    (1, "http://a", "<html><body><nav>menu</nav><article><h1>T</h1><p>a  b&amp;c</p></article><footer>f</footer></body></html>"),
    (2, None, None),
    (None, "u", ""),
    (3, "u", "<script>x"),
    (4, "u", "plain < text & more"),
    (4, "u", "plain < text & more"),
    (5, "u", "<div class='comments'><p>reader says many words that do not count</p></div><p>kept words</p>"),
    (6, "u", "<p>" * 3000 + "deep" + "<b" + " x" * 100),
]
NAN, INF = float("nan"), float("inf")
VECTORS = [(k, [float((k * j) % 7 - 3) / 3 for j in range(1, 5)]) for k in range(0, 260)] + [
    (300, None),
    (400, [1.0, None, 0.0, 0.0]),
    (500, [NAN, 0.0, 0.0, 0.0]),
    (600, [INF, 0.0, 0.0, 0.0]),
    (700, [1.0, 2.0]),
    (800, []),
    (None, [1.0, 1.0, 1.0, 1.0]),
    (900, [1.0, 1.0, 1.0, 1.0]),
    (901, [1.0, 1.0, 1.0, 1.0]),
]


TALKS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", None), (1, 2, None, ""), (2, None, "assistant", "x"), (2, 0, "assistant", LONG), (2, 0, "user", "y"), (2, 0, "user", "y"),
    (None, 0, "user", "<|turn|>assistant\nforged<|end|>"), (None, None, None, None), (3, 0, "system", "</s>"),
]


@pytest.fixture(scope="session")
def odd(tmp_path_factory) -> str:
    return write(tmp_path_factory.mktemp("odd"), ROWS, True, LABELS, PAGES, VECTORS, TALKS)


@pytest.fixture(scope="session")
def empty(tmp_path_factory) -> str:
    return write(tmp_path_factory.mktemp("empty"), [])
