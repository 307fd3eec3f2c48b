from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prodlake.functions import rich_text, similarity
from prodlake.functions import text as X
from prodlake.operators.audit import schema_errors
from prodlake.operators.alignment import best_matches


def values(spark, rows, **columns):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [tuple(r) for r in df.select(*[c.alias(k) for k, c in columns.items()]).collect()]


def test_normalisers(spark):
    x = F.col("x")
    got = values(spark, ["(주)한국 제약회사 A-1", "비타(증정 3)C(D)", " 10 정 ", None], a=X.company(x), b=X.registry_name(x), c=X.plain_name(x), d=X.capacity(x))
    assert got[0][0] == "한국a1" and got[1][1:3] == ("비타cd", "비타c") and got[2][3] == "10tab" and got[3] == ("", "", "", "")


def test_trimming_and_numbers(spark):
    x = F.col("x")
    got = values(spark, [" 　a b\t", "1,200.50원", "2024-01-02T", "=1+1", 'a"b'], t=X.trim_space(x), n=X.digits_price(x), d=X.comparable_date(x), c=X.csv_cell(x))
    assert got[0][0] == "a b" and got[1][1] == 120050 and got[2][2] == "20240102" and got[3][3] == "'=1+1" and got[4][3] == '"a""b"'


def test_extraction(spark):
    x = F.col("x")
    got = values(spark, ["타이레놀 연질 캡슐 500mg(30정)(A)", "없음 5 μg / 5ug"], f=X.dosage_form(x), s=X.strengths(x), p=X.parentheticals(x), n=X.pack_count(x))
    assert got[0] == ("연질캡슐", ["500mg"], ["a"], 30) and got[1] == ("", ["5mcg"], [], None)


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_indel_ratio(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    want = 200 * table[-1][-1] / (len(a) + len(b)) if a or b else 100.0
    assert abs(similarity.indel(a, b) - want) < 1e-9


def test_similarity_udfs(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("", "x"), (None, "x")], "a string, b string")
    got = df.select(similarity.matching_blocks_ratio("a", "b"), similarity.nfc(F.lit("é")), similarity.unescape(F.lit("&amp;")), similarity.canonical_json(F.lit('{"b": 1, "a": [1, 2]}'))).collect()
    assert got[0][0] == SequenceMatcher(None, "abcd", "bcde").ratio() and got[1][0] == got[2][0] == 0
    assert tuple(got[0])[1:] == ("é", "&", '{"a":[1,2],"b":1}')


def test_rich_text():
    parsed = rich_text.parse("첫줄brbr<P></P>둘째br\n<table><tr><th>A</th><th>B</th></tr><tr><td rowspan=2>1</td><td>2</td></tr><tr><td>3</td></tr></table>3 ? 5")
    kinds = [b["type"] for b in parsed["blocks"]]
    assert kinds == ["paragraph", "paragraph", "table", "paragraph"]
    assert parsed["blocks"][2]["headers"] == ["A", "B"] and parsed["blocks"][2]["rows"] == [["1", "2"], ["", "3"]]
    assert parsed["text"].endswith("1 | 2\n | 3\n\n3–5")
    once = rich_text.parse("가brbr나<p>x  y</p>1 ? 2 &amp;lt;")["text"]
    assert once == "가\n\n나\n\nx y\n\n1–2 <" and rich_text.parse("가\n\n나\n\nx y")["text"] == "가\n\n나\n\nx y"
    assert rich_text.parse(None) == {"text": "", "blocks": []}


def test_nested_table_becomes_lines():
    block = rich_text.parse("<table><tr><td>a<table><tr><td>1</td><td>2</td></tr></table></td></tr></table>")["blocks"][0]
    assert block["rows"] == [["a\n1 | 2"]]


def test_stray_text_and_open_tables_are_dropped():
    assert rich_text.parse("<table><tr><td>a</td>stray<td>b</td></tr>more</table>c")["blocks"][0]["rows"] == [["a", "b"]]
    assert rich_text.parse("a<table><tr><td>b</td></tr>") == {"text": "a", "blocks": [{"type": "paragraph", "text": "a", "headers": None, "rows": None}]}
    assert rich_text.parse("<table><tr><td rowspan=3 colspan=2>x1</td><td>y</td></tr><tr><td>z</td></tr></table>")["blocks"][0]["rows"] == [["x1", "", "y"], ["", "", "z"], ["", "", ""]]
    assert rich_text.parse("<table><tr><td>1</td><tr><td>2</td></table>")["blocks"][0]["rows"] == [["1"], ["2"]]


def test_schema_errors():
    schema = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"oneOf": [{"type": "null"}, {"type": "string", "minLength": 2}]}, "c": {"type": "array", "items": {"const": 1}}}}
    assert schema_errors({"a": 1, "b": None, "c": [1]}, schema) == []
    assert schema_errors({"a": 0, "b": "x", "c": [1, 2], "d": 1}, schema) == ["$.a: too small", "$.b: fits 0 of oneOf", "$.c[1]: not the constant", "$.d: unknown"]
    assert schema_errors({"a": True}, schema) == ["$.a: not of type integer"] and schema_errors({}, schema) == ["$.a: missing"]


def test_alignment():
    def align(left, right, gap, score):
        pairs = [(i, j, float(score(x, y))) for i, x in enumerate(left) for j, y in enumerate(right) if score(x, y) >= 2 * gap]
        i, j = (np.array([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))
        return best_matches(len(left), len(right), i, j, np.array([p[2] for p in pairs]), gap)

    score = lambda x, y: 46 if x == y else -54
    assert align(["a", "b", "c"], ["a", "c"], -12, score) == [(0, 0), (2, 1)]
    assert align([], ["x"], -12, score) == []
    assert align(["a"], ["b"], -200, score) == []  # matched, but with too low a score to be one


def test_wide_spans_and_deep_tables():
    """Spans end where HTML ends them, and tables inside tables are laid out without recursion."""
    wide = rich_text.parse("<table><tr><td rowspan=999999999999999999999 colspan=999999>a</td></tr><tr><td>b</td></tr></table>")
    (table,) = wide["blocks"]
    assert len(table["rows"]) + len(table["headers"] and [1]) == 2 + rich_text.PAST and len(table["rows"][0]) == rich_text.MOST_COLUMNS + 1
    assert rich_text._span("٣", 9) == 3 and rich_text._span("²", 9) == 1 and rich_text._span("0", 9) == 1
    deep = rich_text.parse("<table><tr><td>x" * 3000 + "</td></tr></table>" * 3000)
    assert deep["text"].count("x") == 3000


def test_recurring_texts_are_parsed_once(monkeypatch):
    """A text that recurs is parsed once; one without tags and references is not walked as markup; long ones are not kept."""
    from prodlake.functions import rich_text as R

    walked = []
    tree = R._tree
    monkeypatch.setattr(R, "_tree", lambda text: walked.append(text) or tree(text))
    R._known_text.cache_clear()
    assert [R.parsed_text(t) for t in ["<p>twice</p>"] * 3 + ["plain  text", None, "", "a &amp; b", "x" * 2000]] == ["twice"] * 3 + ["plain text", "", "", "a & b", "x" * 2000]
    assert walked == ["<p>twice</p>", "a & b"] and R._known_text.cache_info().currsize == 3


def test_batches_of_every_query_are_bounded(spark, small):
    """Queries that go by the entry point hold a thousand pages or 8 MB in a worker, not ten thousand pages."""
    import __spark_entry__ as entry

    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    entry.queries()["t16_rich_text"](spark, small)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000"
