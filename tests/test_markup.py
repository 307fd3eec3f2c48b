from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from prodlake.plans import ORACLE_SQL, QUERIES
from prodlake.sources import markup as M


def test_page():
    got = M.parse_page("<title> A &amp; b</title><script>var x = '<a href=q>'</script><a href='/p?c=1'>One <b>two</b></a><table><tr><td>1<table><tr><td>in</td></tr></table></td><td>2</table><img src=x.png>")
    assert got["title"] == "A & b" and got["links"] == [{"href": "/p?c=1", "text": "One two"}] and got["images"] == ["x.png"]
    assert got["tables"][1] == [["in"]] and got["tables"][0][0][1] == "2"
    assert M.parse_page(None) == {"title": "", "links": [], "tables": [], "images": []}


def test_sections():
    text = "<div id=a>x<div>y</div><p>z</p></div>out<div id=b>only</div><div id=a>again</div>"
    assert M.parse_sections(text, frozenset(("a", "b", "c"))) == {"a": "x\ny\nz", "b": "only"}


def test_embedded_and_walk(spark):
    df = spark.createDataFrame([(1, "window.__S__ = {\"b\": [1, {\"t\": \"x\"}], \"a\": \"y\"}; foo"), (2, "nothing"), (3, "window.__S__ = {broken")], "k int, t string")
    found = df.select("k", M.embedded_json("window.__S__")("t").alias("j"))
    assert [r["j"] for r in found.orderBy("k").collect()] == ['{"a":"y","b":[1,{"t":"x"}]}', None, None]
    assert sorted(map(tuple, M.walk_texts(found, "k", F.col("j")).collect())) == [(1, "$.a", "y"), (1, "$.b[1].t", "x")]


def test_table_records(spark):
    df = spark.createDataFrame([([["n", "v"], ["a", "1"], ["b"]],), ([["n", "n"], ["a", "1"]],), ([],)], "rows array<array<string>>")
    got = [r[0] for r in df.select(M.table_records(F.col("rows"))).collect()]
    assert got == [[{"n": "a", "v": "1"}, {"n": "b", "v": ""}], None, None]


def test_titles_and_their_sql(spark, tmp_path):
    """Titles that are cut inside a reference, one that is escaped twice, and white space."""
    titles = ["a &amp; b", "cut at&amp", "cut at&am", "&quot;q&quot", "&amp;quot; &amp;lt;", "&lt;b&gt", " two\n  lines ", ""]
    pages = [(k, f"<html><title>{t}</title><a href=x>y</a></html>") for k, t in enumerate(titles)] + [(99, None)]
    spark.createDataFrame(pages, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, QUERIES["s16_page_scan"](spark, str(tmp_path)).collect()))
    db = duckdb.connect()
    db.sql(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == sorted(db.execute(ORACLE_SQL["s16_page_scan"]).fetchall())
    assert [r[2] for r in got] == ["a & b", "cut at&", "cut at&am", '"q"', "&quot; &lt;", "<b>", "two lines", "", ""]
