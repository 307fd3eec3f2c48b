"""Queries over boxes: the band join in two dimensions and catalogue rows read from lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.operators.layout import Window2, band_pairs, catalogue_lines
from prodlake.plans.registry import query
from prodlake.session import table

#: Boxes that Spark and DuckDB derive alike from lineitem: a page a supplier, four lines a row of it.
_KINDS = (
    ("0", "100 + l_partkey % 50", "y + l_partkey % 21 - 10", "concat('item ', cast(l_partkey as string), case when l_linenumber % 5 = 4 then ' 12 캡슐' else '' end)"),
    ("1", "400 + l_partkey % 400", "y + l_partkey % 33 - 16", "case l_linenumber % 4 when 0 then '검색' when 1 then '30 정' when 2 then '10㎖' else ' x|y  z ' end"),
    ("2", "740 + l_partkey % 30", "y", "price"),
    ("3", "60 + (l_partkey * 7) % 400", "y + 50 + l_partkey % 60", "case when l_linenumber = 7 then '  ' else concat(l_returnflag, l_linestatus, ' kind') end"),
)
_LINES = " union all ".join(
    f"select page, 4 * n + {kind} as place, {text} as text, 0.375D + (l_orderkey % 40) / 64.0D as score, {x} as x1, {y} as y1, {x} + 60 as x2, {y} + 20 as y2 from rows" for kind, x, y, text in _KINDS
)
_ROWS = "select l_suppkey as page, l_orderkey * 8 + l_linenumber as n, l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, (l_orderkey * 37 + l_linenumber * 113) % 30000 as y, {price} as price from {once}"
_ONCE = "(select l_suppkey, l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_returnflag) as l_returnflag, min(l_linestatus) as l_linestatus from {lineitem} group by 1, 2, 3)"
_SQL = f"rows as ({_ROWS.format(price="format('{:,}', (l_partkey * 37) % 5000 * 11)", once=_ONCE.format(lineitem='lineitem'))}), lines as ({_LINES.replace('0D', '0').replace('5D', '5').replace('as string', 'as varchar')})"


def _lines(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("layout_lineitem")
    rows = _ROWS.format(price="format_number((l_partkey * 37) % 5000 * 11, 0)", once=_ONCE.format(lineitem="layout_lineitem"))
    kinds = ", ".join(f"named_struct('kind', {kind}, 'text', {text}, 'x1', {x}, 'y1', {y})" for kind, x, y, text in _KINDS)
    # one pass over the rows: a union of four would group lineitem once for each kind of line
    each = f"select page, 4 * n + line.kind as place, line.text as text, 0.375D + (l_orderkey % 40) / 64.0D as score, line.x1 as x1, line.y1 as y1 from rows lateral view explode(array({kinds})) as line"
    return spark.sql(f"with rows as ({rows}), lines as ({each}) select *, x1 + 60 as x2, y1 + 20 as y2 from lines")


@query(
    "j12_band_pairs",
    f"""with {_SQL} select a.place as anchor, b.place as box from lines a join lines b on a.page = b.page and a.place % 4 = 2 and b.place % 4 <> 2
    and b.y1 - a.y1 between -52 and 118 and b.x1 - a.x1 between -400 and 20""",
)
def pairs(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    anchors = lines.where("place % 4 = 2").select("page", F.col("place").alias("anchor"), "x1", "y1")
    boxes = lines.where("place % 4 <> 2").select("page", F.col("place").alias("box"), "x1", "y1")
    return band_pairs(anchors, boxes, ["page"], "x1", "y1", Window2(-52, 118, -400, 20)).select("anchor", "box")


@query(
    "j12_catalogue_lines",
    f"""with {_SQL}, u as (select page, place, trim(regexp_replace(replace(replace(trim(text), '|', 'l'), '㎖', 'ml'), '\\s+', ' ', 'g')) as text, score, x1, (y1 + y2) / 2.0 as cy from lines where trim(text) <> '' and score >= 0.45),
    p as (select page, place, cast(replace(replace(text, ' ', ''), ',', '') as bigint) as price, score, cy from u where x1 >= 750 and regexp_matches(replace(text, ' ', ''), '^\\d{{1,3}}(?:,\\d{{3}})*$')),
    q as (select * from p where price between 100 and 10000000),
    r as (select q.page, q.place, q.price, q.score as ps, list(u.text order by u.x1, u.place) as texts, list(u.score order by u.x1, u.place) as scores
      from q join u on u.page = q.page and u.x1 < 760 and abs(u.cy - q.cy) <= 52 and u.text not in ('검색', '초기화') group by all),
    c as (select q.page, q.place, first(u.text order by abs(q.cy + 78 - u.cy), u.x1, u.place) as category, first(u.score order by abs(q.cy + 78 - u.cy), u.x1, u.place) as cs
      from q join u on u.page = q.page and u.x1 < 420 and u.cy - q.cy between 42 and 118 and length(u.text) <= 16 group by all),
    n as (select r.*, c.category, c.cs, array_to_string(texts, ' ') as raw, '(?i)^(.*?)(?:\\s+|^)(\\d+(?:\\.\\d+)?\\s*(?:mg|g|kg|ml|l|정|캡슐|연질캡슐|포|병|개|매|EA|T|C|정제|캅셀|롤|스틱|박스|통|세트|입))$' as pat from r left join c using (page, place)),
    m as (select *, trim(regexp_extract(raw, pat, 1)) as before, regexp_extract(raw, pat, 2) as size, len(scores) + 1 + cast(cs is not null as int) as n from n)
    select page, place, price, case when size = '' or before = '' then raw else before end as name, size as specification, coalesce(category, '미분류') as category,
    round_even((ps + list_sum(scores) + coalesce(cs, 0)) / n, 4) as confidence, cast(n as int) as n_lines from m
    where length(regexp_replace(lower(case when size = '' or before = '' then raw else before end), '[^0-9a-z가-힣]', '', 'g')) >= 2 and regexp_matches(case when size = '' or before = '' then raw else before end, '[A-Za-z가-힣]')""",
)
def catalogue(spark, sf_dir):
    return catalogue_lines(_lines(spark, sf_dir), ["page"], "place")
