"""Page scans and JSON walks (S-14 to S-17, X-03, M-06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.plans.registry import query
from prodlake.session import table
from prodlake.sources import markup as M


@query(
    "s16_page_scan",
    # as in HTML, the semicolon of these references may be left out; `&amp` comes last, so that nothing is decoded twice
    r"""with t as (select page_id, coalesce(html, '') as html, regexp_extract(coalesce(html, ''), '(?s)<title>(.*?)</title>', 1) as raw from pages)
    select page_id, cast((length(html) - length(replace(html, '<a ', ''))) / 3 as int) as n_links,
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) as title from t""",
)
def page_scan(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", M.page("html").alias("p")).select("page_id", F.size("p.links").alias("n_links"), "p.title")


@query(
    "x03_walk_texts",
    """select c_custkey, '$.name' as path, c_name as value from customer union all select c_custkey, '$.in.segment', c_mktsegment from customer
    union all select c_custkey, '$.in.list[1]', c_name from customer""",
)
def walk(spark, sf_dir):
    tree = F.to_json(
        F.struct(
            F.col("c_name").alias("name"),
            F.col("c_custkey").alias("number"),
            F.struct(F.col("c_mktsegment").alias("segment"), F.array(F.lit(None).cast("string"), F.col("c_name")).alias("list"), F.lit("http://x").alias("url")).alias("in"),
        )
    )
    return M.walk_texts(table(spark, sf_dir, "customer"), "c_custkey", tree, ("url",))


@query(
    "s15_embedded_json",
    "select event_id, '{\"k\":' || (props ->> '$.k') || '}' as found from events",
)
def embedded(spark, sf_dir):
    text = F.concat(F.lit("<script>var data = "), "props", F.lit("; more {"))
    return table(spark, sf_dir, "events").select("event_id", M.embedded_json("var data")(text).alias("found"))


@query("s14_result_rows", "select p_partkey, 1 as row, p_name || '|' || p_brand as cells from part")
def result_rows(spark, sf_dir):
    html = F.concat(F.lit("<table><tr><th>Name</th></tr><tr><td><b>"), "p_name", F.lit("</b></td><td> "), "p_brand", F.lit("</table>"))
    rows = M.result_rows(table(spark, sf_dir, "part").select("p_partkey", html.alias("html")), "p_partkey", "html", 2)
    return rows.select("p_partkey", "row", F.array_join("cells", "|").alias("cells"))


@query(
    "m06_ordered_images",
    "select p_partkey, 'package:' || p_brand || ',pill:' || p_name || case when p_size % 2 = 0 then '' else ',x:' || p_type end as images from part",
)
def ordered_images(spark, sf_dir):
    image = lambda kind, url: F.struct(F.lit(kind).alias("kind"), url.alias("url"))
    last = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.col("p_type"))
    images = F.array(image("x", last), image("pill", F.col("p_name")), image("package", F.col("p_brand")), image("pill", F.col("p_brand")))
    ordered = M.ordered_images(images)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(ordered, lambda i: F.concat(i["kind"], F.lit(":"), i["url"])), ",").alias("images"))
