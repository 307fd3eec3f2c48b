"""Scalar functions over the text tables (T, D, N, R, H, X, S)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.functions import text as X
from prodlake.functions.rich_text import rich_text
from prodlake.functions.similarity import canonical_json, indel_ratio, matching_blocks_ratio, nfc, unescape
from prodlake.plans.registry import query
from prodlake.session import table

_COMPACT = "regexp_replace(lower({0}), '[^0-9a-z가-힣]+', '', 'g')"


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _compact(x: str) -> str:
    return _COMPACT.format(x)


@query("t01_compact", f"select doc_id, sha256({_compact("coalesce(text, '')")}) as h from documents")
def compact(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2(X.compact(F.col("text")), 256).alias("h"))


@query(
    "t02_company",
    "select s_suppkey, " + _compact("replace(replace(replace(replace(replace(s_name || '(주) 주식회사', '주식회사', ''), '(주)', ''), '㈜', ''), '유한회사', ''), '제약회사', '')") + " as name from supplier",
)
def company(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", X.company(F.concat("s_name", F.lit("(주) 주식회사"))).alias("name"))


@query(
    "t03_t05_parentheses",
    "select p_partkey, "
    + _compact("regexp_replace(p_name || '(기획 ' || p_size || ')(' || p_brand || ')', '\\((?:증정|기획|리뉴얼|색상|파랑|빨강)[^)]*\\)', '', 'g')")
    + " as registry, "
    + _compact("regexp_replace(p_name || '(기획 ' || p_size || ')(' || p_brand || ')', '\\([^)]*\\)', '', 'g')")
    + " as plain, "
    + _compact("p_name || '(기획 ' || p_size || ')(' || p_brand || ')'")
    + " as whole from part",
)
def parentheses(spark, sf_dir):
    name = F.concat("p_name", F.lit("(기획 "), "p_size", F.lit(")("), "p_brand", F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", X.registry_name(name).alias("registry"), X.plain_name(name).alias("plain"), X.full_name(name).alias("whole"))


@query(
    "t04_capacity",
    "select p_partkey, " + _compact("replace(replace(replace(lower(p_size || case p_size % 3 when 0 then ' 캡슐' when 1 then ' 정' else ' 포' end), '캡슐', 'cap'), '정', 'tab'), '포', 'sachet')") + " as capacity from part",
)
def capacity(spark, sf_dir):
    unit = F.when(F.col("p_size") % 3 == 0, " 캡슐").when(F.col("p_size") % 3 == 1, " 정").otherwise(" 포")
    return table(spark, sf_dir, "part").select("p_partkey", X.capacity(F.concat("p_size", unit)).alias("capacity"))


@query(
    "t08_listing_name",
    "select page_id, sha256("
    + _compact("regexp_replace(regexp_replace(lower(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g')), '소비기한\\s*\\d+(?:[/.-]\\d+)+', ' ', 'g'), '\\b\\d+\\s*(?:개|세트|박스|병|통)', ' ', 'g')")
    + ") as h from pages",
)
def listing_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(X.listing_name(F.col("html")), 256).alias("h"))


@query(
    "t11_search_name",
    "select p_partkey, trim(regexp_replace(p_name || ' ' || p_size || 'mg', '\\s*\\d+(?:\\.\\d+)?\\s*(?:mg|g|ml|ea|정|캡슐|포|병|개)?\\s*$', '')) as name from part",
)
def search_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.search_name(F.concat("p_name", F.lit(" "), "p_size", F.lit("mg"))).alias("name"))


@query("t12_split_size", "select p_partkey, p_name as name, case when p_size % 2 = 0 then p_size || ' ml' else '' end as size from part")
def split_size(spark, sf_dir):
    label = F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit("  "), "p_size", F.lit(" ml "))).otherwise(F.concat("p_name", F.lit(" ")))
    return table(spark, sf_dir, "part").select("p_partkey", X.split_size(label).alias("s")).select("p_partkey", "s.name", "s.size")


@query(
    "t13_display_text",
    """select doc_id, sha256(nfc_normalize(regexp_replace(regexp_replace(translate(regexp_replace(coalesce(text, ''), '[\\x{200b}-\\x{200f}\\x{2060}\\x{feff}]', '', 'g'), chr(160) || chr(12288), '  '), '[ \\t]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'))) as h
    from documents""",
)
def display_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2(nfc(X.display_text(F.col("text"))), 256).alias("h"))


@query(
    "t14_clean_text",
    "select page_id, sha256(trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) as h from pages",
)
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(X.clean_text(F.col("html")), 256).alias("h"))


@query("t14_unescaped_length")
def unescaped_length(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.length(unescape(X.clean_text(F.col("html")))).alias("n"))


@query("t16_rich_text")
def rich(spark, sf_dir):
    parsed = table(spark, sf_dir, "pages").select("page_id", rich_text("html").alias("r"))
    tables = F.size(F.filter("r.blocks", lambda b: b["type"] == "table"))
    return parsed.select("page_id", F.length("r.text").alias("n_chars"), F.size("r.blocks").alias("n_blocks"), tables.alias("n_tables"))


@query(
    "t23_parts",
    "select doc_id, len(list_distinct(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(160))), lambda x: x <> ''))) as n_lines from documents",
)
def parts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.size(X.parts(F.col("text"), "\n")).cast("long").alias("n_lines"))


@query("t24_part", "select o_orderkey, split_part(o_orderpriority, '-', 1) as level, split_part(o_orderpriority, '-', 2) as name, '' as other from orders")
def part_at(spark, sf_dir):
    at = lambda k: X.part(F.col("o_orderpriority"), "-", k)
    return table(spark, sf_dir, "orders").select("o_orderkey", at(0).alias("level"), at(1).alias("name"), at(2).alias("other"))


@query("t26_matching_blocks")
def matching_blocks(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    a, b = names.select(F.col("p_name").alias("a")), names.select(F.col("p_name").alias("b"))
    word = lambda c: F.split_part(F.col(c), F.lit(" "), F.lit(2))
    return a.join(b, (word("a") == word("b")) & (F.col("a") < F.col("b"))).select("a", "b", F.round(matching_blocks_ratio("a", "b"), 6).alias("ratio"))


@query("t27_indel")
def indel(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    a, b = names.select(F.col("p_name").alias("a")), names.select(F.col("p_name").alias("b"))
    word = lambda c: F.split_part(F.col(c), F.lit(" "), F.lit(2))
    return a.join(b, (word("a") == word("b")) & (F.col("a") < F.col("b"))).select("a", "b", F.round(indel_ratio("a", "b"), 6).alias("ratio"))


_STRENGTH = "p_name || ' ' || p_size || ' mg / ' || p_size * 2 || '밀리그램 ' || p_size || '.5%'"


@query(
    "d05_strengths",
    "select p_partkey, array_to_string(list_sort([p_size || 'mg', (p_size * 2) || 'mg', p_size || '.5%']), ',') as found from part",
)
def strengths(spark, sf_dir):
    label = F.concat("p_name", F.lit(" "), "p_size", F.lit(" mg / "), F.col("p_size") * 2, F.lit("밀리그램 "), "p_size", F.lit(".5%"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(X.strengths(label), ",").alias("found"))


@query("d06_pack_count", "select p_partkey, case when p_size % 2 = 0 then p_size end as n from part")
def pack_count(spark, sf_dir):
    label = F.concat("p_name", F.lit(" "), "p_size", F.when(F.col("p_size") % 2 == 0, " 캡슐").otherwise(" mm"))
    return table(spark, sf_dir, "part").select("p_partkey", X.pack_count(label).alias("n"))


@query("d01_d07_forms", "select p_partkey, case p_size % 3 when 0 then '연질캡슐' when 1 then '정' else '' end as form, lower(replace(p_brand, '#', '')) as inner from part")
def forms(spark, sf_dir):
    form = F.when(F.col("p_size") % 3 == 0, " 연질 캡슐").when(F.col("p_size") % 3 == 1, " 정").otherwise("")
    label = F.concat("p_name", form, F.lit("("), "p_brand", F.lit(")(30정)"))
    return table(spark, sf_dir, "part").select("p_partkey", X.dosage_form(F.concat("p_name", form)).alias("form"), F.array_join(X.parentheticals(label), ",").alias("inner"))


@query("d10_map_text", "select o_custkey, string_agg(o_orderstatus || '=' || n, ', ' order by o_orderstatus) as counts from (select o_custkey, o_orderstatus, count(*) as n from orders group by all) group by 1")
def map_text(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    maps = counts.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("m"))
    return maps.select("o_custkey", X.map_text(F.col("m")).alias("counts"))


@query("n01_digits_price", "select o_orderkey, coalesce(try_cast(regexp_replace(o_orderpriority || ' ' || o_orderkey, '[^0-9]', '', 'g') as bigint), 0) as n from orders")
def digits_price(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", X.digits_price(F.concat("o_orderpriority", F.lit(" "), "o_orderkey")).alias("n"))


@query("n04_positive_int", "select event_id, case when cast(props ->> '$.k' as int) > 0 then cast(props ->> '$.k' as int) else 7 end as k from events")
def positive_int(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", X.positive_int(F.get_json_object("props", "$.k"), 7).alias("k"))


@query("r01_page_hosts", "select page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) as host, starts_with(url, 'https') as secure from pages")
def page_hosts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.host(F.col("url")).alias("host"), F.startswith("url", F.lit("https")).alias("secure"))


@query("r02_r04_urls", "select s_suppkey, 'https://api.example.org/' || s_suppkey as url, 'https://api.example.org/items?key=Supplier%23' || right(s_name, 9) as source from supplier")
def urls(spark, sf_dir):
    raw = F.concat(F.when(F.col("s_suppkey") % 2 == 0, "http:").otherwise(""), F.lit("//api.example.org/"), "s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", X.official_url(raw, ("api.example.org",)).alias("url"), X.source_url("https://api.example.org/items", "key", F.col("s_name")).alias("source")
    )


@query("h01_row_hash", "select c_custkey, sha256(concat_ws(chr(31), c_custkey, c_name, c_nationkey, c_mktsegment)) as h from customer")
def row_hash(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.row_hash(*[F.col(c) for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")]).alias("h"))


@query("h01_canonical_json", "select event_id, sha256(replace(props, ' ', '')) as h from events")
def canonical(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.sha2(canonical_json("props"), 256).alias("h"))


@query("x01_first_text", "select c_custkey, case when c_acctbal > 5000 then c_mktsegment else c_name end as label from customer")
def first_text(spark, sf_dir):
    rich_only = F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).otherwise("  ")
    return table(spark, sf_dir, "customer").select("c_custkey", X.first_text(rich_only, F.col("c_name")).alias("label"))


@query("x02_json_path", "select cast(props ->> '$.k' as bigint) as k, count(*) as n from events group by 1")
def json_path(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count("*").alias("n"))
