"""Registry records on the catalogue, search matching, gates and reports (S-10 to S-13, J-01, J-04, E-03 to E-06, M-07, V-06, V-07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.functions.deep import FORMS, best_ratio, deep_scored, forms_conflict, text_facts
from prodlake.functions.names import judged, variants
from prodlake.operators import official as O
from prodlake.operators.resolve import deep_choice, each_kind_once, search_choice
from prodlake.plans.registry import query
from prodlake.session import CATALOG_SQL, catalog, spread, table

SOURCE = O.Source("parts", "d1", "drug", "https://api.example.org/items", "item_seq", ("ITEM_SEQ", "item_seq"), ("ITEM_NAME", "item_name"), ("ENTP_NAME",), ("PACK_UNIT",), (), ("BIG_IMG",))


def _records(spark, sf_dir):
    part = table(spark, sf_dir, "part").where("p_size > 15")  # smaller ones are not registered
    item = F.create_map(
        *[F.lit("ITEM_SEQ"), F.col("p_partkey").cast("string"), F.lit("item_name"), F.concat(F.lit(" "), F.col("p_name"))],
        *[F.lit("ENTP_NAME"), F.col("p_brand"), F.lit("EE_DOC_DATA"), F.concat(F.lit("<p>"), F.col("p_type"), F.lit("</p>"))],
        *[F.lit("UD_DOC_DATA"), F.when(F.col("p_size") % 2 == 0, "twice").otherwise(" "), F.lit("INTAKE_HINT1"), F.lit("none")],
    )
    return O.parse_records(part.select(item.alias("item")), SOURCE, "2024-01-01T00:00:00+00:00")


def _materialised(spark, sf_dir):
    products = catalog(spark, sf_dir)
    matches = products.where("pos % 2 = 0").select(
        "id", F.when(F.col("pos") % 4 == 0, "confirmed").otherwise("review_required").alias("match_status"), F.col("official_match_score").alias("match_score"), F.concat(F.lit("drug:"), "id").alias("official_product_key")
    )
    return O.materialise(products, matches, _records(spark, sf_dir))


_RECORD = "p_size > 15"
_MATERIALISED = f"""(select c.id, case when pos % 4 = 0 then 'confirmed' when pos % 2 = 0 then 'review_required' end as match_status, case when pos % 2 = 0 then official_match_score end as match_score,
    case when pos % 4 = 0 and p.p_size > 15 then trim(name) end as official_item_name, image_url, image_rights_status,
    case when pos % 2 = 1 then 'pending' when pos % 4 <> 0 then 'review_required' when p.p_size <= 15 then 'error' when p.p_size % 2 = 0 then 'complete' else 'partial' end as enrichment_status
    from {CATALOG_SQL} c join part p on p.p_partkey = c.pos)"""


@query(
    "s13_official_records",
    f"""select 'drug:' || p_partkey as official_product_key, trim(p_name) as item_name, p_brand as manufacturer, cast(p_partkey as varchar) as item_seq, p_type as efficacy,
    case when p_size % 2 = 0 then 'twice' else '' end as dosage, 'https://api.example.org/items?item_seq=' || p_partkey as source_url from part where {_RECORD}""",
)
def official_records(spark, sf_dir):
    return _records(spark, sf_dir).select("official_product_key", "item_name", "manufacturer", "item_seq", "efficacy", "dosage", "source_url")


@query("m07_content_status", f"select 'drug:' || p_partkey as official_product_key, case when p_size % 2 = 0 then 'complete' else 'partial' end as status from part where {_RECORD}")
def content_status(spark, sf_dir):
    return _records(spark, sf_dir).select("official_product_key", O.completeness().alias("status"))


@query("j01_materialised", f"select id, match_status, official_item_name, enrichment_status, case when match_status is null then 'pending' else 'found' end as lookup_status from {_MATERIALISED}")
def materialised(spark, sf_dir):
    return _materialised(spark, sf_dir).select("id", "match_status", "official_item_name", "enrichment_status", "lookup_status")


@query(
    "v06_status_audit",
    f"""with m as (select * from {_MATERIALISED}) select id, 'confirmed_without_record' as code from m where match_status = 'confirmed' and enrichment_status = 'error'
    union all select id, 'confirmed_missing_name' from m where match_status = 'confirmed' and coalesce(official_item_name, '') = ''""",
)
def status_audit(spark, sf_dir):
    return O.audit(_materialised(spark, sf_dir))


@query(
    "a09_enrichment_summary",
    f"""select count(*) as products, count(*) filter (coalesce(official_item_name, '') = '') as identity_missing, count(*) filter (image_url = '') as image_missing,
    count(*) filter (image_rights_status in ('', 'unverified')) as rights_unconfirmed, count(*) filter (match_status = 'confirmed') as confirmed,
    round_even(100 * count(*) filter (match_status = 'confirmed') / count(*), 1) as confirmed_percent from {_MATERIALISED}""",
)
def enrichment_summary(spark, sf_dir):
    return O.enrichment_summary(_materialised(spark, sf_dir))


_EVIDENCE = f"""(select id, case when pos % 7 = 0 then '//health.kr/pack/shared.png' when pos % 5 = 0 then 'http://x.example.org/a.png' else 'https://health.kr/pack/' || id || '.png' end as url,
    pos % 2 = 0 as manual_verified from {CATALOG_SQL} where pos % 3 <> 1)"""


@query(
    "j04_image_links",
    f"""with e as (select id, case when starts_with(url, '//') then 'https:' || url when starts_with(url, 'https://') then url else '' end as url, manual_verified from {_EVIDENCE}),
    u as (select url, count(*) as uses from e where manual_verified and url <> '' group by 1), c as (select * from {CATALOG_SQL})
    select c.id, case when e.id is null then 'no_record' when c.image_url <> '' then 'already_has_image' when e.manual_verified and e.url <> '' and u.uses = 1 then 'linked' else 'not_linked' end as image_link
    from c left join e on e.id = c.id left join u on u.url = e.url""",
)
def image_links(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    pos = F.col("pos")
    url = F.when(pos % 7 == 0, "//health.kr/pack/shared.png").when(pos % 5 == 0, "http://x.example.org/a.png").otherwise(F.concat(F.lit("https://health.kr/pack/"), "id", F.lit(".png")))
    evidence = rows.where("pos % 3 <> 1").select(
        "id", url.alias("image_url"), F.lit("https://health.kr/p").alias("source_url"), F.lit("confirmed").alias("status"), (pos % 2 == 0).alias("manual_verified"), F.lit(True).alias("visual_verified")
    )
    return O.link_images(rows.select("id", "image_url", "image_rights_status"), evidence).select("id", "image_link")


@query(
    "v07_protected_changes",
    "select c_custkey, 'c_mktsegment' as field from customer where c_custkey % 17 = 0 union all select c_custkey, 'c_name' from customer where c_custkey % 29 = 0",
)
def protected_changes(spark, sf_dir):
    before = table(spark, sf_dir, "customer")
    after = before.withColumns(
        {
            "c_mktsegment": F.when(F.col("c_custkey") % 17 == 0, "OTHER").otherwise(F.col("c_mktsegment")),
            "c_name": F.when(F.col("c_custkey") % 29 == 0, "").otherwise(F.col("c_name")),
            "c_acctbal": F.col("c_acctbal") + 1,
        }
    )
    return O.protected_changes(before, after, "c_custkey", before.columns, ["c_acctbal"])


@query("t21_guidance", "select c_custkey, '효능·효과' || chr(10) || c_mktsegment || case when c_acctbal > 0 then chr(10) || chr(10) || '보관 방법' || chr(10) || c_name else '' end as text from customer")
def guidance(spark, sf_dir):
    kept = F.when(F.col("c_acctbal") > 0, F.concat(F.col("c_name"), F.lit(" \r\n"))).otherwise(" ")
    made = F.create_map(F.lit("storage"), kept, F.lit("efficacy"), F.concat(F.lit(" "), F.col("c_mktsegment")), F.lit("other"), F.lit("x"))
    return table(spark, sf_dir, "customer").select("c_custkey", O.guidance_text(made).alias("text"))


@query("u07_labelled", "select p_partkey, p_name || case when p_size % 2 = 0 then '' else '/' || p_brand end as texts from part")
def labelled(spark, sf_dir):
    second = F.when(F.col("p_size") % 2 == 0, F.split_part("p_name", F.lit(" "), F.lit(2))).otherwise(F.col("p_brand"))
    items = F.array(*[F.struct(F.lit(n).alias("label"), t.alias("text")) for n, t in (("a", F.col("p_name")), ("b", second), ("c", F.concat("p_name", F.lit(" "))), ("d", F.lit(" ")))])
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(O.dedupe_labelled(items), lambda i: i["text"]), "/").alias("texts"))


@query("e04_e06_safe_search")
def safe_search(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    items = part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))
    found = part.select(F.col("p_name").alias("code")).distinct().withColumn("block", F.explode(variants(F.col("code"))))

    def decide(kinds):
        pairs = kinds.withColumn("block", F.explode(variants(F.col("name")))).join(found, "block").select("item_id", "name", "code").distinct()
        return search_choice(judged(pairs, "name", "code").select("item_id", "code", F.col("validated").alias("score"), "safe"))

    return each_kind_once(items, ["name"], decide)


def _deep_decided(spark, sf_dir, decide):
    """What `decide` says of the pairs of `_deep_pairs`, for every part."""
    part = table(spark, sf_dir, "part")
    items = part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.concat("p_size", F.lit("정")).alias("capacity"), F.col("p_brand").alias("brand"))
    return each_kind_once(items, ["name", "capacity", "brand"], lambda kinds: decide(_deep_pairs(kinds, part)))


def _deep_pairs(items, part):
    """Pairs of a brand and second word, each product with a page that states its pack."""
    word = lambda c: F.split_part(F.col(c), F.lit(" "), F.lit(2))
    products = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").cast("string").alias("code"), F.min("p_size").alias("size"))
    found = products.select("code", F.col("p_name").alias("drug_name"), F.concat("size", F.lit("정")).alias("box"), F.col("p_brand").alias("upso"))
    pairs = items.join(found, (F.col("brand") == F.col("upso")) & (word("name") == word("drug_name")))
    product = F.create_map(F.lit("drug_name"), F.col("drug_name"), F.lit("drug_code"), F.col("code"), F.lit("upso_name_kfda"), F.col("upso"))
    page = F.create_map(F.lit("drug_name"), F.col("drug_name"), F.lit("drug_box"), F.col("box"))
    return pairs.withColumns({"specification": F.lit(""), "known_code": F.lit(""), "product": product, "page": page})


def _longest(pairs):
    """A stand-in for the largest ratio that SQL has too: that of the lengths."""
    ratios = F.transform(pairs, lambda p: F.least(F.length(p["a"]), F.length(p["b"])) / F.greatest(F.length(p["a"]), F.length(p["b"])))
    return F.array_max(ratios)


_DEEP = """i as (select p_partkey as item_id, p_name, p_brand, p_size, replace(p_name, ' ', '') as a from part), reg as (select min(p_partkey) as code, p_name as drug_name, p_brand, min(p_size) as size, replace(p_name, ' ', '') as b from part group by p_name, p_brand),
    j as (select *, i.p_name = drug_name as same, a <> b and (contains(a, b) or contains(b, a)) as held, least(length(a), length(b)) / greatest(length(a), length(b)) as ratio, p_size = size as packs
      from i join reg on i.p_brand = reg.p_brand and split_part(i.p_name, ' ', 2) = split_part(reg.drug_name, ' ', 2)),
    s as (select item_id, cast(code as varchar) as code, same, held, ratio, packs,
      cast(greatest(0, least(100, case when same then 94 when held then least(92, 82 + floor(10 * ratio)) - 35 else floor(78 * ratio) end + case when packs then 3 else 0 end)) as int) as score from j)"""


@query(
    "e07_deep_scores_lengths",
    f"""with {_DEEP} select item_id, code, score, case when same then 'core names agree;' when held then 'core name contained;' when ratio >= 0.72 then 'core names alike;' else '' end
    || case when packs then 'packs agree;' else 'sold and licensed packs differ;' end || 'manufacturer stated' as reasons, cast(held as int) as n_conflicts from s""",
)
def deep_scores_lengths(spark, sf_dir):
    """The rules with a stand-in for the similarity."""
    told = ["item_id", "code", "score", F.array_join("reasons", ";").alias("reasons"), F.size("conflicts").alias("n_conflicts")]
    return _deep_decided(spark, sf_dir, lambda pairs: deep_scored(pairs, _longest).select(*told))


@query(
    "e08_deep_choice_lengths",
    f"""with {_DEEP}, r as (select *, row_number() over w as rn, score - coalesce(lead(score) over w, 0) as margin from s window w as (partition by item_id order by score desc, code))
    select item_id, case when score >= 84 and (margin >= 6 or same) and not held then 'confirmed' when score >= 45 then 'review_required' else 'not_found' end as status,
    case when score >= 84 and (margin >= 6 or same) and not held then code end as code, score from r where rn = 1""",
)
def deep_choice_lengths(spark, sf_dir):
    return _deep_choice(spark, sf_dir, _longest)


def _deep_choice(spark, sf_dir, ratio=best_ratio):
    told = ["item_id", "code", "score", F.size("conflicts").alias("n_conflicts"), F.lit(True).alias("detailed"), (F.col("name") == F.col("drug_name")).alias("contained"), F.lit(False).alias("known"), F.lit(False).alias("non_drug")]
    return _deep_decided(spark, sf_dir, lambda pairs: deep_choice(deep_scored(pairs, ratio).select(*told)).drop("alternatives"))


@query("e07_e08_deep_choice")
def deep_decisions(spark, sf_dir):
    return _deep_choice(spark, sf_dir)


_FORM_ROWS = """(values ('tablet', '정 정제 장용정 서방정 츄어블 츄어블정 구강붕해정 현탁정'), ('capsule', '캡슐 경질캡슐 연질캡슐 서방캡슐'),
    ('liquid', '액 액제 시럽 시럽제 현탁액 내복액 외용액 엘릭서 드링크'), ('ointment', '연고 안연고'), ('cream', '크림'), ('gel', '겔 겔제 젤 젤제'), ('ophthalmic', '점안액 점안제 점비액 안겔 안연고'),
    ('powder', '산 산제 과립 과립제 엑스과립 현탁용분말'), ('spray', '스프레이 나잘스프레이 인후스프레이 비강분무액 분무 에어로솔 폼'), ('patch', '패취 패치 플라스타 카타플라스마'),
    ('suppository', '좌제'), ('pill', '환 환제'), ('film', '구강용해필름 필름')) as t(form, words)"""
_STEM = "translate(cast(p_partkey as string), '0123456789', '가나다라마바사아자차')"


@query(
    "d03_d04_t10_form_groups",
    f"""with f as (select form, unnest(string_split(words, ' ')) as word from {_FORM_ROWS}),
    o as (select word, row_number() over (order by word) - 1 as n from (select distinct word from f)),
    w as (select string_agg(word, '|' order by length(word) desc, word) filter (length(word) > 1) as long, string_agg(word, '|' order by word) filter (length(word) = 1) as short, count(*) as n from o),
    i as (select p_partkey, {_STEM} || a.word || case p_partkey % 3 when 0 then '' when 1 then '에스' else '골드' end as name, {_STEM} || b.word as other
      from part, w join o a on a.n = p_partkey % w.n join o b on b.n = (p_partkey // 7) % w.n),
    g as (select p_partkey, name, other, (select max_by(form, (length(word), form)) from f where case when length(word) = 1 then ends_with(name, word) else contains(name, word) end) as form,
      (select max_by(form, (length(word), form)) from f where case when length(word) = 1 then ends_with(other, word) else contains(other, word) end) as other_form from i)
    select p_partkey, name, coalesce(form, '') as form, coalesce(other_form, '') as other_form,
    regexp_replace(regexp_replace(name, long, '', 'g'), '(?:' || short || ')$', '') as brand,
    form is not null and other_form is not null and form <> other_form and not (least(form, other_form) = 'liquid' and greatest(form, other_form) = 'ophthalmic' and contains(name, '점안'))
      and not (least(form, other_form) = 'ointment' and greatest(form, other_form) = 'ophthalmic' and contains(other, '안연고')) as conflict
    from g, w""",
)
def form_groups(spark, sf_dir):
    """Names that carry every form word, at their end and before another word, beside products of every form."""
    words = sorted({w for group in FORMS.values() for w in group})
    pick = lambda n: F.element_at(F.array(*[F.lit(w) for w in words]), (n % len(words) + 1).cast("int"))
    stem, key = F.expr(_STEM), F.col("p_partkey")
    ending = F.when(key % 3 == 0, "").when(key % 3 == 1, "에스").otherwise("골드")
    names = spread(table(spark, sf_dir, "part").select("p_partkey")).select("p_partkey", F.concat(stem, pick(key), ending).alias("name"), F.concat(stem, pick(F.floor(key / 7))).alias("other"))
    asked = ("spelled", "brands", "form")
    mine = text_facts(names, "name", asked).withColumnRenamed("facts", "m")
    both = text_facts(mine, "other", asked).withColumnRenamed("facts", "t")
    return both.select(
        "p_partkey", "name", F.col("m.form").alias("form"), F.col("t.form").alias("other_form"), F.array_join("m.brands", ",").alias("brand"), forms_conflict(F.col("m.form"), F.col("m.spelled"), F.col("t.form"), F.col("t.spelled")).alias("conflict")
    )

