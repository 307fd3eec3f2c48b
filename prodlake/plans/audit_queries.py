"""Audits, contracts and entity resolution (F-15 to F-21, V, A-10 to A-12, E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.functions import names as N
from prodlake.functions.similarity import matching_blocks_ratio
from prodlake.functions.text import company, registry_name
from prodlake.operators import audit as A
from prodlake.operators import resolve as E
from prodlake.plans.registry import ORACLE_SQL, query
from prodlake.session import CATALOG_SQL, catalog, table

_PATTERNS = {
    "email": "(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}",
    "residual_html": "</?[A-Za-z][^>]*>",
    "literal_null": "(?i)\\b(?:undefined|null|nan)\\b",
    "numeric_range": "\\d\\s*\\?\\s*\\d",
    "shouting": "[A-Z]{4,}!!",
}


@query(
    "f15_f21_text_findings",
    " union all ".join(f"select doc_id, '{k}' as code from documents where regexp_matches(coalesce(text, ''), '{p}')" for k, p in _PATTERNS.items()),
)
def text_findings(spark, sf_dir):
    return A.findings(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", A.text_rules(F.col("text"), _PATTERNS))


@query(
    "a10_finding_counts",
    "select code, count(*) as n from ("
    + " union all ".join(f"select doc_id, '{k}' as code from documents where regexp_matches(coalesce(text, ''), '{p}')" for k, p in _PATTERNS.items())
    + ") group by 1",
)
def finding_counts(spark, sf_dir):
    return text_findings(spark, sf_dir).groupBy("code").agg(F.count("*").alias("n"))


@query("f15_personal_data")
def personal_data(spark, sf_dir):
    """With look-around, which the oracle's patterns lack."""
    return A.findings(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", A.text_rules(F.col("text")))


@query("f16_notifications", "select doc_id from documents where regexp_matches(concat_ws(' ', coalesce(text, ''), source), '메시지가 도착|카카오톡|새 메시지|님에게 메시지를 보냈|src3')")
def notifications(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(A.is_notification(F.col("text"), F.col("source")) | F.col("source").contains("src3")).select("doc_id")


@query(
    "v01_catalog_rules",
    f"""with c as {CATALOG_SQL} select document_id, 'empty_category' as code from c where trim(category) = '' union all select document_id, 'price_not_positive' from c where not coalesce(price, 0) > 0
    union all select document_id, 'bad_date' from c where length(regexp_replace(updated, '[^0-9]', '', 'g')) < 8""",
)
def catalog_rules(spark, sf_dir):
    from prodlake.functions.text import comparable_date

    return A.findings(catalog(spark, sf_dir), "document_id", A.catalog_rules() | {"bad_date": comparable_date(F.col("updated")) == ""})


@query("v01_u05_repeated_names", "select p_name, count(*) as n from part group by 1 having count(*) > 1")
def repeated_names(spark, sf_dir):
    return A.repeated_keys(table(spark, sf_dir, "part").select("p_name"), "p_name")


@query("a12_field_widths", "select cast(1 + cast(text is not null as int) + cast(lang is not null as int) + cast(quality is not null as int) as int) as width, count(*) as n from documents left join labels using (doc_id) where doc_id is not null group by 1")
def field_widths(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").where("doc_id is not null").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return A.field_widths(joined.select("doc_id", "text", "lang", "quality"))


@query(
    "w10_position_errors",
    """select * from (select conv_id as "group", turn, cast(row_number() over (partition by conv_id order by turn) - 1 as int) as place from conversations) where place <> turn""",
)
def position_errors(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("group"), "turn")
    return A.position_errors(turns, "turn", "turn")


@query(
    "v09_field_hashes",
    f"""with c as {CATALOG_SQL}, f as (select document_id, 'name' as field, name as value from c union all select document_id, 'category', category from c union all select document_id, 'etc', etc from c)
    select document_id, field, sha256(value) as value_sha256, case when trim(value) <> '' then 'applicable' else 'not_applicable' end as applicability from f""",
)
def field_hashes(spark, sf_dir):
    return A.field_hashes(catalog(spark, sf_dir), "document_id", ["name", "category", "etc"])


@query(
    "v10_review_errors",
    f"""with c as (select * from {CATALOG_SQL}), f as (select pos, document_id, 'name' as field, name as v from c union all select pos, document_id, 'category', category from c),
    l as (select pos, document_id, field, case when pos % 7 = 0 then 'x' else sha256(v) end as h, case pos % 4 when 0 then 'pending' when 1 then 'approved' when 2 then 'corrected' else 'done' end as decision,
    case when pos % 3 = 0 then 0 else 1 end as evidence, v from f where pos % 13 <> 0 or field <> 'category')
    select f.document_id, f.field, 'missing_field' as code from f left join l using (document_id, field) where l.document_id is null
    union all select document_id, field, 'stale_hash' from l where h <> sha256(v) union all select document_id, field, 'unknown_decision' from l where decision = 'done'
    union all select document_id, field, 'no_evidence' from l where decision <> 'pending' and evidence = 0
    union all select document_id, field, 'applies_wrongly' from l where decision = 'approved' and trim(v) = ''""",
)
def review_errors(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    scaffold = A.field_hashes(rows, "document_id", ["name", "category"])
    pos = F.col("pos")
    ledger = scaffold.join(rows.select("document_id", "pos"), "document_id").where((pos % 13 != 0) | (F.col("field") != "category"))
    ledger = ledger.select(
        "document_id",
        "field",
        F.when(pos % 7 == 0, "x").otherwise(F.col("value_sha256")).alias("value_sha256"),
        F.when(pos % 4 == 0, "pending").when(pos % 4 == 1, "approved").when(pos % 4 == 2, "corrected").otherwise("done").alias("decision"),
        F.when(pos % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("e1"))).alias("evidence"),
        F.lit("someone").alias("reviewer"),
    )
    return A.review_errors(ledger, scaffold, "document_id")


_FIELD_CODES = ("stale_hash", "wrong_applicability", "unknown_decision", "unknown_evidence", "decision_without_evidence", "no_provenance", "unknown_field", "missing_field")
_RECORD_CODES = ("record_out_of_order", "unknown_pass", "unknown_final", "pending_final", "repeated_record", "missing_record")
_CORRECTION_CODES = ("repeated_correction", "correction_not_marked", "correction_of_other_value", "correction_without_change", "correction_without_opened_evidence", "marked_without_correction", "correction_of_unknown_field")


@query(
    "v10_ledger_errors",
    f"""with f as (select * from (values {", ".join(f"({k}, '{c}')" for k, c in enumerate(_FIELD_CODES))}) as t(k, code)), r as (select * from (values {", ".join(f"({k + 10}, '{c}')" for k, c in enumerate(_RECORD_CODES))}) as t(k, code)),
    c as (select * from (values {", ".join(f"({k + 20}, '{c}')" for k, c in enumerate(_CORRECTION_CODES))}) as t(k, code)), p as (select p_partkey as id, p_partkey % 50 as k from part), n as (select count(*) as n from part)
    select id, case when code = 'unknown_field' then 'other' else 'name' end as field, code from p join f using (k) union all select id, '', code from p join r using (k)
    union all select id, case when code = 'correction_of_unknown_field' then 'other' else 'name' end, code from p join c using (k)
    union all select id, 'other', 'correction_not_marked' from p where k = 26 union all select n - 1, '', 'record_out_of_range' from n""",
)
def ledger_errors(spark, sf_dir):
    """Reviews that are right, each fiftieth wrong in one way; names of k from 20 on are corrected."""
    k, size = F.col("k"), table(spark, sf_dir, "part").count()
    base = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 50).alias("k"), F.sha2("p_name", 256).alias("h"), "p_name")
    fc, rc, cc = (lambda code, codes=codes, add=add: k == codes.index(code) + add for codes, add in ((_FIELD_CODES, 0), (_RECORD_CODES, 10), (_CORRECTION_CODES, 20)))
    fixed = k.between(20, 26)
    scaffold = base.select("id", F.col("id").alias("place"), F.lit("name").alias("field"), F.col("h").alias("value_sha256"), F.lit("applicable").alias("applicability"))
    fields = base.where(~fc("missing_field") & ~rc("missing_record")).select(
        "id", F.lit("name").alias("field"), F.when(fc("stale_hash"), "x").otherwise(F.col("h")).alias("value_sha256"), F.when(fc("wrong_applicability"), "not_applicable").otherwise("applicable").alias("applicability"),
        F.when(fc("unknown_decision"), "sure").when(fixed & ~cc("correction_not_marked") & ~cc("correction_of_unknown_field"), "corrected").otherwise("approved").alias("decision"),
        F.when(fc("unknown_evidence"), F.array(F.lit("e1"), F.lit("e9"))).when(fc("decision_without_evidence"), F.array().cast("array<string>")).otherwise(F.array(F.lit("e1"))).alias("evidence_ids"),
        F.when(fc("no_provenance"), " ").otherwise("seen").alias("provenance"),
    )
    extra = base.where(fc("unknown_field")).select("id", F.lit("other"), F.col("h"), F.lit("applicable"), F.lit("approved"), F.array(F.lit("e1")), F.lit("seen"))
    evidence = base.select("id", F.lit("e1").alias("evidence_id"), F.lit("https://x").alias("url"), (~cc("correction_without_opened_evidence")).alias("opened"))
    change = base.where(fixed & ~cc("marked_without_correction")).select(
        "id", F.when(cc("correction_of_unknown_field"), "other").otherwise("name").alias("field"), F.when(cc("correction_of_other_value"), "x").otherwise(F.col("h")).alias("before_sha256"),
        F.when(cc("correction_without_change"), F.col("p_name")).otherwise(F.concat("p_name", F.lit("!"))).alias("after"), F.array(F.lit("e1")).alias("evidence_ids"),
    )
    corrections = change.union(change.join(base.where(cc("repeated_correction")).select("id"), "id", "left_semi"))
    records = base.where(~rc("missing_record")).select(
        "id", F.when(rc("record_out_of_order"), F.col("id") + 1).otherwise(F.col("id")).alias("at"), F.when(rc("unknown_pass"), "x").otherwise("approved").alias("first_pass"), F.lit("approved").alias("second_pass"),
        F.when(rc("unknown_final"), "x").when(rc("pending_final"), "pending").otherwise("approved").alias("final"),
    )
    twice = records.join(base.where(rc("repeated_record")).select("id"), "id", "left_semi")
    return A.ledger_errors(fields.union(extra), evidence, corrections, records.union(twice), scaffold, "id", 0, size - 2)  # the last row lies outside


@query(
    "v03_schema_errors",
    f"""select document_id, array_to_string(list_filter([case when price < 950 then '$.price: too small' end, case when trim(category) = '' and length(category) < 2 then '$.category: too short' end], lambda x: x is not null), ';') as errors from {CATALOG_SQL}
    where price < 950 or (trim(category) = '' and length(category) < 2)""",
)
def schema_errors(spark, sf_dir):
    schema = {
        "type": "object",
        "required": ["name", "price"],
        "additionalProperties": False,
        "properties": {"name": {"type": "string", "minLength": 1}, "price": {"type": "integer", "minimum": 950}, "category": {"type": ["string", "null"], "minLength": 2}},
    }
    rows = catalog(spark, sf_dir).select("document_id", A.json_errors(schema)(F.to_json(F.struct("name", "price", "category"))).alias("e"))
    return rows.where(F.size("e") > 0).select("document_id", F.array_join("e", ";").alias("errors"))


@query("v15_idempotent", "select 0::bigint as changed")
def idempotent(spark, sf_dir):
    from prodlake.functions.text import squeeze

    once = table(spark, sf_dir, "documents").select("doc_id", squeeze(F.col("text")).alias("text"))
    twice = once.select("doc_id", squeeze(F.col("text")).alias("text"))
    return once.exceptAll(twice).agg(F.count("*").alias("changed"))


@query(
    "v15_changed_by_pass",
    "select 1 as pass, count(*) as changed from documents where coalesce(text, '') <> trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) union all select 2, 0",
)
def changed_by_pass(spark, sf_dir):
    """V-15 with a table that the first pass changes: the gate tells the passes apart."""
    from prodlake.functions.text import squeeze

    raw = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    once = raw.select("doc_id", squeeze(F.col("text")).alias("text"))
    twice = once.select("doc_id", squeeze(F.col("text")).alias("text"))
    counts = [a.exceptAll(b).agg(F.lit(k).alias("pass"), F.count("*").alias("changed")) for k, (a, b) in enumerate(((raw, once), (once, twice)), 1)]
    return counts[0].union(counts[1])


@query(
    "w10_shifted_positions",
    """select conv_id as "group", turn, turn + 1 as stated, turn as place from conversations where conv_id % 5 = 0""",
)
def shifted_positions(spark, sf_dir):
    """W-10 with every fifth conversation counted from 1."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("group"), "turn", (F.col("turn") + F.when(F.col("conv_id") % 5 == 0, 1).otherwise(0)).alias("stated"))
    return A.position_errors(turns, "turn", "stated").select("group", "turn", "stated", "place")


@query(
    "f16_planted_notifications",
    "select c_custkey from customer where c_custkey % 4 = 1 or c_custkey % 6 = 2",
)
def planted_notifications(spark, sf_dir):
    key = F.col("c_custkey")
    name = F.when(key % 4 == 1, F.concat("c_name", F.lit("님에게 메시지를 보냈습니다"))).otherwise(F.col("c_name"))
    note = F.when(key % 6 == 2, "카카오톡 알림").when(key % 5 == 0, "메시지").otherwise(F.lit(None))
    return table(spark, sf_dir, "customer").where(A.is_notification(name, note)).select("c_custkey")


def _name_blocks(name):
    words = F.transform(F.split(F.lower(name), "[^\\p{L}\\p{N}]+"), lambda w: F.concat(F.lit("word|"), w))
    return F.concat(F.array(F.concat(F.lit("name|"), registry_name(name))), F.filter(words, lambda w: w != "word|"))


def _blocks(items, registry):
    """Items with makers, and the blocks of both sides: the normalised name, a word of it, or the maker, as E-01 has it: one maker's name holds the other's.

    Others have no company points and a part of the name points, so that they are never confirmed or put to review.
    A maker's name holds another where one of its parts of that length is the other: an equi-join on these parts.
    """
    mine = items.select(company(F.col("manufacturer_hint")).alias("_mine")).distinct().where("_mine <> ''")
    theirs = registry.select(company(F.col("manufacturer")).alias("_theirs")).distinct().where("_theirs <> ''")
    lengths = lambda df, c: df.agg(F.array_sort(F.collect_set(F.length(c)))).first()[0]  # noqa: E731  as many as there are lengths of makers' names
    parts = lambda c, ns: F.array_distinct(F.flatten(F.transform(F.array(*[F.lit(n) for n in ns]), lambda n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substr(F.col(c), i, n))).otherwise(F.array().cast("array<string>")))))
    inner = mine.withColumn("_theirs", F.explode(parts("_mine", lengths(theirs, "_theirs") or [1]))).join(theirs, "_theirs")
    outer = theirs.withColumn("_mine", F.explode(parts("_theirs", lengths(mine, "_mine") or [1]))).join(mine, "_mine")
    held = inner.select("_mine", "_theirs").union(outer.select("_mine", "_theirs"))
    makers = held.groupBy("_mine").agg(F.collect_set(F.concat(F.lit("maker|"), "_theirs")).alias("_makers"))
    known = items.withColumn("_mine", company(F.col("manufacturer_hint"))).join(makers, "_mine", "left")
    block = F.concat(_name_blocks(F.col("name")), F.coalesce("_makers", F.array().cast("array<string>")))
    registry_block = F.concat(_name_blocks(F.col("item_name")), F.array(F.concat(F.lit("maker|"), company(F.col("manufacturer")))))
    return known, block, registry_block


def _sided(items, registry):
    known, block, registry_block = _blocks(items, registry)
    return known, registry, block, registry_block


def _candidates(items, registry):
    return E.candidates(*_sided(items, registry)).drop("_mine", "_makers")


def _brand_and_word(name, brand):
    return F.array(F.concat(brand, F.lit("|"), F.split_part(name, F.lit(" "), F.lit(2))))


def _sides(spark, sf_dir):
    """Every part is an item; the registry holds one product for each name and brand."""
    part = table(spark, sf_dir, "part")
    items = part.select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.concat("p_size", F.lit(" 정")).alias("capacity"), F.col("p_brand").alias("manufacturer_hint")
    )
    products = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("official_product_key"), F.min("p_size").alias("size"))
    registry = products.select(
        "official_product_key", F.col("p_name").alias("item_name"), F.concat("size", F.lit("tab")).alias("pack_unit"), F.col("p_brand").alias("manufacturer"), F.lit("").alias("dosage_form")
    )
    return items, registry


#: All that the rules look at of an item.
_ITEM = ["name", "capacity", "manufacturer_hint"]


def _pairs(spark, sf_dir):
    """(item_id, kind) of all items, and all candidates of a kind of them."""
    items, registry = _sides(spark, sf_dir)
    kinds, members = E.kinds_of(items, _ITEM)
    return members, _met(kinds, registry)


def _met(items, registry, block=None):
    """All candidates, or those that a `block` of name and brand narrows them to."""
    if block is None:
        return _candidates(items, registry)
    return E.candidates(items, registry, block(F.col("name"), F.col("manufacturer_hint")), block(F.col("item_name"), F.col("manufacturer")))


_RATIO = "(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})))"
_SCORED = f"""items as (select p_partkey as item_id, p_name, p_size, p_brand from part), reg as (select min(p_partkey) as k, p_name, p_brand, min(p_size) as p_size from part group by p_name, p_brand),
    s as (select item_id, k, replace(i.p_name, ' ', '') = replace(r.p_name, ' ', '') as exact,
    case when i.p_name = r.p_name then 60 else cast(round_even(60 * {_RATIO.format(a="replace(i.p_name, ' ', '')", b="replace(r.p_name, ' ', '')")}, 0) as int) end + 20 + case when i.p_size = r.p_size then 15 else 0 end as score
    from items i join reg r on i.p_brand = r.p_brand and split_part(i.p_name, ' ', 2) = split_part(r.p_name, ' ', 2))"""


def _levenshtein_ratio():
    a, b = registry_name(F.col("name")), registry_name(F.col("item_name"))
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


@query("e01_registry_scores_levenshtein", f"with {_SCORED} select item_id, k as official_product_key, score, case when score >= 95 then 'confirmed' when score >= 80 then 'review_required' else 'rejected' end as status from s")
def registry_scores_levenshtein(spark, sf_dir):
    items, registry = _sides(spark, sf_dir)
    scored = lambda kinds: E.registry_points(_met(kinds, registry, _brand_and_word), _levenshtein_ratio())
    return E.each_kind_once(items, _ITEM, lambda kinds: scored(kinds).select("item_id", "official_product_key", "score", "status"))


@query(
    "e02_registry_choice_levenshtein",
    f"""with {_SCORED}, r as (select *, row_number() over w as rn, lead(score) over w as second, count(*) over (partition by item_id) as n, sum(cast(exact as int)) over (partition by item_id) as ne
    from s window w as (partition by item_id order by score desc, cast(k as varchar))), b as (select *, coalesce(second >= score - 3, false) as close from r where rn = 1),
    d as (select item_id, k, n, case when ne > 1 or (score >= 95 and close) then 'review_required' when ne = 1 and exact and not close then 'confirmed' when score < 80 then 'not_found' when score >= 95 then 'confirmed' else 'review_required' end as status,
    case when not (ne > 1 or (score >= 95 and close)) and ne = 1 and exact and not close then greatest(score, 95) else score end as score from b)
    select item_id, coalesce(status, 'not_found') as status, coalesce(score, 0) as score, case when coalesce(status, 'not_found') = 'not_found' then '' else cast(k as varchar) end as official_product_key, coalesce(n, 0) as n_candidates from items left join d using (item_id)""",
)
def registry_choice_levenshtein(spark, sf_dir):
    items, registry = _sides(spark, sf_dir)
    registry = registry.withColumn("official_product_key", F.col("official_product_key").cast("string"))
    scored = lambda kinds: E.registry_points(_met(kinds, registry, _brand_and_word), _levenshtein_ratio())
    return E.each_kind_once(items, _ITEM, lambda kinds: E.registry_choice(kinds, scored(kinds)))


_WHOLE = _SCORED.replace("+ 20 +", "+ case when contains(i.p_brand, r.p_brand) or contains(r.p_brand, i.p_brand) then 20 else 0 end +").replace(
    "on i.p_brand = r.p_brand and split_part(i.p_name, ' ', 2) = split_part(r.p_name, ' ', 2)",
    "on contains(i.p_brand, r.p_brand) or contains(r.p_brand, i.p_brand) or i.p_name = r.p_name or list_has_any(string_split(i.p_name, ' '), string_split(r.p_name, ' '))",
)


@query("e02_registry_choice_whole_levenshtein", ORACLE_SQL["e02_registry_choice_levenshtein"].replace(_SCORED, _WHOLE))
def registry_choice_whole_levenshtein(spark, sf_dir):
    """The choice over all of `_candidates`; the query without `whole` is held to brand and second word."""
    items, registry = _sides(spark, sf_dir)
    registry = registry.withColumn("official_product_key", F.col("official_product_key").cast("string"))
    ratio = _levenshtein(F.col("_a_name"), F.col("_b_name"))
    return E.each_kind_once(items, _ITEM, lambda kinds: E.registry_choice(kinds, E.scored_candidates(*_sided(kinds, registry), ratio)))


@query("e01_e02_registry_choice")
def registry_choice(spark, sf_dir):
    items, registry = _sides(spark, sf_dir)
    registry = registry.withColumn("official_product_key", F.col("official_product_key").cast("string"))
    return E.each_kind_once(items, _ITEM, lambda kinds: E.registry_choice(kinds, E.pruned_scores(E.pruned_candidates(*_sided(kinds, registry)))))


def _search_choice(items, pairs, ratio=matching_blocks_ratio):
    """Each item has a row: where no candidate is safe, the best of all and why."""
    seen = N.judged(pairs, "name", "item_name", "capacity", ratio).select("item_id", F.col("item_name").alias("code"), "score", "safe")
    best = seen.groupBy("item_id").agg(F.min_by(F.struct("code", "score"), F.struct(-F.col("score"), "code")).alias("best"))
    rows = items.select("item_id").join(best, "item_id", "left").join(E.search_choice(seen, 90).withColumnsRenamed({"code": "safe_code", "score": "safe_score"}), "item_id", "left")
    return rows.select(
        "item_id",
        F.coalesce("safe_code", "best.code").alias("code"),
        F.coalesce("safe_score", "best.score").alias("score"),
        F.coalesce("decision", F.when(F.col("best").isNull(), "no_search_result").otherwise("name_or_dosage_conflict")).alias("decision"),
    )


@query("e03_e06_search_choice")
def search_choice(spark, sf_dir):
    members, pairs = _pairs(spark, sf_dir)
    kinds = members.select(F.col("kind" if "kind" in members.columns else "item_id").alias("item_id")).distinct()
    return E.for_members(_search_choice(kinds, pairs), members)


def _levenshtein(a, b):
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def _lengths(a, b):
    """A stand-in for the ratio that reads alike in SQL, whatever the letters."""
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b))


#: Names with all that the rules look at: parentheses, strengths, forms, indications, misreadings and Hangul, each for some rows.
_DRUG = """case p_size % 6 when 0 then p_name || '정' when 1 then p_name || ' 500mg' when 2 then p_name || '(소아)' when 3 then replace(p_name, ' ', '') || '씨럽' when 4 then p_name || '해열진통제' else p_name || ' 캅셀(30정)' end"""
_FOUND = """case p_size % 4 when 0 then p_name || ' 정' when 1 then p_name || '500 mg' when 2 then upper(p_name) || '시럽' else p_name end"""


def _drug_pairs(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    block = F.concat("p_brand", F.lit("|"), F.split_part("p_name", F.lit(" "), F.lit(2)))
    items = part.select(F.col("p_partkey").alias("item_id"), F.expr(_DRUG).alias("name"), F.concat("p_size", F.when(F.col("p_size") % 3 == 0, "정").otherwise("캡슐")).alias("capacity"), block.alias("block"))
    found = part.select(F.expr(_FOUND).alias("item_name"), block.alias("block")).distinct()
    return items.drop("block"), items.join(found, "block").drop("block")


def _names_sql(table_name: str, name: str) -> str:
    """The facts of a column of names: identity, plain, core, qualifiers, strengths, family, tokens."""
    low = f"replace(replace(replace(lower({name}), '현탄액', '현탁액'), '씨럽', '시럽'), '캅셀', '캡슐')"
    keep = lambda x: f"regexp_replace({x}, '[^0-9a-z가-힣]', '', 'g')"
    bare = rf"regexp_replace({low}, '\([^)]*\)', '', 'g')"
    endings = "|".join((*N.INDICATIONS, *N.FORM_ENDINGS))
    family = " ".join(f"when regexp_matches(p, '{'|'.join(forms)}') then '{n}'" for n, forms in N.FAMILIES.items())
    return rf"""(select {name}, {keep("l")} as ident, p, case when regexp_extract(b, '^(.{{2,}}?)(?:{endings})*$', 1) = '' then b else regexp_extract(b, '^(.{{2,}}?)(?:{endings})*$', 1) end as core,
      list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(l, '\(([^)]*)\)', 1), lambda g: {keep("g")}), lambda g: g <> '' and not regexp_matches(g, '{N.QUANTITY}')))) as q,
      list_distinct(list_transform(regexp_extract_all(l, '(\d+(?:\.\d+)?\s*(?:mg|mcg|g|ml))', 1), lambda t: replace(t, ' ', ''))) as st, case {family} else '' end as fam,
      list_transform(regexp_extract_all({name}, '[0-9a-zA-Z가-힣]+'), lambda t: {keep("replace(replace(replace(lower(t), '현탄액', '현탁액'), '씨럽', '시럽'), '캅셀', '캡슐')")}) as tok
      from (select *, regexp_replace(p, '\d+(?:mg|mcg|g|ml)$', '') as b from (select {name}, {low} as l, {keep(bare)} as p from (select distinct {name} from {table_name}))))"""


_JUDGED = rf"""i as (select p_partkey as item_id, {_DRUG} as name, p_size || case when p_size % 3 = 0 then '정' else '캡슐' end as capacity, case when p_size % 3 = 0 then 'tablet' else 'capsule' end as pack, p_brand || '|' || split_part(p_name, ' ', 2) as block from part),
    f as (select distinct {_FOUND} as item_name, p_brand || '|' || split_part(p_name, ' ', 2) as block from part),
    a as (select * from {_names_sql("i", "name")}), b as (select * from {_names_sql("f", "item_name")}),
    p as (select item_id, i.name, f.item_name, pack, a.ident as ai, b.ident as bi, a.p as ap, b.p as bp, a.core as ac, b.core as bc, a.q as aq, b.q as bq, a.st as ast, b.st as bst, a.fam as af, b.fam as bf, a.tok as atok, b.tok as btok,
      case when length(a.p) <= length(b.p) then a.p else b.p end as short, case when length(a.p) <= length(b.p) then b.p else a.p end as long
      from i join f using (block) join a using (name) join b using (item_name)),
    r as (select *, substr(long, 1, strpos(long, short) - 1) || substr(long, strpos(long, short) + length(short)) as rest from p),
    j as (select item_id, name, item_name,
      not (ai = '' or bi = '' or aq <> bq or (len(ast) > 0 and len(bst) > 0 and not list_has_any(ast, bst)) or (af <> '' and bf <> '' and af <> bf) or (pack <> '' and bf <> '' and pack <> bf))
      and (ai = bi or ap = bp or (length(ac) >= case when pack = bf then 2 else 3 end and ac = bc)
        or (length(short) >= 4 and strpos(long, short) > 0 and (regexp_replace(rest, '\d+(?:mg|mcg|g|ml)$', '') = '' or rest in ({", ".join(f"'{x}'" for x in N.INDICATIONS)})))) as safe,
      case when ap = bp then 100 when (length(short) >= 4 and contains(long, short)) or len(list_filter(list_distinct(list_concat(atok, btok)), lambda t: length(t) >= 4 and t not in ({", ".join(f"'{x}'" for x in N.GENERIC)}) and contains(ap, t) and contains(bp, t) and length(t) >= 0.55 * length(short))) > 0
        then greatest(96, cast(round_even(100 * (least(length(ap), length(bp)) / greatest(length(ap), length(bp))), 0) as int)) else cast(round_even(100 * (least(length(ap), length(bp)) / greatest(length(ap), length(bp))), 0) as int) end as score, ai, bi, ac, bc from r)"""


@query("e03_e05_judged_lengths", f"with {_JUDGED} select item_id, item_name, safe, score, case when safe and ai = bi then 100 when safe and ac = bc then greatest(score, 98) else score end as validated from j")
def judged_lengths(spark, sf_dir):
    """The rules with a stand-in for the similarity; names made to reach all of them."""
    _, pairs = _drug_pairs(spark, sf_dir)
    return N.judged(pairs, "name", "item_name", "capacity", _lengths).select("item_id", "item_name", "safe", "score", "validated")


@query(
    "e06_search_choice_lengths",
    f"""with {_JUDGED}, best as (select item_id, min_by(item_name, struct_pack(a := -score, b := item_name)) as code, max(score) as score from j group by 1),
    s as (select *, lead(score) over w as rival, row_number() over w as rn from j where safe window w as (partition by item_id order by score desc, item_name))
    select i.item_id, coalesce(s.item_name, best.code) as code, coalesce(s.score, best.score) as score,
    case when best.item_id is null then 'no_search_result' when s.item_id is null then 'name_or_dosage_conflict' when s.score < 90 then 'below_threshold' when s.rival >= s.score - 1 then 'close_rival' else 'confirmed' end as decision
    from i left join best using (item_id) left join s on s.item_id = i.item_id and s.rn = 1""",
)
def search_choice_lengths(spark, sf_dir):
    return _search_choice(*_drug_pairs(spark, sf_dir), _lengths)


@query("e12_listing_scores")
def listing_scores(spark, sf_dir):
    items, registry = _sides(spark, sf_dir)
    scored = lambda kinds: N.listed(_met(kinds, registry), "name", "item_name")
    return E.each_kind_once(items, ["name", "manufacturer_hint"], lambda kinds: scored(kinds).select("item_id", "official_product_key", "score"))


@query(
    "e12_listing_scores_levenshtein",
    """with i as (select p_partkey as item_id, p_name || ' 2개' as name, p_brand || '|' || split_part(p_name, ' ', 2) as block from part),
    f as (select distinct case p_size % 3 when 0 then '<b>' || upper(p_name) || '</b>' when 1 then p_name || ' box of ' || p_brand else split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) end as item_name, p_brand || '|' || split_part(p_name, ' ', 2) as block from part),
    p as (select item_id, item_name, name, regexp_replace(replace(lower(name), ' 2개', ''), '[^0-9a-z가-힣]', '', 'g') as a, regexp_replace(lower(regexp_replace(item_name, '<[^>]+>', ' ', 'g')), '[^0-9a-z가-힣]', '', 'g') as b from i join f using (block)),
    t as (select *, list_filter(regexp_extract_all(replace(name, ' 2개', ''), '[0-9a-zA-Z가-힣]+'), lambda x: length(x) >= 3) as tok, cast(round_even(100 * (1 - levenshtein(a, b) / greatest(length(a), length(b))), 0) as int) as s from p),
    h as (select *, list_filter(tok, lambda x: contains(b, x)) as held from t)
    select item_id, item_name, case when a = b then 100 when length(a) >= 5 and contains(b, a) and length(a) >= 0.42 * length(b) then greatest(s, 96)
    when len(held) > 0 and length(a) >= 6 and list_sum(list_transform(held, lambda x: length(x))) >= 0.8 * list_sum(list_transform(tok, lambda x: length(x))) and (len(held) >= 2 or length(held[1]) >= 6) then greatest(s, 92) else s end as score from h""",
)
def listing_scores_levenshtein(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    block = F.concat("p_brand", F.lit("|"), F.split_part("p_name", F.lit(" "), F.lit(2)))
    word = lambda k: F.split_part("p_name", F.lit(" "), F.lit(k))
    shown = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("<b>"), F.upper("p_name"), F.lit("</b>"))).when(F.col("p_size") % 3 == 1, F.concat("p_name", F.lit(" box of "), "p_brand")).otherwise(F.concat(word(2), F.lit(", "), word(1)))
    items = part.select(F.col("p_partkey").alias("item_id"), F.concat("p_name", F.lit(" 2개")).alias("name"), block.alias("block"))
    found = part.select(shown.alias("item_name"), block.alias("block")).distinct()
    return N.listed(items.join(found, "block"), "name", "item_name", _levenshtein).select("item_id", "item_name", "score")


@query("f20_non_drug", f"select document_id from {CATALOG_SQL} where category = 'PROMO' or regexp_matches(name, 'gizmo|gear')")
def non_drug(spark, sf_dir):
    return catalog(spark, sf_dir).where(E.non_drug(("PROMO",), ("gizmo", "gear"))).select("document_id")
