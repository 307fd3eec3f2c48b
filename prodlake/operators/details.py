"""Details of confirmed products: parsing of upstream fields, the full record, alternatives, the review export, and its audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.functions.deep import PROMOTION, TYPOS, VITAMINS, core_of, spelled, text_facts
from prodlake.functions.text import blank, host, map_text, trim_space
from prodlake.operators.audit import findings
from prodlake.operators.content import health_texts
from prodlake.operators.official import OFFICIAL_HOSTS, lookup_status
from prodlake.operators.records import numbered, prefer

DETAIL_PAGE = "https://www.health.kr/searchDrug/result_drug.asp"
#: Column -> upstream fields, the first that holds text (fixed values).
TEXTS = {
    "official_item_name": ("drug_name",), "official_report_number": ("fdacode",), "official_english_name": ("drug_enm",), "official_category": ("cls_code",),
    "official_classification_code": ("cls_code_num",), "official_dosage_form": ("drug_form",), "official_route": ("dosage_route",), "official_atc_code": ("atc_cd",),
    "official_kpic_atc": ("kpic_atc",), "official_pack_unit": ("drug_box",), "official_storage": ("stmt",), "official_valid_term": ("valid_term",),
    "official_appearance": ("charact_new", "charact"), "official_permit_date": ("item_permit_date",), "official_insurance": ("boh",),
    "official_insurance_detail": ("boh_history",), "official_reimbursement_criteria": ("reimbursement_criteria",), "official_efficacy": ("effect",),
    "official_dosage": ("dosage",), "official_precautions": ("caution",), "official_medication_summary": ("medititle",), "official_medication_guide": ("mediguide",),
    "official_identification": ("idfyinfo",), "official_dur_contraindications": ("dur_contra",), "official_dur_age": ("dur_age",), "official_dur_pregnancy": ("dur_preg",),
    "official_dur_senior": ("dur_senior",), "official_dur_max_dose": ("dur_dose",), "official_dur_max_period": ("dur_period",), "official_dur_split_dosage": ("dur_form",),
    "official_upstream_updated_at": ("paper_dt",),
}
EMPTY = ("official_barcode", "official_udi_di", "official_professional_precautions")
VERIFIED = {
    "ingredients": "official_ingredients", "efficacy": "official_efficacy", "dosage": "official_dosage", "precautions": "official_precautions", "storage": "official_storage",
    "manufacturer": "official_manufacturer", "dosage_form": "official_dosage_form", "route": "official_route", "package": "official_pack_unit", "images": "official_images",
}
EVIDENCE_KEYS = ("detail_page_verified", "ajax_payload_verified", "match_reasons", "conflicts", "source_urls", "verified_fields")
REPRESENTATIVE = ("package", "label", "pill", "instruction")
STATUSES = {"confirmed": "official_details_linked", "review_required": "official_review_required", "not_found": "not_found", "not_applicable": "not_applicable"}


def split_texts(x: Column, separators: str = "</br>|<br>|@|#") -> Column:
    """T-23: cleaned parts of an upstream text, the first of equal ones."""
    parts = health_texts(F.split(blank(x), rf"(?i){separators}|\n"))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def ingredients(x: Column) -> Column:
    """T-23: (label, code) of the records of an upstream list; fields inside a record are parted by slashes."""
    records = F.filter(F.split(blank(x), r"\|"), lambda r: F.trim(r) != "")
    labels = health_texts(F.transform(records, lambda r: F.replace(r, F.lit("@"), F.lit(" / "))))
    codes = F.transform(records, lambda r: F.coalesce(F.try_url_decode(F.regexp_extract(r, "ingd_code=([^\"'&>]+)", 1)), F.lit("")))
    return F.filter(F.transform(F.arrays_zip(labels.alias("label"), codes.alias("code")), lambda z: F.struct(z["label"].alias("label"), z["code"].alias("code"))), lambda i: i["label"] != "")


def manufacturer(x: Column) -> Column:
    """T-24: the six parts of an upstream manufacturer."""
    parts = health_texts(F.split(blank(x), r"\|"))
    return F.struct(*[F.coalesce(F.get(parts, F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(("name", "english_name", "address", "phone", "fax", "website"))])


def insurance_history(x: Column) -> Column:
    """T-24: (code, detail) of rows parted by ^, each by its first bar."""
    rows = F.filter(F.split(blank(x), r"\^"), lambda r: F.trim(r) != "")
    return F.transform(rows, lambda r: F.struct(trim_space(F.regexp_extract(r, r"^([^|]*)", 1)).alias("code"), trim_space(F.regexp_extract(r, r"^[^|]*\|(.*)$", 1)).alias("detail")))


def deep_variants(df: DataFrame, name: str, capacity: str) -> DataFrame:
    """E-13 for the registry: adds `variants`, up to eight spellings to search by, made from name and capacity."""
    given = blank(F.col(name))
    mended = given
    for wrong, right in TYPOS.items():
        mended = F.replace(mended, F.lit(wrong), F.lit(right))
    bare = F.when(blank(F.col(capacity)) != "", F.replace(mended, blank(F.col(capacity)), F.lit(" "))).otherwise(mended)
    sized = F.regexp_replace(bare, r"(?i)(?<!\d)\d+(?:[.,]\d+)?\s*(?:mg|mcg|g|ml|l|iu|정|캡슐|포|병|개|c|ea|매|롤)(?![0-9A-Za-z가-힣_])", " ")
    voiced = sized
    for letter, word in VITAMINS.items():
        voiced = F.regexp_replace(voiced, rf"(?i)비타민\s*{letter}", f"비타민{word}")
    seeds = [given, mended, sized, F.regexp_replace(bare, r"\([^)]*\)", " "), voiced, F.regexp_replace(sized, "|".join(PROMOTION), " ")]
    seen = text_facts(df.withColumn("_mended", mended), "_mended", ("cores",)).withColumn("_seeds", F.transform(F.array(*seeds), spelled))
    hearts = F.when(F.size("facts.cores") > 0, F.col("facts.cores")).otherwise(F.array(core_of(spelled(F.col("_mended")))))
    starts = F.flatten(F.transform(F.filter(hearts, lambda h: F.length(h) >= 5), lambda h: F.array(F.substr(h, F.lit(1), F.greatest(F.lit(4), F.length(h) - 1)), F.substring(h, 1, 4), F.substring(h, 1, 3))))
    spellings = F.array_distinct(F.filter(F.concat("_seeds", "facts.cores", starts), lambda v: F.length(v) >= 2))
    return seen.withColumn("variants", F.slice(spellings, 1, 8)).drop("_mended", "_seeds", "facts")


def confirmed_records(matches: DataFrame, checked_at: str) -> DataFrame:
    """P-12, P-13: matches (id, code, score, reasons, conflicts, raw, images, aux_urls) as full records of some sixty columns.

    raw is a map of upstream texts, images an array of (url, kind); all texts of a record are cleaned in one batch.
    """
    cleaned = matches.withColumn("_text", F.map_from_arrays(F.map_keys("raw"), health_texts(F.map_values("raw"))))
    text = lambda *keys: F.coalesce(*[F.nullif(F.try_element_at("_text", F.lit(k)), F.lit("")) for k in keys], F.lit(""))
    raw = lambda k: F.try_element_at("raw", F.lit(k))
    page = F.concat(F.lit(f"{DETAIL_PAGE}?drug_cd="), F.url_encode("code"))
    out = cleaned.withColumns({c: text(*keys) for c, keys in TEXTS.items()})
    out = out.withColumns(
        {
            **{c: F.lit("") for c in EMPTY},
            "official_item_seq": F.col("code"), "official_product_key": F.col("code"), "official_domain": F.lit("health.kr"), "official_source_type": F.lit("약학정보원 의약품 상세정보"),
            "official_source_url": page, "official_match_score": F.col("score"), "official_match_status": F.lit("confirmed"), "official_checked_at": F.lit(checked_at),
            "official_manufacturer_details": manufacturer(F.coalesce(F.nullif(raw("upso_name"), F.lit("")), raw("upso_name_kfda"))),
            "official_ingredient_details": ingredients(raw("sunb")), "official_additives": split_texts(raw("additives"), "</br>|<br ?/?>|#"),
            "official_insurance_history": insurance_history(raw("boh_history")), "official_standard_codes": split_texts(raw("fdacode"), r"\||,"),
            "official_insert_pdf_url": trim_space(raw("insertpaper")), "official_images": F.coalesce("images", F.array().cast("array<struct<url:string,kind:string>>")),
            "official_consumer_guidance": F.map_filter(F.create_map(F.lit("summary"), text("medititle"), F.lit("guide"), text("mediguide")), lambda k, v: v != ""),
            "official_patient_guidance": text("medititle"), "enrichment_status": F.lit("official_details_linked"),
        }
    )
    out = out.withColumns(
        {
            "official_manufacturer": F.col("official_manufacturer_details.name"),
            "official_ingredients": F.array_distinct(F.transform("official_ingredient_details", lambda i: i["label"])),
        }
    )
    out = out.withColumn("official_active_ingredients", F.col("official_ingredients"))
    filled = lambda c: F.size(c) > 0 if isinstance(out.schema[c].dataType, T.ArrayType) else F.col(c) != ""
    verified = F.array_compact(F.array(*[F.when(filled(c), F.lit(n)) for n, c in VERIFIED.items()]))
    needed = F.array(*[F.lit(n) for n in VERIFIED if n != "images"])
    first = F.get(F.array_sort(F.transform("official_images", lambda i: F.struct(F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(k) for k in REPRESENTATIVE]), i["kind"]), F.lit(0)), F.lit(9)).alias("rank"), i["url"].alias("url"), i["kind"].alias("kind")))), F.lit(0))
    shown = F.size("official_images") > 0
    out = out.withColumns(
        {
            "official_section_evidence": F.struct(F.lit(True).alias("detail_page_verified"), F.lit(True).alias("ajax_payload_verified"), F.col("reasons").alias("match_reasons"), F.col("conflicts"), F.array_distinct(F.concat(F.array(page), F.filter("aux_urls", lambda u: u != ""))).alias("source_urls"), verified.alias("verified_fields")),
            "official_content_status": F.when(F.size(F.array_except(needed, verified)) == 0, "complete").otherwise("partial"),
            "image_url": F.coalesce(first["url"], F.lit("")), "image_kind": F.coalesce(first["kind"], F.lit("")), "image_source_url": F.when(shown, page).otherwise(""),
            "image_rights_status": F.when(shown, "official_source_preview").otherwise(""), "image_checked_at": F.when(shown, checked_at).otherwise(""),
        }
    )
    return out.drop("_text", "code", "score", "reasons", "conflicts", "images", "aux_urls")


def alternatives_of(scored: DataFrame, order: str = "official_product_key", k: int = 10) -> DataFrame:
    """P-14: the k best candidates of each item in order, with fourteen fields; those a table lacks are empty."""
    told = ("item_name", "manufacturer", "pack_unit", "source_domain", "source_dataset_id", "source_url", "item_seq", "barcode", "udi_di", "report_number", "dosage_form")
    parts = {n: F.col(f"{n}_points") for n in ("name", "company", "capacity", "form")}
    components = F.map_filter(F.create_map(*[v for n, c in parts.items() for v in (F.lit(n), c)]), lambda _, v: v > 0)
    fields = [F.col(order).cast("string").alias("official_product_key"), F.col("score"), components.alias("score_components"), *[(blank(F.col(c)) if c in scored.columns else F.lit("")).alias(c) for c in told]]
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), order))
    best = scored.withColumn("_rank", rank).where(F.col("_rank") <= k)
    gathered = best.groupBy("item_id").agg(F.collect_list(F.struct(F.col("_rank").alias("rank"), F.struct(*fields).alias("a"))).alias("_all"))
    return gathered.select("item_id", F.transform(F.array_sort("_all", lambda x, y: x["rank"] - y["rank"]), lambda x: x["a"]).alias("alternatives"))


def review_queue(products: DataFrame, matches: DataFrame, records: DataFrame, size: int = 25) -> DataFrame:
    """K-12, J-02: the export for reviewers, 29 columns in fixed order; what a record lacks comes from the first alternative.

    products: (pos, id, document_id, name, capacity, category, price); matches: (id, status, official_product_key, score,
    score_components, conflicts, reviewer, reviewed_at, alternatives); records: nested official records.
    """
    flat = {"official_domain": ("source_domain", "source_domain"), "official_item_seq": ("identifiers.item_seq", "item_seq"), "official_name": ("item_name", "item_name"), "official_manufacturer": ("manufacturer", "manufacturer"),
            "official_dosage_form": ("classification.dosage_form", "dosage_form"), "official_pack_unit": ("content.pack_unit", "pack_unit"), "official_barcode": ("identifiers.barcode", "barcode"),
            "official_dataset_id": ("provenance.source_dataset_id", "source_dataset_id"), "official_source_url": ("provenance.source_url", "source_url")}
    r = records.select(F.col("official_product_key").alias("_key"), F.struct("*").alias("r"))
    queue = numbered(products, "pos").join(matches.select(F.col("id").alias("_id"), F.struct("*").alias("m")), F.coalesce(F.nullif(blank(F.col("id")), F.lit("")), F.col("document_id")) == F.col("_id"), "left")
    joined = queue.join(r, F.col("m.official_product_key") == F.col("_key"), "left").withColumn("a", F.get("m.alternatives", F.lit(0)))
    joined = joined.withColumns({k: F.col(f"r.{path}") for k, (path, _) in flat.items()} | {f"_{k}": F.col(f"a.{other}") for k, (_, other) in flat.items()})
    status = F.coalesce(F.col("m.status"), F.lit("pending"))
    return joined.select(
        (F.floor((F.col("number") - 1) / size) + 1).cast("long").alias("batch_no"), F.col("number").cast("long").alias("source_order"), F.coalesce(F.nullif(blank(F.col("id")), F.lit("")), blank(F.col("document_id"))).alias("catalog_product_id"),
        F.col("name").alias("catalog_name"), F.col("capacity").alias("catalog_capacity"), F.col("category").alias("catalog_category"), F.col("price").alias("catalog_price"),
        lookup_status(status).alias("lookup_status"), status.alias("match_status"), blank(F.col("m.official_product_key")).alias("official_product_key"),
        *[prefer(k, f"_{k}").alias(k) for k in flat],
        blank(F.col("r.content.efficacy")).alias("official_efficacy"), blank(F.col("r.content.dosage")).alias("official_dosage"), blank(F.col("r.content.precautions")).alias("official_precautions"),
        F.coalesce(F.to_json("r.content.ingredients"), F.lit("[]")).alias("official_ingredients_json"), F.coalesce(F.to_json("r.images"), F.lit("[]")).alias("official_images_json"),
        blank(F.col("m.score")).alias("match_score"), F.coalesce(map_text(F.col("m.score_components")), F.lit("")).alias("match_reason"), F.coalesce(F.to_json("m.conflicts"), F.lit("[]")).alias("conflict_reasons_json"),
        blank(F.col("m.reviewer")).alias("reviewer"), blank(F.col("m.reviewed_at")).alias("reviewed_at"),
    )


def _empty(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType
    if isinstance(kind, T.ArrayType | T.MapType):
        return F.coalesce(F.size(c), F.lit(0)) == 0
    return F.col(c).isNull() if isinstance(kind, T.StructType) else F.coalesce(F.col(c).cast("string"), F.lit("")).isin("", "0", "0.0")


def record_rules(df: DataFrame) -> dict[str, Column]:
    """V-06: what must hold of a row by its status: code -> condition of a row that breaks it.

    Columns: those of confirmed_records(), raw (map, null without), probed (urls that were probed), allowed (image hosts are fixed).
    """
    c = F.col
    status, images = c("official_match_status"), F.coalesce("official_images", F.array().cast(df.schema["official_images"].dataType))
    sure, other = status == "confirmed", status.isin(*[s for s in STATUSES if s != "confirmed"])
    known = status.isin(*STATUSES)
    urls = F.transform(F.filter(images, lambda i: i.isNotNull()), lambda i: i["url"])
    each = lambda bad: known & F.exists(images, lambda i: i.isNotNull() & F.coalesce(bad(i), F.lit(True)))
    meta = [x for x in ("image_url", "image_kind", "image_source_url", "image_checked_at") if x in df.columns]
    any_meta = F.concat_ws("", *meta) != ""
    evidence = df.schema["official_section_evidence"].dataType.names if "official_section_evidence" in df.columns else []
    code = F.coalesce(F.try_parse_url("official_source_url", F.lit("QUERY"), F.lit("drug_cd")), F.lit(""))
    raw = lambda k: blank(F.try_element_at("raw", F.lit(k)))
    detail = c("raw").isNotNull() & (raw("drug_code") != "")
    text = F.array(*[c(x) for x in ("official_efficacy", "official_dosage", "official_precautions")])
    upstream = health_texts(F.array(*[raw(k) for k in ("effect", "dosage", "caution")]))
    official = [x for x in df.columns if x.startswith("official_") and x not in ("official_match_status", "official_checked_at", "official_content_status", "official_images")]
    left_over = F.lit(False)
    for x in official:
        left_over = left_over | ~_empty(df, x)
    expected = F.element_at(F.create_map(*[F.lit(v) for pair in STATUSES.items() for v in pair]), status)
    score = c("official_match_score")
    rules = {
        "bad_match_score": score.isNull() | ~score.between(0, 100),
        "bad_status": ~F.coalesce(known, F.lit(False)),
        "duplicate_image": known & (F.size(F.array_distinct(urls)) < F.size(urls)),
        "bad_image_item": known & F.exists(images, lambda i: i.isNull()),
        "invalid_image_domain": each(lambda i: ~(host(i["url"]).isin(*OFFICIAL_HOSTS) & F.startswith(i["url"], F.lit("https://")))),
        "invalid_image_kind": each(lambda i: ~i["kind"].isin(*REPRESENTATIVE)),
        "image_source_mismatch": each(lambda i: i["source_url"] != c("official_source_url")),
        "image_not_probed": each(lambda i: ~F.array_contains("probed", i["url"])),
        "confirmed_enrichment_status": sure & (c("enrichment_status") != STATUSES["confirmed"]),
        "confirmed_content_status": sure & ~c("official_content_status").isin("complete", "partial"),
        "confirmed_missing_item_seq": sure & (c("official_item_seq") == ""),
        "confirmed_bad_source": sure & (~host(c("official_source_url")).isin("health.kr", "www.health.kr") | (code != c("official_item_seq"))),
        "confirmed_bad_domain": sure & (c("official_domain") != "health.kr"),
        "confirmed_missing_checked_at": sure & (c("official_checked_at") == ""),
        "missing_evidence_key": sure & (F.lit(not set(EVIDENCE_KEYS) <= set(evidence)) | (c("official_section_evidence").isNull() if evidence else F.lit(True))),
        "missing_raw_detail": sure & ~detail,
        "raw_code_mismatch": sure & detail & (raw("drug_code") != c("official_item_seq")),
        "normalized_text_mismatch": sure & detail & (text != upstream),
        "representative_not_in_images": sure & (F.size(images) > 0) & ~F.array_contains(urls, c("image_url")),
        "bad_image_rights": sure & (F.size(images) > 0) & (c("image_rights_status") != "official_source_preview"),
        "image_metadata_without_image": sure & (F.size(images) == 0) & any_meta,
        "nonconfirmed_content_status": other & (c("official_content_status") != ""),
        "nonconfirmed_enrichment_status": other & (c("enrichment_status") != expected),
        "nonconfirmed_official_data": other & left_over,
        "nonconfirmed_image_data": other & ((F.size(images) > 0) | any_meta | (c("image_rights_status") != "")),
        "additive_contains_html": F.exists("official_additives", lambda a: a.rlike("<[A-Za-z/][^>]*>")),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}


def enrichment_audit(before: DataFrame, after: DataFrame, key: str, originals: list[str], expected: int, arrays: tuple[str, ...] = (), maps: tuple[str, ...] = ()) -> DataFrame:
    """V-06 in long form (id, code, field): counts, keys, order and original fields against the table before, types, and the rules by row.

    Both tables have `pos`, their order. What concerns a whole table has an empty id.
    """
    none = F.lit("")
    kinds = {f.name: f.dataType for f in after.schema.fields}
    shape = [("missing_original_field", c) for c in originals if c not in kinds] + [("missing_official_field", c) for c in (*TEXTS, *EMPTY) if c not in kinds]
    shape += [("wrong_array_type", c) for c in arrays if not isinstance(kinds.get(c), T.ArrayType)] + [("wrong_object_type", c) for c in maps if not isinstance(kinds.get(c), T.MapType | T.StructType)]
    spark = after.sparkSession
    out = spark.createDataFrame([("", code, field) for code, field in shape], "id string, code string, field string")
    for df, code in ((before, "original_count"), (after, "result_count")):
        out = out.union(df.agg(F.count("*").alias("n")).where(F.col("n") != expected).select(none, F.lit(code), none))
    twice = after.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("duplicate_document_id"), none)
    there = [c for c in originals if c in kinds]
    a, b = before.select("pos", F.col(key).alias("_k"), *[F.col(c).alias(f"_b_{c}") for c in there]), after.select("pos", F.col(key).alias("_l"), *there)
    side = a.join(b, "pos", "full_outer")
    order = side.where(~F.col("_k").eqNullSafe(F.col("_l"))).agg(F.count("*").alias("n")).where("n > 0").select(none, F.lit("document_order"), none)
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_b_{c}").eqNullSafe(F.col(c)), F.lit(c)) for c in there]))
    differ = side.where("_k is not null and _l is not null").select(F.col("_k"), F.lit("changed_original_field"), F.explode(changed))
    broken = findings(after, key, record_rules(after)).select(F.col(key), "code", none)
    return out.union(twice).union(order).union(differ).union(broken)
