"""Registry records: parsing by source, fusing, materialising onto the catalogue, evidence gates and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodlake.functions.text import blank, clean_text, first_text, host, source_url, trim_space
from prodlake.operators.audit import findings

GUIDANCE = (
    ("summary", "무슨 약인가요"), ("efficacy", "효능·효과"), ("guide", "어떻게 복용하나요"), ("dosage", "복용 방법"), ("warning", "복용 전 경고"),
    ("precautions", "주의사항"), ("interactions", "상호작용"), ("side_effects", "부작용"), ("storage", "보관 방법"),
)
LOOKUP = {"confirmed": "found", "review_required": "found", "not_found": "not_found", "not_applicable": "not_applicable", "blocked_missing_key": "blocked", "error": "error"}
REQUIRED = {
    "drug": ("efficacy", "dosage", "precautions"),
    "quasi_drug": ("efficacy", "dosage"),
    "supplement": ("efficacy", "dosage", "precautions"),
    "cosmetic": ("manufacturer", "category"),
    "medical_device": ("manufacturer", "udi_di"),
    "food": ("manufacturer", "pack_unit", "image_url"),
}
OFFICIAL_HOSTS = ("health.kr", "www.health.kr", "common.health.kr")


@dataclass(frozen=True)
class Source:
    """S-10: where a registry's records come from, and which of its fields mean what."""

    key: str
    dataset: str
    domain: str
    endpoint: str
    parameter: str
    ids: tuple[str, ...]
    names: tuple[str, ...]
    makers: tuple[str, ...] = ()
    packs: tuple[str, ...] = ()
    barcodes: tuple[str, ...] = ()
    images: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    discovery: bool = True  # whether it can be searched by name, or only asked for a number

    def supports(self) -> Column:
        """S-11: the catalogue categories that it is searched for; all, if none are stated."""
        return F.col("category").isin(*self.categories) if self.categories else F.lit(True)


def parse_records(items: DataFrame, source: Source, fetched_at: str) -> DataFrame:
    """S-13: rows with `item` (map of the registry's fields) as flat official records; without id or name none."""
    field = lambda *names: first_text(*[F.try_element_at("item", F.lit(n)) for n in names]) if names else F.lit("")
    text = lambda *names: clean_text(field(*names))
    number = field(*source.ids)
    at = F.array_join(F.transform(F.array_sort(F.map_entries("item")), lambda e: F.concat(e["key"], F.lit("="), blank(e["value"]))), "\u001f")
    of = lambda *domains: F.when(F.lit(source.domain).isin(*domains), number).otherwise("")
    out = items.select(
        F.concat(F.lit(f"{source.domain}:"), number).alias("official_product_key"),
        F.lit(source.domain).alias("source_domain"),
        F.lit(source.dataset).alias("source_dataset_id"),
        field(*source.names).alias("item_name"),
        field(*source.makers).alias("manufacturer"),
        of("drug", "quasi_drug", "cosmetic").alias("item_seq"),
        of("supplement", "food").alias("report_number"),
        of("medical_device").alias("udi_di"),
        field(*source.barcodes).alias("barcode"),
        field(*source.packs).alias("pack_unit"),
        first_text(text("EE_DOC_DATA", "ee_doc_data"), text("efcyQesitm", "EFCY_QESITM"), text("MAIN_FNCTN", "EE_NAME")).alias("efficacy"),
        first_text(text("UD_DOC_DATA", "ud_doc_data"), text("useMethodQesitm", "USE_METHOD_QESITM"), text("SRV_USE", "USAGE_DOSAGE")).alias("dosage"),
        first_text(text("NB_DOC_DATA", "nb_doc_data"), text("atpnQesitm", "ATPN_QESITM"), text("INTAKE_HINT1")).alias("precautions"),
        text("STORAGE_METHOD", "PRSRV_PD", "depositMethodQesitm").alias("storage"),
        field("CLASS_NAME", "CLASS_NO", "PRDLST_NM").alias("category"),
        field("FORM_CODE_NAME", "DRUG_SHAPE", "MODEL_NM").alias("dosage_form"),
        F.when(F.startswith(field(*source.images), F.lit("https://")), field(*source.images)).otherwise("").alias("image_url"),
        source_url(source.endpoint, source.parameter, number).alias("source_url"),
        F.lit(fetched_at).alias("fetched_at"),
        F.sha2(at, 256).alias("raw_sha256"),
        number.alias("_number"),
    )
    return out.where("_number <> '' and item_name <> ''").drop("_number")


def completeness() -> Column:
    """M-07: complete, partial or pending by how many of the domain's required fields are filled."""
    out = F.lit(None).cast("string")
    for domain, fields in {**REQUIRED, "": ("item_name",)}.items():
        filled = sum((trim_space(F.col(c)) != "").cast("int") for c in fields)
        kind = F.when(filled == len(fields), "complete").when(filled > 0, "partial").otherwise("pending")
        out = F.coalesce(F.when((F.col("source_domain") == domain) | F.lit(domain == ""), kind), out) if domain else F.coalesce(out, kind)
    return out


def lookup_status(status: Column) -> Column:
    """D-13."""
    names = F.create_map(*[F.lit(x) for pair in LOOKUP.items() for x in pair])
    return F.coalesce(F.try_element_at(names, status), F.lit("pending"))


def materialise(products: DataFrame, matches: DataFrame, records: DataFrame) -> DataFrame:
    """J-01: catalogue rows with their match, and with the official record where it is confirmed.

    matches: (id, match_status, match_score, official_product_key), one row an id; records: parse_records().
    """
    kept = [c for c in ("item_name", "manufacturer", "efficacy", "dosage", "precautions", "image_url") if c in records.columns]
    right = records.select(F.col("official_product_key"), *[F.col(c).alias(f"official_{c}") for c in kept], completeness().alias("_content"))
    confirmed = matches.where("match_status = 'confirmed'").select(F.col("id").alias("_id"), "official_product_key")
    base = products.drop(*[f"official_{c}" for c in kept]).join(matches.select("id", "match_status", "match_score"), "id", "left")
    found = base.join(confirmed.join(right, "official_product_key", "left"), F.col("id") == F.col("_id"), "left")
    status = F.col("match_status")
    return found.withColumn("lookup_status", lookup_status(status)).withColumn(
        "enrichment_status",
        F.when(status.isNull(), "pending").when(status != "confirmed", status).when(F.col("_content").isNull(), "error").when(F.col("_content") == "complete", "complete").otherwise("partial"),
    ).drop("_id", "_content")


def rights_of(image_url: Column, page_url: Column) -> Column:
    """D-11: an official preview if both addresses are official, else verified."""
    both = host(image_url).isin(*OFFICIAL_HOSTS) & host(page_url).isin(*OFFICIAL_HOSTS[:2])
    return F.when(both, "official_source_preview").otherwise("verified")


def valid_image(url: Column) -> Column:
    """F-18, R-03: protocol-relative addresses completed; empty unless https and no placeholder."""
    text = trim_space(url)
    text = F.when(F.startswith(text, F.lit("//")), F.concat(F.lit("https:"), text)).otherwise(text)
    return F.when(F.startswith(text, F.lit("https://")) & (host(text) != "") & ~F.lower(text).rlike("noimage|no_image|placeholder|img_empty"), text).otherwise("")


def link_images(products: DataFrame, records: DataFrame) -> DataFrame:
    """J-04: evidence becomes a product's image if confirmed by hand and eye and its address is used once.

    records: (id, image_url, source_url, status, manual_verified, visual_verified). Adds `image_link`.
    """
    safe = (F.col("status") == "confirmed") & F.col("manual_verified").eqNullSafe(True) & F.col("visual_verified").eqNullSafe(True)
    tidy = records.select("id", valid_image(F.col("image_url")).alias("_url"), F.col("source_url").alias("_page"), safe.alias("_safe"))
    uses = tidy.where("_safe and _url <> ''").groupBy("_url").agg(F.count("*").alias("_uses"))
    joined = products.join(tidy.join(uses, "_url", "left"), "id", "left")
    good = F.col("_safe") & (F.col("_url") != "") & (F.col("_uses") == 1) & F.startswith(blank(F.col("_page")), F.lit("http"))
    link = F.when(F.col("_url").isNull(), "no_record").when(F.col("image_url") != "", "already_has_image").when(good, "linked").otherwise("not_linked")
    return joined.withColumn("image_link", link).withColumn("image_rights_status", F.when(link == "linked", rights_of(F.col("_url"), F.col("_page"))).otherwise(F.col("image_rights_status"))).withColumn(
        "image_url", F.when(link == "linked", F.col("_url")).otherwise(F.col("image_url"))
    ).drop("_url", "_page", "_safe", "_uses")


def compact_text(x: Column) -> Column:
    """T-21: line ends to one kind, no blanks before them, no empty lines."""
    text = F.regexp_replace(F.regexp_replace(blank(x), r"\r\n?", "\n"), r"[ \t]+\n", "\n")
    return trim_space(F.regexp_replace(text, r"\n[ \t]*\n+", "\n"))


def guidance_text(guidance: Column) -> Column:
    """T-21: labelled parts of a guidance map in fixed order."""
    parts = []
    for key, label in GUIDANCE:
        text = compact_text(F.try_element_at(guidance, F.lit(key)))
        parts.append(F.when(text != "", F.concat(F.lit(f"{label}\n"), text)))
    return F.concat_ws("\n\n", *parts)


def dedupe_labelled(items: Column) -> Column:
    """U-07: of (label, text) structs those whose text no earlier one equals or holds."""
    tidy = F.transform(items, lambda i: F.struct(i["label"].alias("label"), compact_text(i["text"]).alias("text")))

    def add(kept: Column, item: Column) -> Column:
        squeezed = lambda t: F.regexp_replace(t, r"\s+", " ")
        held = F.exists(kept, lambda k: F.contains(squeezed(k["text"]), squeezed(item["text"])))
        return F.when((item["text"] == "") | held, kept).otherwise(F.array_append(kept, item))

    return F.aggregate(tidy, F.filter(tidy, lambda i: F.lit(False)), add)


def status_rules() -> dict[str, Column]:
    """V-06: what must hold of a materialised row by its status."""
    status, content = F.col("match_status"), F.col("enrichment_status")
    ok = status == "confirmed"
    return {
        "bad_match_score": ~F.col("match_score").between(0, 100) | (status.isNotNull() & F.col("match_score").isNull()),
        "bad_status": ~status.isin("pending", *LOOKUP),
        "confirmed_without_record": ok & (content == "error"),
        "confirmed_missing_name": ok & (trim_space(F.col("official_item_name")) == ""),
        "unconfirmed_official_data": ~ok & (trim_space(F.col("official_item_name")) != ""),
        "image_without_rights": (F.col("image_url") != "") & (trim_space(F.col("image_rights_status")) == ""),
    }


def audit(materialised: DataFrame) -> DataFrame:
    return findings(materialised, "id", status_rules())


def protected_changes(before: DataFrame, after: DataFrame, key: str, protected: list[str], allowed: list[str]) -> DataFrame:
    """V-07: protected fields that differ without being allowed to, in long form."""
    fields = [c for c in sorted(protected) if c not in allowed]
    a, b = before.alias("a"), after.alias("b")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in fields]))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}")).select(F.col(f"a.{key}").alias(key), F.explode(changed).alias("field"))


def enrichment_summary(df: DataFrame) -> DataFrame:
    """A-05, A-09, A-15: one row of conditional counts; the share rounds half to even."""
    return df.agg(
        F.count("*").alias("products"),
        F.count_if(trim_space(F.col("official_item_name")) == "").alias("identity_missing"),
        F.count_if(F.col("image_url") == "").alias("image_missing"),
        F.count_if(F.col("image_rights_status").isin("", "미확인", "unverified")).alias("rights_unconfirmed"),
        F.count_if(F.col("match_status") == "confirmed").alias("confirmed"),
        F.bround(100 * F.count_if(F.col("match_status") == "confirmed") / F.greatest(F.count("*"), F.lit(1)), 1).alias("confirmed_percent"),
    )
