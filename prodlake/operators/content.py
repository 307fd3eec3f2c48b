"""Content of records: cleaned lists, guidance, nested values, the normalisation of a whole record, rendering and the detail view."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.functions.rich_text import parse, parsed_text, rich_text
from prodlake.functions.text import blank, changed_fields, display_text, trim_space
from prodlake.operators.official import compact_text, dedupe_labelled, guidance_text

NORMALIZATION = "catalog-text-v1"
DISPLAY_FIELDS = ("name", "capacity", "category", "etc", "specification")
#: Upstream field -> public field.
RAW_FIELDS = {"effect": "official_efficacy", "dosage": "official_dosage", "caution": "official_precautions", "stmt": "official_storage", "charact_new": "official_appearance"}
STRUCTURED = {"efficacy": "official_efficacy", "dosage": "official_dosage", "precautions": "official_precautions"}
GUIDANCE_KEYS = ("summary", "efficacy", "guide", "dosage", "warning", "precautions", "interactions", "side_effects", "storage")


def health_text(x: Column) -> Column:
    """T-17: markup to plain paragraphs."""
    return rich_text(x)["text"]


def ingredient(text: Column) -> Column:
    """T-17, of a health text: without a slash at the end."""
    return trim_space(F.regexp_replace(blank(text), r"\s*/\s*$", ""))


def interaction(text: Column) -> Column:
    """T-17, of a health text: without the word of the copy button at the end."""
    return trim_space(F.regexp_replace(blank(text), r"(?:\n\s*)*복사\s*$", ""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def health_texts(values: pd.Series) -> pd.Series:
    """T-18: each text of a list by itself."""
    return values.map(lambda texts: None if texts is None else [parsed_text(t) for t in texts])


def string_list(x: Column, tidy=lambda t: t) -> Column:
    """T-18: cleaned texts of a list, without empty ones, the first of equals; a null list is empty."""
    texts = F.transform(health_texts(F.coalesce(x, F.array().cast("array<string>"))), tidy)
    return F.array_distinct(F.filter(texts, lambda t: t != ""))


def guidance(x: Column, keys: tuple[str, ...] = ()) -> Column:
    """T-18, T-20: the entries of a map with text, cleaned, of the keys allowed, if any are stated."""
    cleaned = F.map_from_arrays(F.map_keys(x), health_texts(F.map_values(x)))
    return F.map_filter(cleaned, lambda k, v: (trim_space(v) != "") & (k.isin(*keys) if keys else F.lit(True)))


def relocated(x: Column, additional: Column) -> Column:
    """T-20: a guidance's own page address and text as entries of another map, where they are not there yet."""
    moved = F.map_filter(F.create_map(F.lit("source_url"), F.try_element_at(x, F.lit("source_url")), F.lit("text"), F.try_element_at(x, F.lit("full_text"))), lambda k, v: blank(v) != "")
    kept = F.map_filter(F.coalesce(additional, F.create_map().cast("map<string,string>")), lambda k, v: blank(v) != "")
    return F.map_concat(kept, F.map_filter(moved, lambda k, v: ~F.map_contains_key(kept, k)))


def clean_list(x: Column, kind: T.DataType) -> Column:
    """X-04: cleaned texts of a list, or of one text as a list of one."""
    texts = x if isinstance(kind, T.ArrayType) else F.array(x.cast("string"))
    return F.filter(F.transform(F.coalesce(texts, F.array().cast("array<string>")), lambda t: trim_space(F.regexp_replace(blank(t), r"\s+", " "))), lambda t: t != "")


def _walk(value: object, leaf, join) -> object:
    """A nested value rebuilt from its leaves up."""
    if isinstance(value, list):
        return join([(None, _walk(v, leaf, join)) for v in value], list)
    if isinstance(value, dict):
        return join([(k, _walk(v, leaf, join)) for k, v in value.items()], dict)
    return leaf(value)


def _json_udf(leaf, join, finish):
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                return None if t is None else finish(_walk(json.loads(t), leaf, join))
            except ValueError:
                return None

        return texts.map(one)

    return run


def _rebuilt(parts: list[tuple], kind: type) -> object:
    return [v for _, v in parts] if kind is list else dict(parts)


def _tidy(text: str) -> str:
    lines = [line.rstrip(" \t") for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    return "\n".join(line for line in lines if line.strip(" \t")).strip()


def _rendered(parts: list[tuple], kind: type) -> str:
    if kind is list:
        return " · ".join(v for _, v in parts if v)
    return "\n".join(f"{k}: {v}" for k, v in parts if v)


def _shown(value: object) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return _tidy(value) if isinstance(value, str) else "" if value is None else f"{value:g}" if isinstance(value, float) else str(value)


_COPY = "복사"


def _interaction_leaf(value: object) -> object:
    if not isinstance(value, str):
        return value
    text = parse(value)["text"].rstrip()
    return text.removesuffix(_COPY).strip() if text.endswith(_COPY) else text.strip()


#: T-18: JSON of nested values, every text in it cleaned as an interaction; null where it is no JSON.
interactions = _json_udf(_interaction_leaf, _rebuilt, lambda v: json.dumps(v, ensure_ascii=False, separators=(",", ":")))
#: T-22: JSON of nested values as text: members of lists parted by dots, those of objects as lines with their names.
structured_text = _json_udf(_shown, _rendered, lambda v: v)


def text_value(x: Column) -> Column:
    """T-22: the non-empty texts of a list, parted by dots."""
    return compact_text(F.array_join(F.filter(x, lambda t: blank(t) != ""), " · "))


def normalise(products: DataFrame, sources: DataFrame, key: str = "document_id") -> DataFrame:
    """T-19: display fields squeezed; confirmed rows take the texts of their upstream record, where there is one.

    products: key, display fields, official_match_status, official_item_seq, public fields; sources: (code, raw), raw a map of
    upstream texts, one row a code (S-25). Adds content_status, source_cache and changed_fields, the names of fields that differ.
    """
    public = [f for f in RAW_FIELDS.values() if f in products.columns]
    shown = [f for f in DISPLAY_FIELDS if f in products.columns]
    confirmed = F.col("official_match_status") == "confirmed"
    joined = products.join(sources.select(F.col("code").alias("_code"), F.col("raw").alias("_raw")), confirmed & (F.col("official_item_seq") == F.col("_code")), "left")
    joined = joined.withColumns({f"_b_{f}": F.col(f) for f in (*shown, *public)})
    raw = lambda f: F.nullif(F.try_element_at("_raw", F.lit(f)), F.lit(""))
    upstream = {p: F.coalesce(raw(r), raw("charact")) if r == "charact_new" else raw(r) for r, p in RAW_FIELDS.items()}
    out = joined.withColumns({f: display_text(F.col(f)) for f in shown})
    out = out.withColumns({p: F.when(confirmed, health_text(F.coalesce(upstream[p], F.col(p)))).otherwise(F.col(p)) for p in public})
    status = F.when(~confirmed, "").when(F.col("_raw").isNotNull(), "normalized_from_upstream_cache").otherwise("normalized_from_canonical")
    changed = F.array_sort(changed_fields({f: F.col(f"_b_{f}") for f in (*shown, *public)}, {f: F.col(f) for f in (*shown, *public)}))
    return out.withColumns({"content_status": status, "source_cache": F.col("_raw").isNotNull(), "changed_fields": changed}).select(
        *[c for c in products.columns], "content_status", "source_cache", "changed_fields"
    )


def content_sections(products: DataFrame) -> Column:
    """T-19: the rich sections of a record that hold text."""
    parts = [F.when(trim_space(F.col(f)) != "", F.struct(F.lit(k).alias("section"), rich_text(F.col(f)).alias("rich"))) for k, f in STRUCTURED.items() if f in products.columns]
    return F.filter(F.array_compact(F.array(*parts)), lambda s: s["rich"]["text"] != "")


#: P-08: groups of the detail view: title and (label, column).
DETAIL_GROUPS = (
    ("효능과 복용", (("효능·효과", "official_efficacy"), ("용법·용량", "official_dosage"), ("사용상의 주의사항", "official_precautions"), ("전문가 주의사항", "official_professional_precautions"))),
    ("성분", (("유효성분", "official_active_ingredients"), ("전체 성분", "official_ingredients"), ("첨가제", "official_additives"))),
    ("복약 정보", (("소비자 복약정보", "official_consumer_guidance"), ("복약 안내", "official_patient_guidance"), ("의약품 설명", "official_medication_summary"), ("복약지도", "official_medication_guide"))),
    ("제품 정보", (("저장방법", "official_storage"), ("제품 성상", "official_appearance"), ("식별정보", "official_identification"), ("의약품 분류", "official_category"), ("ATC 분류", "official_atc_code"), ("KPIC 약효분류", "official_kpic_atc"))),
    (
        "복용 금기·주의 정보",
        (("DUR 병용금기", "official_dur_contraindications"), ("DUR 연령금기", "official_dur_age"), ("DUR 임부금기", "official_dur_pregnancy"), ("DUR 고령자 주의", "official_dur_senior"), ("DUR 최대용량", "official_dur_max_dose"), ("DUR 최대투여기간", "official_dur_max_period"), ("DUR 분할주의", "official_dur_split_dosage")),
    ),
)


def detail_view(df: DataFrame) -> Column:
    """P-08: groups (title, items of label and text) of the columns that a table has; empty texts and groups are left out."""

    def text(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, T.MapType):
            return guidance_text(F.col(c))
        return text_value(F.col(c)) if isinstance(kind, T.ArrayType) else compact_text(F.col(c))

    groups = []
    for title, members in DETAIL_GROUPS:
        items = [F.struct(F.lit(label).alias("label"), text(c).alias("text")) for label, c in members if c in df.columns]
        if items:
            groups.append(F.struct(F.lit(title).alias("title"), dedupe_labelled(F.array(*items)).alias("items")))
    return F.filter(F.array(*groups), lambda g: F.size(g["items"]) > 0)
