"""Shapes of rows: derived and default columns, views, empty records and their contracts, the declared schema, selections."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.functions.text import blank, digits_price, full_name, trim_space
from prodlake.operators.records import numbered

COLUMN_KEYS = ("name", "category", "capacity", "price", "etc", "updated", "official", "image")
MATCH_STATUSES = ("confirmed", "review_required", "not_found", "not_applicable", "blocked_missing_key", "error", "pending")
IMAGE_KINDS = ("package", "pill", "label", "instruction", "product")
LICENSE = "공공데이터포털 이용허락범위 제한 없음"
#: P-04: columns of a row that no registry has been asked for yet.
ENRICHMENT_DEFAULTS: dict[str, object] = {
    "official_item_name": "", "official_manufacturer": "", "official_item_seq": "", "official_source_type": "", "official_source_url": "",
    "official_match_score": "", "official_match_status": "pending", "official_checked_at": "", "image_kind": "", "image_url": "",
    "image_source_url": "", "image_rights_status": "미확인", "image_checked_at": "", "enrichment_status": "pending",
}


def visible_columns(asked: Iterable[str], default: tuple[str, ...], known: tuple[str, ...] = COLUMN_KEYS) -> list[str]:
    """P-02: the known ones of those asked for, each once, else the default; the name is always among them, in front if it was not asked for."""
    chosen = list(dict.fromkeys(c for c in asked if c in known)) or list(default)
    return chosen if "name" in chosen else ["name", *chosen]


def derived(documents: DataFrame, originals: list[str], recorded_at: str, key: str = "document_id") -> DataFrame:
    """P-03: rows with a copy of every original field under `app_`, normalised names, a whole price, their place by key, and constants."""
    copies = {f"app_{c}": F.col(c) for c in originals}
    more = {
        "specification": blank(F.col("capacity")),
        "displayed_price_krw": digits_price(F.col("price").cast("string")),
        "normalized_name": full_name(F.col("name")),
        "normalized_capacity": full_name(F.col("capacity")),
        "recorded_at": F.lit(recorded_at),
        "image_url": F.lit(""),
        "image_source_url": F.lit(""),
        "image_rights_status": F.lit("미확인"),
    }
    return numbered(documents, key).withColumnRenamed("number", "source_order").withColumns({**copies, **more})


def with_defaults(df: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """P-04: columns that are absent are added with their default; those that are there stay, whatever they hold."""
    wanted = ENRICHMENT_DEFAULTS if defaults is None else defaults
    return df.withColumns({c: F.lit(v) for c, v in wanted.items() if c not in df.columns}) if set(wanted) - set(df.columns) else df


def candidate_view(records: DataFrame) -> DataFrame:
    """P-09: nested official records as flat candidates."""
    flat = {
        "official_product_key": "official_product_key", "item_name": "item_name", "manufacturer": "manufacturer", "pack_unit": "content.pack_unit",
        "dosage_form": "classification.dosage_form", "item_seq": "identifiers.item_seq", "barcode": "identifiers.barcode", "udi_di": "identifiers.udi_di",
        "report_number": "identifiers.report_number", "source_domain": "source_domain", "source_dataset_id": "provenance.source_dataset_id", "source_url": "provenance.source_url",
    }
    return records.select(*[blank(F.col(path)).alias(name) for name, path in flat.items()])


def research_rows(products: DataFrame, order: str) -> DataFrame:
    """P-10: products as rows of a research queue, numbered in order."""
    texts = ("name", "capacity", "category", "etc")
    official = ("match_status", "item_name", "manufacturer", "dosage_form", "pack_unit", "source_url")
    queue = numbered(products, order)
    return queue.select(
        F.col("number").alias("queue_index"),
        F.coalesce(F.nullif(blank(F.col("id")), F.lit("")), blank(F.col("document_id"))).alias("catalog_product_id"),
        blank(F.col("document_id")).alias("document_id"),
        *[blank(F.col(c)).alias(f"catalog_{c}") for c in texts],
        *[(blank(F.col(f"official_{c}")) if f"official_{c}" in products.columns else F.lit("")).alias(f"official_{c}") for c in official],
    )


def _empty(**fields: object) -> Column:
    """A struct of empty texts; a list names fields that are lists, a dict one that is a map."""
    kinds = {str: F.lit(""), list: F.array().cast("array<string>"), dict: F.create_map().cast("map<string,string>")}
    return F.struct(*[(kinds[v] if isinstance(v, type) else v).alias(k) for k, v in fields.items()])


def empty_record(domain: Column, dataset: Column, number: Column, name: Column) -> Column:
    """P-15: a canonical record that holds nothing but where it comes from; null if one of the four is blank."""
    told = [blank(c) != "" for c in (domain, dataset, number, name)]
    whole = F.struct(
        F.concat(domain, F.lit(":"), number).alias("official_product_key"), domain.alias("source_domain"), name.alias("item_name"), F.lit("").alias("manufacturer"),
        _empty(item_seq=number, barcode=str, standard_codes=list, report_number=str, udi_di=str).alias("identifiers"),
        _empty(category=str, dosage_form=str, route=str, atc_code=str, professional_or_general=str).alias("classification"),
        _empty(appearance=str, pack_unit=str, storage=str, valid_term=str, efficacy=str, dosage=str, precautions=str, professional_precautions=str, ingredients=list, active_ingredients=list, consumer_guidance=dict).alias("content"),
        _empty(efficacy=str, dosage=str, precautions=str, professional_precautions=str).alias("content_raw"),
        F.array().cast("array<struct<url:string,kind:string,source_url:string,license:string>>").alias("images"),
        _empty(source_dataset_id=dataset, source_record_id=number, source_url=str, license=F.lit(LICENSE), fetched_at=str, upstream_updated_at=str, raw_sha256=str).alias("provenance"),
    )
    return F.when(told[0] & told[1] & told[2] & told[3], whole)


def record_rules() -> dict[str, Column]:
    """V-08: what a canonical record must hold."""
    return {
        **{f"missing_{c}": F.col(c).isNull() for c in ("official_product_key", "source_domain", "item_name", "identifiers", "content", "provenance")},
        "key_of_other_domain": ~F.startswith(blank(F.col("official_product_key")), F.concat(blank(F.col("source_domain")), F.lit(":"))),
        "image_without_source": F.exists("images", lambda i: (blank(i["source_url"]) == "") | (blank(i["license"]) == "")),
    }


def match_rules() -> dict[str, Column]:
    """V-08: what a match must hold."""
    return {"unknown_status": ~F.coalesce(F.col("status").isin(*MATCH_STATUSES), F.lit(False)), "score_out_of_range": ~F.coalesce(F.col("score").between(0, 100), F.lit(False))}


def image_rules() -> dict[str, Column]:
    """V-08: what an image must hold."""
    https = lambda c: F.startswith(blank(F.col(c)), F.lit("https://"))
    return {"unknown_kind": ~F.coalesce(F.col("kind").isin(*IMAGE_KINDS), F.lit(False)), "not_https": ~(https("url") & https("source_url"))}


def match_record(status: Column, score: Column, key: Column, at: str) -> Column:
    """V-08: a match as a struct; who decided follows from the status."""
    return F.struct(
        blank(key).alias("official_product_key"), score.cast("int").alias("score"), status.alias("status"),
        F.when(status == "confirmed", "automatic").otherwise("pending_review").alias("decision_source"), F.lit("").alias("reviewer"), F.lit(at).alias("updated_at"),
    )


def declared_schema(kind: T.DataType, nullable: bool = False) -> dict:
    """V-17: the schema document of a record type: closed objects with all fields required, nullable values as a list of types."""
    names = {T.StringType: "string", T.BooleanType: "boolean", T.DoubleType: "number", T.FloatType: "number", T.DecimalType: "number"}
    if isinstance(kind, T.StructType):
        out: dict = {"type": "object", "additionalProperties": False, "required": kind.names, "properties": {f.name: declared_schema(f.dataType, f.nullable) for f in kind.fields}}
    elif isinstance(kind, T.ArrayType):
        out = {"type": "array", "items": declared_schema(kind.elementType, kind.containsNull)}
    elif isinstance(kind, T.MapType):
        out = {"type": "object", "additionalProperties": declared_schema(kind.valueType, kind.valueContainsNull)}
    else:
        out = {"type": "integer" if isinstance(kind, T.IntegralType) else names.get(type(kind), "string")}
    return {**out, "type": [out["type"], "null"]} if nullable else out


@dataclass(frozen=True)
class Selection:
    """U-08: keys picked one by one or by page, over any number of rows; `inverted` stands for all but these."""

    keys: frozenset[str] = frozenset()
    inverted: bool = False

    def toggle(self, key: str) -> Selection:
        return replace(self, keys=self.keys ^ {key})

    def page(self, keys: Iterable[str], selected: bool) -> Selection:
        """All keys of a page, in or out."""
        add = selected != self.inverted
        return replace(self, keys=self.keys | set(keys) if add else self.keys - set(keys))

    def everything(self) -> Selection:
        return Selection(inverted=True)

    def clear(self) -> Selection:
        return Selection()

    def applied(self, df: DataFrame, key: str) -> DataFrame:
        """The selected rows: what was clicked is few, so it is a literal of the plan."""
        held = F.col(key).cast("string").isin(*self.keys) if self.keys else F.lit(False)
        return df.where(~held if self.inverted else held)


def set_errors(entries: DataFrame, files: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """V-11, V-14: what is wrong with a set of batch files against its marker, in long form (file, code).

    entries: (file, sha256, first, last), as the marker states them; files: (file, sha256), as they are; rows: (file, key, place).
    Batches must be whole ranges of `size` places, one behind another, with one key a place and none twice in the set.
    """
    files_in, stated = files.withColumnRenamed("sha256", "_found"), entries.join(files.withColumnRenamed("sha256", "_found"), "file", "full_outer")
    code = F.when(F.col("_found").isNull(), "missing_file").when(F.col("sha256").isNull(), "unlisted_file").when(F.col("sha256") != F.col("_found"), "changed_file")
    by_file = stated.select("file", code.alias("code")).where("code is not null")
    counts = rows.groupBy("file").agg(F.count("*").alias("n"), F.countDistinct("place").alias("places"), F.min("place").alias("low"), F.max("place").alias("high"), F.count_if(trim_space(F.col("key")) == "").alias("blank"))
    held = entries.join(counts, "file")
    wrong = F.when(F.col("last") - F.col("first") + 1 != size, "wrong_size").when((F.col("n") != size) | (F.col("places") != size) | (F.col("low") != F.col("first")) | (F.col("high") != F.col("last")), "wrong_range").when(F.col("blank") > 0, "blank_key")
    by_range = held.select("file", wrong.alias("code")).where("code is not null")
    twice = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("file").alias("file")).where("n > 1").select("file", F.lit("repeated_key").alias("code")).distinct()
    return by_file.unionByName(by_range).unionByName(twice.join(files_in.select("file"), "file", "left_semi"))
