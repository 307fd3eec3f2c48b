"""Audits as rule tables: one pass gives each row the codes of the rules it breaks."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.functions.text import DAMAGE, NOTIFICATIONS, PII, blank, trim_space


def broken_rules(rules: dict[str, Column]) -> Column:
    """Codes whose condition holds; a null condition does not hold."""
    return F.array_compact(F.array(*[F.when(c, F.lit(code)) for code, c in rules.items()]))


def findings(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """V-*: long form (key, code)."""
    return df.select(key, F.explode(broken_rules(rules)).alias("code"))


def catalog_rules() -> dict[str, Column]:
    """V-01, but for uniqueness, which repeated_keys() gives."""
    required = ("document_id", "id", "name", "category", "capacity", "updated")
    rules = {f"empty_{c}": trim_space(F.col(c)) == "" for c in required}
    return rules | {"price_not_positive": ~(F.coalesce(F.col("price"), F.lit(0)) > 0), "order_negative": F.col("pos") < 0}


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """U-05."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def text_rules(x: Column, patterns: dict[str, str] | None = None) -> dict[str, Column]:
    """F-15, F-21: damage and personal data in a text."""
    return {name: blank(x).rlike(p) for name, p in (patterns or {**DAMAGE, **PII}).items()}


def is_notification(*columns: Column) -> Column:
    """F-16."""
    return F.concat_ws(" ", *[blank(c) for c in columns]).rlike("|".join(NOTIFICATIONS))


def position_errors(df: DataFrame, key: str, order: str) -> DataFrame:
    """W-10: rows whose stated order is not their place (from 0) in the order of the key within a group."""
    place = F.row_number().over(Window.partitionBy("group").orderBy(key)) - 1
    return df.withColumn("place", place).where(F.col("place") != F.col(order))


def digest_groups(df: DataFrame, digest: str, member: str, identity: str) -> DataFrame:
    """A-11: digests that several rows share, with members, distinct identities and whether these differ."""
    groups = df.groupBy(digest).agg(F.count("*").alias("members"), F.countDistinct(identity).alias("identities"), F.min(member).alias("first_member"))
    return groups.where("members > 1").withColumn("unrelated", F.col("identities") > 1)


def field_widths(df: DataFrame) -> DataFrame:
    """A-12: how many rows carry how many non-null fields."""
    width = sum(F.col(c).isNotNull().cast("int") for c in df.columns)
    return df.groupBy(width.alias("width")).agg(F.count("*").alias("n"))


def field_hashes(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """V-09: the scaffold of a review: key, field, hash of its value, and whether it applies."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), blank(F.col(c)).alias("value")) for c in columns])
    long = df.select(key, F.explode(fields).alias("f"))
    return long.select(key, "f.field", F.sha2("f.value", 256).alias("value_sha256"), F.when(F.trim("f.value") != "", "applicable").otherwise("not_applicable").alias("applicability"))


def review_errors(ledger: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """V-10: broken rules of a ledger (key, field, value_sha256, decision, evidence, reviewer) against the scaffold."""
    a, b = ledger.alias("a"), baseline.alias("b")
    joined = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.field") == F.col("b.field")), "full_outer")
    missing, extra = F.col(f"a.{key}").isNull(), F.col(f"b.{key}").isNull()
    decided = F.coalesce(F.col("a.decision"), F.lit("pending")) != "pending"
    rules = {
        "missing_field": missing,
        "unknown_field": extra,
        "stale_hash": ~missing & ~extra & (F.col("a.value_sha256") != F.col("b.value_sha256")),
        "unknown_decision": ~missing & ~F.col("a.decision").isin("pending", "approved", "corrected", "rejected", "exception_approved"),
        "no_evidence": ~missing & decided & (F.coalesce(F.size("a.evidence"), F.lit(0)) == 0),
        "no_reviewer": ~missing & decided & (trim_space(F.col("a.reviewer")) == ""),
        "applies_wrongly": ~missing & ~extra & (F.col("b.applicability") == "not_applicable") & (F.col("a.decision") == "approved"),
    }
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), F.coalesce("a.field", "b.field").alias("field"), F.explode(broken_rules(rules)).alias("code"))


DECISIONS = ("pending", "approved", "corrected", "rejected", "exception_approved")


def ledger_errors(fields: DataFrame, evidence: DataFrame, corrections: DataFrame, records: DataFrame, scaffold: DataFrame, key: str, first: int, last: int, pending_allowed: bool = False) -> DataFrame:
    """V-10 in long form (key, field, code): what is wrong with a batch of reviews of the places `first` to `last`.

    fields: (key, field, value_sha256, applicability, decision, evidence_ids, provenance); evidence: (key, evidence_id, url, opened);
    corrections: (key, field, before_sha256, after, evidence_ids); records: (key, place, at, first_pass, second_pass, final),
    `at` being the row's own place in the batch; scaffold: (key, place, field, value_sha256, applicability), what was to be reviewed.
    """
    none = F.array().cast("array<string>")
    known = evidence.groupBy(F.col(key).alias("_n")).agg(F.collect_set("evidence_id").alias("_known"), F.collect_set(F.when(F.col("opened") & F.col("url").rlike("^https?://"), F.col("evidence_id"))).alias("_opened"))
    truth = scaffold.select(F.col(key).alias("_k"), F.col("field").alias("_f"), F.col("value_sha256").alias("_hash"), F.col("applicability").alias("_applies"))
    wanted = truth.join(records.select(F.col(key).alias("_k")), "_k", "left_semi")
    seen = fields.join(wanted, (F.col(key) == F.col("_k")) & (F.col("field") == F.col("_f")), "full_outer").join(known, F.coalesce(key, "_k") == F.col("_n"), "left").drop("_n")
    here, told = F.col(key).isNotNull(), F.coalesce(F.col("decision"), F.lit("pending")) != "pending"
    both = here & F.col("_k").isNotNull()
    ids, have = F.coalesce("evidence_ids", none), F.coalesce("_known", none)
    system = F.col("decision") == "exception_approved"
    rules = {
        "missing_field": ~here,
        "unknown_field": F.col("_k").isNull(),
        "stale_hash": both & (F.col("value_sha256") != F.col("_hash")),
        "wrong_applicability": both & (F.col("applicability") != F.col("_applies")),
        "unknown_decision": here & ~F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False)),
        "unknown_evidence": here & (F.size(F.array_except(ids, have)) > 0),
        "decision_without_evidence": here & told & ~system & (F.size(F.array_intersect(ids, have)) == 0),
        "no_provenance": here & told & (trim_space(F.col("provenance")) == ""),
    }
    by_field = seen.select(F.coalesce(key, "_k").alias(key), F.coalesce("field", "_f").alias("field"), F.explode(broken_rules(rules)).alias("code"))
    counted = corrections.groupBy(key, "field").agg(F.count("*").alias("_times"), F.first("before_sha256").alias("_before"), F.first("after").alias("_after"), F.flatten(F.collect_list("evidence_ids")).alias("_ids"))
    marked = fields.where("decision = 'corrected'").select(F.col(key).alias("_mk"), F.col("field").alias("_mf"))
    held = counted.join(marked, (F.col(key) == F.col("_mk")) & (F.col("field") == F.col("_mf")), "full_outer").join(truth, (F.coalesce(key, "_mk") == F.col("_k")) & (F.coalesce("field", "_mf") == F.col("_f")), "left")
    held = held.join(known, F.coalesce(key, "_mk") == F.col("_n"), "left").drop("_n")
    made = F.col("_times").isNotNull()
    by_correction = held.select(
        F.coalesce(key, "_mk").alias(key),
        F.coalesce("field", "_mf").alias("field"),
        F.explode(
            broken_rules(
                {
                    "marked_without_correction": ~made,
                    "correction_of_unknown_field": made & F.col("_k").isNull(),
                    "repeated_correction": F.col("_times") > 1,
                    "correction_not_marked": made & F.col("_mk").isNull(),
                    "correction_of_other_value": made & (F.col("_before") != F.col("_hash")),
                    "correction_without_change": made & (F.sha2("_after", 256) == F.col("_hash")),
                    "correction_without_opened_evidence": made & (F.size(F.array_intersect(F.coalesce("_ids", none), F.coalesce("_opened", none))) == 0),
                }
            )
        ).alias("code"),
    )
    places = scaffold.select(F.col(key).alias("_k"), F.col("place").alias("_place")).distinct()
    rows = records.join(places, F.col(key) == F.col("_k"), "full_outer").where(F.col(key).isNotNull() | F.col("_place").between(first, last))
    passes = [F.coalesce(F.col(c).isin(*DECISIONS), F.lit(False)) for c in ("first_pass", "second_pass", "final")]
    by_record = rows.select(
        F.coalesce(key, "_k").alias(key),
        F.lit("").alias("field"),
        F.explode(
            broken_rules(
                {
                    "missing_record": F.col(key).isNull(),
                    "record_out_of_range": F.col(key).isNotNull() & ~F.coalesce(F.col("_place").between(first, last), F.lit(False)),
                    "record_out_of_order": F.col("_place").between(first, last) & (F.col("at") != F.col("_place") - first),
                    "unknown_pass": F.col(key).isNotNull() & ~(passes[0] & passes[1]),
                    "unknown_final": F.col(key).isNotNull() & ~passes[2],
                    "pending_final": F.lit(not pending_allowed) & (F.col("final") == "pending"),
                }
            )
        ).alias("code"),
    )
    twice = records.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key, F.lit("").alias("field"), F.lit("repeated_record").alias("code"))
    return by_field.unionByName(by_correction).unionByName(by_record).unionByName(twice)


def ledger_summary(records: DataFrame, fields: DataFrame) -> DataFrame:
    """V-10: one row of the numbers that a batch states of itself."""
    both = records.select(F.lit("p").alias("of"), (F.col("final") == "pending").alias("open")).union(fields.select(F.lit("f"), F.lit(False)))
    return both.agg(F.count_if(F.col("of") == "p").alias("products"), F.count_if(F.col("open")).alias("pending"), F.count_if(F.col("of") == "f").alias("field_reviews"))


_KINDS: dict[str, Callable[[object], bool]] = {
    "null": lambda v: v is None,
    "boolean": lambda v: isinstance(v, bool),
    "string": lambda v: isinstance(v, str),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
}
#: A check yields (place below the value, message) of what is wrong.
Check = Callable[[object], Iterator[tuple[str, str]]]


def _limit(keyword: str, bound: float) -> Check:
    measure, kind, message = {"minLength": (len, "string", "too short"), "minimum": (lambda v: v, "number", "too small")}[keyword]

    def check(value: object) -> Iterator[tuple[str, str]]:
        if _KINDS[kind](value) and measure(value) < bound:
            yield "", message

    return check


def _members(known: dict[str, Check], required: list[str], others: Check | bool) -> Check:
    def check(value: object) -> Iterator[tuple[str, str]]:
        if not isinstance(value, dict):
            return
        for name in required:
            if name not in value:
                yield f".{name}", "missing"
        for name, member in value.items():
            rule = known.get(name, others)
            if rule is False:
                yield f".{name}", "unknown"
            elif callable(rule):
                yield from ((f".{name}{at}", message) for at, message in rule(member))

    return check


def _elements(rule: Check) -> Check:
    def check(value: object) -> Iterator[tuple[str, str]]:
        for k, item in enumerate(value if isinstance(value, list) else []):
            yield from ((f"[{k}]{at}", message) for at, message in rule(item))

    return check


def compiled(schema: dict) -> Check:
    """V-03: oneOf, const, type, required, additionalProperties, items, minLength and minimum, made once into a list of checks.

    What is of another type, or not the constant, or does not fit one of the choices, is not looked into further.
    """
    choices = [compiled(s) for s in schema.get("oneOf", [])]
    kinds = [schema["type"]] if isinstance(schema.get("type"), str) else schema.get("type", [])
    checks = [_limit(k, schema[k]) for k in ("minLength", "minimum") if k in schema]
    if "items" in schema:
        checks.append(_elements(compiled(schema["items"])))
    others = schema.get("additionalProperties", True)
    checks.append(_members({k: compiled(s) for k, s in schema.get("properties", {}).items()}, schema.get("required", []), compiled(others) if isinstance(others, dict) else others))

    def check(value: object) -> Iterator[tuple[str, str]]:
        fits = sum(next(c(value), None) is None for c in choices)
        gates = (
            (bool(choices) and fits != 1, f"fits {fits} of oneOf"),
            ("const" in schema and value != schema.get("const"), "not the constant"),
            (bool(kinds) and not any(_KINDS[k](value) for k in kinds), f"not of type {'/'.join(kinds)}"),
        )
        wrong = next((message for bad, message in gates if bad), None)
        if wrong is not None:
            yield "", wrong
        elif not choices:
            for c in checks:
                yield from c(value)

    return check


def schema_errors(value: object, schema: dict | Check) -> list[str]:
    """V-03 for one value."""
    check = schema if callable(schema) else compiled(schema)
    return [f"${at}: {message}" for at, message in check(value)]


def json_errors(schema: dict):
    """V-03 as an Arrow UDF over JSON texts; the schema is compiled once a batch."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def check(texts: pd.Series) -> pd.Series:
        rules = compiled(schema)

        def one(t: str | None) -> list[str]:
            try:
                return schema_errors(json.loads(t or ""), rules)
            except ValueError:
                return ["$: no JSON"]

        return texts.map(one)

    return check
