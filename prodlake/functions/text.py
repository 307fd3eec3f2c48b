"""Text, number, URL and hash functions as Columns: all stay in the JVM.

Every normaliser is its own rule; they differ in what they do with parentheses, markers and signs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
COMPANY_MARKERS = ("주식회사", "(주)", "㈜", "유한회사", "제약회사")
DOSAGE_FORMS = ("연질캡슐", "경질캡슐", "캡슐", "시럽", "현탁액", "액", "정", "환", "산", "과립", "크림", "연고", "겔", "스프레이", "패치")
PROMOTION = r"\((?:증정|기획|리뉴얼|색상|파랑|빨강)[^)]*\)"
NOTIFICATIONS = ("님에게 메시지를 보냈", "메시지가 도착", "카카오톡", "새 메시지")
PII = {
    "email": r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "mobile_phone": r"(?<!\d)01[016789][ -]?\d{3,4}[ -]?\d{4}(?!\d)",
    "resident_number": r"(?<!\d)\d{6}[ -]?[1-4]\d{6}(?!\d)",
}
DAMAGE = {
    "literal_br": r"(?im)(?:^\s*br\s*$|(?<=[가-힣0-9.!?\]\)])br(?=\s*(?:\n|$)))",
    "residual_html": r"</?[A-Za-z][^>]*>",
    "replacement_character": "�",
    "zero_width_character": "[​-‏⁠﻿]",
    "malformed_numeric_range": r"(?:\d\s*\?\s*\d|\[\d+\s*\?\s*[가-힣A-Za-z])",
    "literal_null": r"(?i)\b(?:undefined|null|nan)\b",
}


def blank(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def trim_space(x: Column) -> Column:
    """Trim all Unicode white space; the built-in trims U+0020 only."""
    return F.regexp_replace(blank(x), r"(?U)^\s+|\s+$", "")


def without(x: Column, *parts: str) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p), F.lit("")), parts, x)


def compact(x: Column) -> Column:
    """T-01: lower case, digits, a-z and Hangul syllables only."""
    return F.regexp_replace(F.lower(blank(x)), "[^0-9a-z가-힣]+", "")


def company(x: Column) -> Column:
    """T-02."""
    return compact(without(blank(x), *COMPANY_MARKERS))


def registry_name(x: Column) -> Column:
    """T-03: without promotional parentheses."""
    return compact(F.regexp_replace(blank(x), PROMOTION, ""))


def capacity(x: Column) -> Column:
    """T-04: units to one spelling."""
    units = (("캡슐", "cap"), ("정", "tab"), ("포", "sachet"))
    return compact(reduce(lambda c, u: F.replace(c, F.lit(u[0]), F.lit(u[1])), units, F.lower(blank(x))))


def plain_name(x: Column) -> Column:
    """T-05: without any parentheses."""
    return compact(F.regexp_replace(blank(x), r"\([^)]*\)", ""))


def full_name(x: Column) -> Column:
    """T-06: what stands in parentheses stays."""
    return compact(x)


def listing_name(x: Column) -> Column:
    """T-08: without tags, expiry dates and bundle counts."""
    text = F.lower(F.regexp_replace(blank(x), r"<[^>]+>", " "))
    text = F.regexp_replace(text, r"소비기한\s*\d+(?:[/.-]\d+)+", " ")
    return compact(F.regexp_replace(text, r"(?U)\b\d+\s*(?:개|세트|박스|병|통)\b", " "))


def search_name(x: Column) -> Column:
    """T-11: without a trailing quantity."""
    return trim_space(F.regexp_replace(blank(x), r"\s*\d+(?:\.\d+)?\s*(?:mg|g|ml|ea|정|캡슐|포|병|개)?\s*$", ""))


def split_size(x: Column) -> Column:
    """T-12: (name, size) of a text that may end in a size."""
    pattern = r"^(.*?)\s*(\d+(?:\.\d+)?\s*(?:mg|g|kg|ml|l|ea|정|캡슐|포|병|개))$"
    text = trim_space(x)
    size = F.regexp_extract(text, pattern, 2)
    return F.struct(F.when(size == "", text).otherwise(F.regexp_extract(text, pattern, 1)).alias("name"), size.alias("size"))


def squeeze(x: Column) -> Column:
    return trim_space(F.regexp_replace(blank(x), r"(?U)\s+", " "))


def display_text(x: Column) -> Column:
    """T-13 but for NFC (see udfs.nfc): zero-width characters go, odd blanks become blanks."""
    text = F.regexp_replace(blank(x), "[​-‏⁠﻿]", "")
    return trim_space(F.regexp_replace(F.translate(text, " 　", "  "), r"[ \t]+", " "))


def clean_text(x: Column) -> Column:
    """T-14 but for entities (see udfs.unescape): tags become blanks."""
    return squeeze(F.regexp_replace(blank(x), r"<[^>]+>", " "))


def parts(x: Column, delimiter: str) -> Column:
    """T-23: trimmed non-empty parts, the first of equal ones."""
    return F.array_distinct(F.filter(F.transform(F.split(blank(x), delimiter), trim_space), lambda p: p != ""))


def part(x: Column, delimiter: str, place: int) -> Column:
    """T-24: a part by its place from 0, empty if there are fewer."""
    return F.coalesce(trim_space(F.get(F.split(blank(x), delimiter), F.lit(place))), F.lit(""))


def dosage_form(x: Column) -> Column:
    """D-01: the first form of the list that occurs."""
    text = F.replace(blank(x), F.lit(" "), F.lit(""))
    return F.coalesce(*[F.when(F.contains(text, F.lit(f)), F.lit(f)) for f in DOSAGE_FORMS], F.lit(""))


def strengths(x: Column) -> Column:
    """D-05: distinct number-unit tokens in ascending order."""
    text = F.lower(blank(x))
    for a, b in (("밀리그램", "mg"), ("마이크로그램", "mcg"), ("그램", "g")):
        text = F.replace(text, F.lit(a), F.lit(b))
    found = F.regexp_extract_all(text, F.lit(r"(?<![0-9])([0-9]+(?:\.[0-9]+)?\s*(?:mg|mcg|μg|ug|g|%))"), F.lit(1))
    tidy = F.transform(found, lambda t: F.regexp_replace(F.regexp_replace(t, r"\s+", ""), "(?:μg|ug)$", "mcg"))
    return F.array_sort(F.array_distinct(tidy))


def pack_count(x: Column) -> Column:
    """D-06: the number before a piece unit, null if there is none."""
    return F.nullif(F.regexp_extract(blank(x), r"(\d+)\s*(?:ea|정|캡슐|포|병|개)", 1), F.lit("")).cast("int")


def parentheticals(x: Column) -> Column:
    """D-07: compacted contents of parentheses that are not bare quantities."""
    groups = F.regexp_extract_all(F.lower(blank(x)), F.lit(r"\(([^)]*)\)"), F.lit(1))
    tidy = F.transform(groups, compact)
    return F.array_sort(F.array_distinct(F.filter(tidy, lambda g: (g != "") & ~g.rlike(r"^\d+(?:\.\d+)?(?:mg|g|ml|정|캡슐|포|병|개)$"))))


def image_kind(url: Column) -> Column:
    """D-09: by the path."""
    low = F.lower(blank(url))
    return F.when(F.contains(low, F.lit("pack")), "package").when(F.contains(low, F.lit("pill")), "pill").when(F.contains(low, F.lit("label")), "label").otherwise("instruction")


def map_text(entries: Column) -> Column:
    """D-10: `key=value` of a map's entries in key order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(entries)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", ")


def digits_price(x: Column) -> Column:
    """N-01: all digits of a text as one number, 0 if there are none."""
    return F.coalesce(F.regexp_replace(blank(x), "[^0-9]", "").try_cast("bigint"), F.lit(0))


def positive_int(x: Column, fallback: int) -> Column:
    """N-04."""
    n = trim_space(x).try_cast("int")
    return F.when(n > 0, n).otherwise(F.lit(fallback))


def comparable_date(x: Column) -> Column:
    """C-02: the first eight digits, or empty."""
    digits = F.regexp_replace(blank(x), "[^0-9]", "")
    return F.when(F.length(digits) >= 8, F.substring(digits, 1, 8)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def official_url(url: Column, hosts: tuple[str, ...]) -> Column:
    """R-02: https on known hosts and for addresses without a scheme."""
    text = trim_space(url)
    text = F.when(F.startswith(text, F.lit("//")), F.concat(F.lit("https:"), text)).otherwise(text)
    return F.when(host(text).isin(*hosts), F.regexp_replace(text, "^http://", "https://")).otherwise(text)


def source_url(endpoint: str, key: str, value: Column) -> Column:
    """R-04."""
    return F.concat(F.lit(f"{endpoint}?{key}="), F.url_encode(blank(value)))


def first_text(*columns: Column) -> Column:
    """X-01: the first that is not blank, else empty."""
    return F.coalesce(*[F.nullif(trim_space(c), F.lit("")) for c in columns], F.lit(""))


def row_hash(*columns: Column) -> Column:
    """H-01 for flat rows: fields joined by an unlikely separator."""
    return F.sha2(F.concat_ws("\u001f", *[blank(c) for c in columns]), 256)


def csv_cell(x: Column) -> Column:
    """K-05: guarded against formulas, quoted where needed."""
    text = blank(x)
    text = F.when(text.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), text)).otherwise(text)
    return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def changed_fields(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """X-06: names of the fields that differ, in the order given."""
    return F.array_compact(F.array(*[F.when(~before[k].eqNullSafe(after[k]), F.lit(k)) for k in before]))
