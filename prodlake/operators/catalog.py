"""The catalogue query: search, filter, stable sort, paging, facets, summary and export columns."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from urllib.parse import parse_qs, urlencode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.functions.text import blank, comparable_date, host, trim_space
from prodlake.operators.records import sliced
from prodlake.operators.ranks import median

POSITIVE = ("확정", "연결", "연결됨", "검증 완료", "confirmed", "linked", "verified")
NEGATIVE = ("미연결", "검수 대기", "후보", "unlinked", "pending", "candidate", "not_found", "not_applicable", "review_required")
IMAGE_RIGHTS = ("approved", "verified", "official", "official_source_preview", "public_domain", "open_license", "재사용 가능", "공공누리", "공식 공개")
SORTS = ("source", "name", "price_asc", "price_desc", "category", "updated")
PAGE_SIZES = (25, 50, 100)
#: Rows that one task may sort for a page.
NEAR = 10_000


@dataclass(frozen=True)
class CatalogQuery:
    """Filters, order and page of a catalogue view; compiled to DataFrame operators by run()."""

    search: str = ""
    categories: tuple[str, ...] = ()
    min_price: int | None = None
    max_price: int | None = None
    min_date: str = ""
    max_date: str = ""
    note: str = "all"
    official: str = "all"
    image: str = "all"
    sort: str = "source"
    page: int = 1
    page_size: int = 25
    columns: tuple[str, ...] = field(default=("name", "category", "price"))

    @classmethod
    def from_params(cls, text: str) -> CatalogQuery:
        """S-23: from a URL's query string; what is unknown or out of range falls back to the default."""
        got = parse_qs(text.lstrip("?"), keep_blank_values=True)
        one = lambda k: got.get(k, [""])[0].strip()
        whole = lambda k: int(one(k)) if one(k).isdecimal() else None
        choice = lambda k, allowed, default: one(k) if one(k) in allowed else default
        columns = tuple(dict.fromkeys(["name", *[c for c in one("cols").split(",") if c and c != "name"]])) if one("cols") else cls().columns
        return cls(
            search=one("q"),
            categories=tuple(c for c in got.get("category", []) if c),
            min_price=whole("min"),
            max_price=whole("max"),
            min_date=one("from"),
            max_date=one("to"),
            note=choice("note", ("with", "without"), "all"),
            official=one("official") or "all",
            image=choice("image", ("with", "without"), "all"),
            sort=choice("sort", SORTS, "source"),
            page=max(1, whole("page") or 1),
            page_size=int(choice("size", [str(s) for s in PAGE_SIZES], "25")),
            columns=columns,
        )

    def to_params(self) -> str:
        """K-15: the query string without defaults."""
        names = {"search": "q", "min_price": "min", "max_price": "max", "min_date": "from", "max_date": "to", "page_size": "size", "columns": "cols", "categories": "category"}
        default, out = CatalogQuery(), []
        for f in fields(self):
            value = getattr(self, f.name)
            if value != getattr(default, f.name):
                key = names.get(f.name, f.name)
                out += [(key, v) for v in value] if f.name == "categories" else [(key, ",".join(value) if f.name == "columns" else value)]
        return urlencode(out)

    def active_filters(self) -> int:
        """F-23."""
        default = CatalogQuery()
        return sum(
            any(getattr(self, n) != getattr(default, n) for n in group)
            for group in (("search",), ("categories",), ("min_price", "max_price"), ("min_date", "max_date"), ("note",), ("official",), ("image",))
        )


def haystack(df: DataFrame) -> Column:
    """F-02: searched fields and every text of an official column, joined by one blank, in lower case."""
    official = [f.name for f in df.schema.fields if f.name.startswith("official_") and f.dataType.simpleString() == "string"]
    return F.lower(F.concat_ws(" ", *[blank(F.col(c)) for c in ("name", "capacity", "category", "etc", "document_id", "id", *official)]))


def has_official(df: DataFrame) -> Column:
    """F-09: by status, else whether any official column besides status, score and times is present."""
    status = F.lower(trim_space(F.col("official_match_status")))
    present = F.lit(False)
    for f in df.schema.fields:
        bookkeeping = f.name.endswith(("status", "score", "candidate", "checked_at", "matched_at"))
        if f.name.startswith("official_") and not bookkeeping:
            kind = f.dataType.simpleString()
            value = F.col(f.name)
            here = trim_space(value) != "" if kind == "string" else value.eqNullSafe(True) if kind == "boolean" else value.isNotNull()
            present = present | F.coalesce(here, F.lit(False))
    return F.when(status.isin(*POSITIVE), True).when(status.isin(*NEGATIVE), False).otherwise(present)


def has_image() -> Column:
    """F-10: the rights status contains one of the words, so `unverified` passes too."""
    rights = F.lower(blank(F.col("image_rights_status")))
    return (trim_space(F.col("image_url")) != "") & rights.rlike("|".join(IMAGE_RIGHTS))


def approved_image() -> Column:
    """F-11: the rights status is one of the words, and the address is https."""
    return F.col("image_rights_status").isin(*IMAGE_RIGHTS) & F.startswith(F.lower(blank(F.col("image_url"))), F.lit("https://")) & (host(F.col("image_url")) != "")


def filter_catalog(df: DataFrame, q: CatalogQuery) -> DataFrame:
    """F-01."""
    out = df
    if q.search.strip():
        out = out.where(F.contains(haystack(df), F.lit(q.search.strip().lower())))
    if q.categories:
        out = out.where(F.col("category").isin(*q.categories))
    if q.min_price is not None:
        out = out.where(F.col("price") >= q.min_price)
    if q.max_price is not None:
        out = out.where(F.col("price") <= q.max_price)
    if q.min_date or q.max_date:
        day = comparable_date(F.col("updated"))
        out = out.where(day != "")
        digits = lambda d: "".join(c for c in d if c.isdigit())[:8]
        out = out.where(day >= digits(q.min_date)) if q.min_date else out
        out = out.where(day <= digits(q.max_date)) if q.max_date else out
    if q.note != "all":
        noted = F.length(trim_space(F.col("etc"))) > 0
        out = out.where(noted if q.note == "with" else ~noted)
    if q.official == "linked":
        out = out.where(has_official(df))
    elif q.official == "unlinked":
        out = out.where(~has_official(df))
    elif q.official != "all":
        out = out.where(F.col("official_match_status") == q.official)
    if q.image != "all":
        out = out.where(has_image() if q.image == "with" else ~has_image())
    return out


def natural_key(x: Column) -> Column:
    """O-01: a key whose binary order is numeric-aware: a run of digits is its length without leading zeros, then itself."""
    runs = F.regexp_extract_all(F.lower(blank(x)), F.lit(r"(\d+|\D+)"), F.lit(1))
    bare = lambda r: F.regexp_replace(r, r"^0+(?=\d)", "")
    keyed = F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.concat(F.lpad(F.length(bare(r)).cast("string"), 6, "0"), bare(r))).otherwise(r))
    return F.array_join(keyed, "")


def korean_key(x: Column) -> Column:
    """O-01: numeric-aware Korean order: digits, Hangul, then other letters, whatever their case and accents.

    The collation knows no numbers, so runs of digits are written with their length first; all else is the collation's.
    """
    return F.collate(natural_key(x), "ko_CI_AI")


def order_of(sort: str) -> list[Column]:
    """Keys that all go upwards; the last is the row's own place, so that no two rows are alike."""
    name, price, day = korean_key(F.col("name")), F.col("price"), comparable_date(F.col("updated"))
    keys = {
        "name": [name],
        "price_asc": [price.isNotNull(), price],
        "price_desc": [price.isNull(), -price],
        "category": [korean_key(F.col("category")), name],
        "updated": [day == "", F.translate(day, "0123456789", "9876543210")],
    }
    return [*keys.get(sort, []), F.col("pos")]


def page_of(df: DataFrame, q: CatalogQuery) -> DataFrame:
    """O-02: one page in order, with its place; the page is clamped to those there are.

    The count is a small job of its own. A page near either end is a bounded top-k from that end; any other is
    cut from numbered ranges, so that no task sorts more than NEAR rows or its own range.
    """
    total = df.count()
    size = q.page_size if q.page_size in PAGE_SIZES else PAGE_SIZES[0]
    page = min(max(1, q.page), max(1, -(-total // size)))
    first = (page - 1) * size
    keys = order_of(q.sort)
    if first + size <= NEAR:
        top = df.orderBy(*keys).limit(first + size)
        return top.withColumn("place", F.row_number().over(Window.orderBy(*keys))).where(F.col("place") > first)
    if total - first <= NEAR:
        top = df.orderBy(*[k.desc() for k in keys]).limit(total - first)
        return top.withColumn("place", (F.row_number().over(Window.orderBy(*keys)) + first).cast("int")).where(F.col("place") <= first + size)
    placed = sliced(df.withColumn("_order", F.struct(*[k.alias(f"k{n}") for n, k in enumerate(keys)])), "_order", first, size)
    return placed.withColumn("place", F.col("number").cast("int")).drop("_order", "number")


def run(df: DataFrame, q: CatalogQuery) -> DataFrame:
    """Filter, sort, page and project (P-01: columns in the table's order, `name` always among them)."""
    wanted = {"name", *q.columns}
    return page_of(filter_catalog(df, q), q).select("place", *[c for c in df.columns if c in wanted])


def page_window(page: int, last: int, buttons: int = 5) -> list[int]:
    """O-03."""
    first = max(1, min(page - buttons // 2, last - buttons + 1))
    return list(range(first, min(last, first + buttons - 1) + 1))


def summary(df: DataFrame) -> DataFrame:
    """A-01: one row; prices over positive ones, 0 if there are none."""
    price = F.when(F.col("price") > 0, F.col("price"))
    middle = median(df, price) or 0.0
    return df.agg(
        F.count("*").alias("total"),
        F.countDistinct("category").alias("categories"),
        F.coalesce(F.min(price), F.lit(0)).alias("min_price"),
        F.coalesce(F.max(price), F.lit(0)).alias("max_price"),
        F.lit(middle).alias("median_price"),
        F.count_if(F.length(trim_space(F.col("etc"))) > 0).alias("with_note"),
        F.count_if(has_official(df)).alias("with_official"),
        F.count_if(has_image()).alias("with_image"),
    )


def facets(df: DataFrame, column: str, empty: str = "미분류") -> DataFrame:
    """A-02: counts by value, the most frequent first, equal ones by first appearance."""
    value = F.coalesce(F.nullif(trim_space(F.col(column)), F.lit("")), F.lit(empty))
    return df.groupBy(value.alias(column)).agg(F.count("*").alias("n"), F.min("pos").alias("first_pos")).orderBy(F.desc("n"), "first_pos")


def export_name(scope: str, form: str, day: str, prefix: str = "catalog") -> str:
    """K-07: prefix, scope with anything but letters, digits, Hangul, _ and - as one _, day."""
    safe = "".join(c if c.isascii() and c.isalnum() or "가" <= c <= "힣" or c in "_-" else "_" for c in scope.strip())
    while "__" in safe:
        safe = safe.replace("__", "_")
    return f"{prefix}_{safe or '전체'}_{day}.{form}"
