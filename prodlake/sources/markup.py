"""Page scans: links and tables, sections by id, result rows, embedded JSON, and walks over JSON trees.

All take one text a row and return structs, arrays or rows in Arrow batches; nothing is fetched.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXTS = T.ArrayType(T.StringType())
PAGE = (
    T.StructType()
    .add("title", "string")
    .add("links", T.ArrayType(T.StructType().add("href", "string").add("text", "string")))
    .add("tables", T.ArrayType(T.ArrayType(_TEXTS)))
    .add("images", _TEXTS)
)
_HIDDEN = frozenset(("script", "style", "template"))


def squeeze(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


class _Page(HTMLParser):
    """Collects title, links, tables (of the innermost table a cell is in) and image addresses."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: list[str] = []
        self.links: list[dict] = []
        self.tables: list[list[list[list[str]]]] = []
        self.images: list[str] = []
        self.sinks: list[tuple[str, list[str]]] = []
        self.nest: list[list] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        at = dict(attrs)
        if tag in _HIDDEN:
            self.hidden += 1
        elif tag == "title":
            self.sinks.append((tag, self.title))
        elif tag == "a":
            link = {"href": at.get("href") or "", "text": []}
            self.links.append(link)
            self.sinks.append((tag, link["text"]))
        elif tag == "img":
            self.images.append(at.get("src") or at.get("data-src") or "")
        elif tag == "table":
            self.tables.append([])
            self.nest.append(self.tables[-1])
        elif tag == "tr" and self.nest:
            self.nest[-1].append([])
        elif tag in ("td", "th") and self.nest:
            if not self.nest[-1]:
                self.nest[-1].append([])
            cell: list[str] = []
            self.nest[-1][-1].append(cell)
            self.sinks.append((tag, cell))

    def handle_endtag(self, tag: str) -> None:
        if tag in _HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        if tag == "table" and self.nest:
            self.nest.pop()
        for k in range(len(self.sinks) - 1, -1, -1):
            if self.sinks[k][0] == tag:
                del self.sinks[k:]
                break

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            for _, sink in self.sinks:
                sink.append(data)

    def record(self) -> dict:
        return {
            "title": squeeze(self.title),
            "links": [{"href": link["href"], "text": squeeze(link["text"])} for link in self.links],
            "tables": [[[squeeze(c) for c in row] for row in t] for t in self.tables],
            "images": [i for i in self.images if i],
        }


def parse_page(text: str | None) -> dict:
    reader = _Page()
    reader.feed(text or "")
    reader.close()
    return reader.record()


@F.pandas_udf(PAGE)
def page(text: pd.Series) -> pd.DataFrame:
    """S-14, S-16: title, links, tables and images of a page."""
    rows = [parse_page(t) for t in text]
    return pd.DataFrame({f.name: [r[f.name] for r in rows] for f in PAGE.fields})


class _Sections(HTMLParser):
    def __init__(self, wanted: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.found, self.open = wanted, {}, []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        name = dict(attrs).get("id") or ""
        if name in self.wanted and name not in self.found:
            self.found[name] = []
            self.open.append([tag, 0, name])
        for entry in self.open:
            entry[1] += entry[0] == tag
        if tag in ("br", "p", "li", "tr", "div"):
            self.handle_data("\n")

    def handle_endtag(self, tag: str) -> None:
        for entry in self.open:
            entry[1] -= entry[0] == tag
        self.open = [e for e in self.open if e[1] > 0]

    def handle_data(self, data: str) -> None:
        for _, _, name in self.open:
            self.found[name].append(data)


def parse_sections(text: str | None, wanted: frozenset[str]) -> dict[str, str]:
    """S-17: text of the elements with these ids, the first of each; lines are squeezed."""
    reader = _Sections(wanted)
    reader.feed(text or "")
    reader.close()
    lines = lambda parts: [" ".join(x.split()) for x in "".join(parts).split("\n")]
    return {k: "\n".join(x for x in lines(v) if x) for k, v in reader.found.items()}


def sections(ids: list[str]):
    wanted = frozenset(ids)

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def read(text: pd.Series) -> pd.Series:
        return text.map(lambda t: parse_sections(t, wanted))

    return read


def embedded_json(marker: str):
    """S-15: the JSON value that begins after a marker, as canonical text; null if there is none."""
    @F.pandas_udf(T.StringType())
    def read(text: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            at = (t or "").find(marker)
            if at < 0:
                return None
            try:
                value, _ = json.JSONDecoder().raw_decode(t[at + len(marker) :].lstrip(" =:\t\r\n"))
            except ValueError:
                return None
            return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))

        return text.map(one)

    return read


def leaves(value: object, path: str = "$", skip: frozenset[str] = frozenset()) -> Iterator[tuple[str, str]]:
    """X-03: (path, text) of every text in a JSON tree, keys in `skip` left out."""
    if isinstance(value, str):
        yield path, value
    elif isinstance(value, dict):
        for k, v in value.items():
            if k not in skip:
                yield from leaves(v, f"{path}.{k}", skip)
    elif isinstance(value, list):
        for k, v in enumerate(value):
            yield from leaves(v, f"{path}[{k}]", skip)


def walk_texts(df: DataFrame, key: str, column: Column, skip: tuple[str, ...] = ()) -> DataFrame:
    """X-03: rows (key, path, value) of the texts in a JSON column."""
    left_out, kind = frozenset(skip), df.schema[key].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(k, p, v) for k, t in zip(pdf[key], pdf["json"], strict=True) if t for p, v in leaves(json.loads(t), "$", left_out)]
            yield pd.DataFrame(out, columns=[key, "path", "value"])

    return df.select(key, column.alias("json")).mapInPandas(walk, f"{key} {kind}, path string, value string")


def result_rows(pages: DataFrame, key: str, column: str, cells: int) -> DataFrame:
    """S-14: rows of at least so many cells in any table of a page: (key, table, row, cells)."""
    parsed = pages.select(key, F.posexplode(page(F.col(column)).getField("tables")).alias("table", "rows"))
    rows = parsed.select(key, "table", F.posexplode("rows").alias("row", "cells"))
    return rows.where(F.size("cells") >= cells)


def table_records(rows: Column) -> Column:
    """T-25: rows after the first as maps by its cells, where the first row has distinct non-empty cells; else null."""
    head = F.try_element_at(rows, F.lit(1))
    usable = (F.size(head) > 1) & (F.size(F.array_distinct(head)) == F.size(head)) & ~F.exists(head, lambda c: c == "")
    body = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    filled = lambda row: F.transform(head, lambda c, k: F.coalesce(F.get(row, k), F.lit("")))
    return F.when(usable, F.transform(body, lambda row: F.map_from_arrays(head, filled(row))))


def ordered_images(images: Column) -> Column:
    """M-06, O-07: structs (kind, url) by rank of kind, the first of equal addresses."""
    rank = lambda i: F.coalesce(F.array_position(F.array(*[F.lit(k) for k in ("package", "label", "pill", "instruction")]), i["kind"]), F.lit(0))
    keyed = F.transform(images, lambda i, k: F.struct(F.when(rank(i) == 0, 9).otherwise(rank(i)).alias("rank"), k.alias("at"), i["kind"].alias("kind"), i["url"].alias("url")))
    ordered = F.array_sort(keyed)
    none = F.filter(ordered, lambda i: F.lit(False))
    once = F.aggregate(ordered, none, lambda kept, i: F.when(F.exists(kept, lambda k: k["url"] == i["url"]), kept).otherwise(F.array_append(kept, i)))
    return F.transform(once, lambda i: F.struct(i["kind"].alias("kind"), i["url"].alias("url")))
