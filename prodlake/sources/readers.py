"""Scans: JSON arrays, line-delimited JSON with bad lines kept, ordered file sets, recorded API pages.

Live services are not called: their sources read recorded responses, through the same reader interface.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S-01: a file that holds one JSON array; anything else fails."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S-02: no rows where the file is absent."""
    try:
        return json_array(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def json_lines(spark: SparkSession, path: str, schema: StructType, bad: str = "_bad_line") -> DataFrame:
    """S-03: one record a line; a line that cannot be read is kept as text in a column of its own."""
    return spark.read.schema(StructType([*schema.fields]).add(bad, "string")).option("columnNameOfCorruptRecord", bad).json(path)


def ordered_files(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """S-04: several files with the path of each row, by which precedence is decided."""
    return spark.read.schema(schema).json(paths).withColumn("file_path", F.col("_metadata.file_path"))


def items_of(payload: Column, paths: tuple[str, ...] = ("$.response.body.items.item", "$.body.items", "$.items")) -> Column:
    """S-12: the records of an API envelope as an array of variants; a single record counts as one of an array."""
    found = F.coalesce(*[F.try_variant_get(payload, p, "array<variant>") for p in paths])
    one = F.coalesce(*[F.try_variant_get(payload, p, "variant") for p in paths])
    return F.coalesce(found, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<variant>"))


def cache_key(endpoint: Column, params: Column) -> Column:
    """S-09: hash of the endpoint and its parameters in the order of their names."""
    ordered = F.array_join(F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")
    return F.sha2(F.concat_ws("?", endpoint, ordered), 256)


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    """S-06 over any file system: (document_id, fields as JSON) of the recorded pages that the chain of tokens reaches from `first`.

    A page is the file <token>.json. Only names and tokens, one row a page, come to the driver, which follows the chain.
    """
    pages = spark.read.option("wholetext", True).text(folder).select(F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1).alias("page"), F.parse_json("value").alias("body"))
    following = {r["page"]: r["token"] for r in pages.select("page", F.try_variant_get("body", "$.nextPageToken", "string").alias("token")).collect()}
    reached, name = {}, "first"
    while name and name not in reached:
        if name not in following:
            raise FileNotFoundError(f"{folder}: {name}.json")
        reached[name] = len(reached)
        name = following[name]
    documents = pages.where(F.col("page").isin(*reached)).select(F.explode(F.try_variant_get("body", "$.documents", "array<variant>")).alias("d"))
    number = F.element_at(F.split(F.try_variant_get("d", "$.name", "string"), "/"), -1)
    return documents.select(number.alias("document_id"), decoded_fields(F.to_json(F.try_variant_get("d", "$.fields", "variant"))).alias("fields"))


@F.pandas_udf(StringType())
def decoded_fields(texts: pd.Series) -> pd.Series:
    """S-07 for a map of typed values as JSON text."""
    return texts.map(lambda t: json.dumps({k: decode_value(v) for k, v in json.loads(t or "{}").items()}, ensure_ascii=False, sort_keys=True))


def decode_value(value: dict) -> object:
    """S-07: a typed value tree as plain JSON values."""
    ((kind, inner),) = value.items()
    if kind == "mapValue":
        return {k: decode_value(v) for k, v in inner.get("fields", {}).items()}
    if kind == "arrayValue":
        return [decode_value(v) for v in inner.get("values", [])]
    if kind == "integerValue":
        return int(inner)
    if kind == "doubleValue":
        return float(inner)
    if kind == "nullValue":
        return None
    return {"base64": inner} if kind == "bytesValue" else inner
