"""Sinks: table swaps, CSV and JSON exports, portable packages with a manifest, incremental writes."""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from prodlake.functions.text import csv_cell


def _files(df: DataFrame, path: str):
    jvm = df.sparkSession._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()), place, jvm.org.apache.hadoop.fs.Path


def swap(df: DataFrame, path: str, form: str = "parquet") -> None:
    """K-01: write beside the target, then rename; readers see the old table or the new one."""
    swap_all([(df, path)], form)


def swap_all(tables: list[tuple[DataFrame, str]], form: str = "parquet", keep_old: bool = False) -> None:
    """K-10, K-14: several targets at once. All are staged first; if a rename fails, those done are taken back.

    With keep_old what was replaced stays beside the target, under its name and `.old-<id>`.
    """
    mark = uuid.uuid4().hex
    for df, path in tables:
        df.write.format(form).save(f"{path}.staged-{mark}")
    done: list[tuple] = []
    try:
        for df, path in tables:
            fs, target, make = _files(df, path)
            staged, old = make(f"{path}.staged-{mark}"), make(f"{path}.old-{mark}")
            had = fs.exists(target)
            if had and not fs.rename(target, old):
                raise OSError(f"{path} could not be moved aside")
            done.append((fs, target, old if had else None))
            if not fs.rename(staged, target):
                raise OSError(f"{path} could not be replaced")
    except Exception:
        for fs, target, old in reversed(done):
            fs.delete(target, True)
            if old is not None:
                fs.rename(old, target)
        raise
    if not keep_old:
        for fs, _, old in done:
            if old is not None:
                fs.delete(old, True)


@contextmanager
def locked(spark: SparkSession, path: str) -> Iterator[None]:
    """K-11: one holder at a time of a lock file on the table's own file system; held until the block ends."""
    jvm = spark._jvm
    lock = jvm.org.apache.hadoop.fs.Path(f"{path}.lock")
    fs = lock.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.createNewFile(lock):
        raise BlockingIOError(f"{path} is locked by {lock.toString()}")
    try:
        yield
    finally:
        fs.delete(lock, False)


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """H-04: file, size and time of change; equal fingerprints mean that nothing needs to be read again."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "modificationTime")


def bounded_files(spark: SparkSession, path: str, most: int) -> DataFrame:
    """S-22: the files of a folder with their contents; fails before reading any if one is larger than `most` bytes."""
    if large := fingerprint(spark, path).where(F.col("length") > most).select("file").limit(1).collect():
        raise ValueError(f"{large[0]['file']} is larger than {most} bytes")
    return spark.read.format("binaryFile").load(path).select("path", "content", F.sha2("content", 256).alias("sha256"))


def as_text(df: DataFrame, column: str) -> Column:
    """K-04: nested values as JSON text, map entries in key order."""
    kind = df.schema[column].dataType
    if isinstance(kind, MapType):
        return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(column))))
    if isinstance(kind, StructType | ArrayType | VariantType):
        return F.to_json(column)
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def csv_lines(df: DataFrame, order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """K-02, K-05: rows (at, line) with guarded cells; `at` is the row's place in the order."""
    cells = [csv_cell(as_text(df, c)) for c in columns or df.columns]
    return df.select(F.struct(*order).alias("at"), F.concat_ws(",", *cells).alias("line"))


def write_csv(df: DataFrame, order: list[Column], path: str, columns: list[str] | None = None, most: int = 1_000_000) -> None:
    """Byte order mark, header, CRLF line ends: one file, as an export of what a user selected, of `most` rows at most.

    Larger tables fail before anything is written: their lines (csv_lines) go to as many files as they need.
    """
    body = csv_lines(df, order, columns)
    if body.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows for one file")
    header = df.sparkSession.range(1).select(
        F.lit(None).cast(body.schema["at"].dataType).alias("at"), F.lit("\ufeff" + ",".join(columns or df.columns)).alias("line")
    )
    whole = header.unionByName(body).repartition(1).sortWithinPartitions(F.col("at").asc_nulls_first())
    whole.select("line").write.option("lineSep", "\r\n").text(path)


def header_columns(spark: SparkSession, path: str, fields: list[str]) -> list[str]:
    """K-03: the fields in the order of an export that is there, which it knows, then the others by name; without one, all by name."""
    fs, place, _ = _files(spark.range(0), path)
    first = spark.read.option("lineSep", "\n").text(path).limit(1).collect() if fs.exists(place) else []
    told = next(csv.reader([first[0][0].lstrip("\ufeff").rstrip("\r")]), []) if first else []
    kept = [f for f in told if f in fields]
    return [*kept, *sorted(set(fields) - set(kept))]


def publish(spark: SparkSession, source: str, target: str, form: str = "parquet") -> int:
    """K-09: a copy of a table for others to read, put in place at once; the number of its rows, which is that of the source."""
    rows = spark.read.format(form).load(source)
    swap(rows, target, form)
    found, wanted = spark.read.format(form).load(target).count(), rows.count()
    if found != wanted:
        raise ValueError(f"{found} rows published, expected {wanted}")
    return found


def package(df: DataFrame, path: str, expected: int | None = None) -> DataFrame:
    """K-08, H-03: records as line-delimited JSON, and a manifest of file, bytes and hash read back from storage."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(f"{path}/records")
    spark = df.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    manifest = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    manifest.write.mode("errorifexists").json(f"{path}/manifest")
    if expected is not None and (found := spark.read.text(f"{path}/records").count()) != expected:
        raise ValueError(f"{found} records, expected {expected}")
    return spark.read.schema(manifest.schema).json(f"{path}/manifest")


def package_errors(spark, path: str) -> DataFrame:
    """V-04: files of a package whose bytes differ from the manifest, or that are missing from either."""
    stated = spark.read.schema("file string, bytes long, sha256 string").json(f"{path}/manifest")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    found = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("found"))
    joined = stated.join(found, "file", "full_outer")
    code = F.when(F.col("found").isNull(), "missing").when(F.col("sha256").isNull(), "unlisted").when(F.col("sha256") != F.col("found"), "changed")
    return joined.select("file", code.alias("code")).where("code is not null")


def record_errors(records: DataFrame, other: DataFrame, key: str, expected: int, schema_check, damaged: dict[str, str]) -> DataFrame:
    """V-04: what is wrong with a package's records, in long form (key, code).

    other: the same records in the package's second form; schema_check: column of JSON text to a list of messages; damaged: code to
    pattern, sought in the record's JSON. A wrong number of records is a row with a null key.
    """
    text = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    inside = records.select(
        F.col(key).cast("string").alias("key"),
        F.explode(F.concat(F.when(F.size(schema_check(text)) > 0, F.array(F.lit("schema"))).otherwise(F.array().cast("array<string>")), *[F.when(text.rlike(p), F.array(F.lit(c))).otherwise(F.array().cast("array<string>")) for c, p in damaged.items()])).alias("code"),
    )
    twice = records.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1 or coalesce(trim(key), '') = ''").select("key", F.when(F.coalesce(F.trim("key"), F.lit("")) == "", "blank_id").otherwise("repeated_id").alias("code"))
    differ = records.exceptAll(other.select(records.columns)).select(F.col(key).cast("string").alias("key"), F.lit("only_in_first").alias("code")).union(other.select(records.columns).exceptAll(records).select(F.col(key).cast("string"), F.lit("only_in_second")))
    number = records.agg(F.count("*").alias("n")).where(F.col("n") != expected).select(F.lit(None).cast("string").alias("key"), F.lit("wrong_number").alias("code"))
    return inside.unionByName(twice).unionByName(differ).unionByName(number)
