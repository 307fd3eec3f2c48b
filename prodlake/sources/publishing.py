"""K-10, K-13 as a sink with a commit protocol: several targets of one frame, published at once or not at all.

Every task writes its rows to all targets of a new version and answers with the files it wrote. The commit writes the
version's manifest and moves one pointer, CURRENT, so that readers see all old targets or all new ones; a task that fails, is
lost, runs twice or ends after the abort leaves files that no manifest names. The abort removes what there is of the version. Works on any file system that
pyarrow knows by its URI: moving a small object there must be atomic, as it is on HDFS and local disks; the pointer is the only
object that ever changes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
import pyarrow.parquet
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMATS = ("parquet", "csv", "ndjson")


@dataclass
class Written(WriterCommitMessage):
    """Files of a task by target, relative to the version, and its rows."""

    files: dict[str, str]
    rows: int


def _encode(batch: pa.RecordBatch, form: str, first: bool) -> bytes:
    sink = pa.BufferOutputStream()
    if form == "csv":
        pa.csv.write_csv(batch, sink, pa.csv.WriteOptions(include_header=first))
    else:
        for row in batch.to_pylist():
            sink.write((json.dumps(row, ensure_ascii=False, default=str) + "\n").encode())
    return sink.getvalue().to_pybytes()


class PublishingWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        self.uri = options["path"]
        self.targets = dict(t.split(":") for t in options.get("targets", "rows:parquet").split(","))
        self.version = uuid.uuid4().hex
        self.keep = options.get("keepOld", "true") == "true"
        if unknown := set(self.targets.values()) - set(FORMATS):
            raise ValueError(f"no format {', '.join(sorted(unknown))}; there are {', '.join(FORMATS)}")

    def _folder(self) -> tuple[fs.FileSystem, str]:
        files, root = fs.FileSystem.from_uri(self.uri)
        return files, root.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = self._folder()
        task = TaskContext.get()
        part = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        names, sinks, rows = {}, {}, 0
        for batch in iterator:
            for target, form in self.targets.items():
                if target not in sinks:
                    files.create_dir(f"{root}/versions/{self.version}/{target}", recursive=True)
                    names[target] = f"{target}/{part}.{form}"
                    out = files.open_output_stream(f"{root}/versions/{self.version}/{names[target]}")
                    sinks[target] = (out, pa.parquet.ParquetWriter(out, batch.schema) if form == "parquet" else None)
                out, table = sinks[target]
                if table:
                    table.write_batch(batch)
                else:
                    out.write(_encode(batch, form, rows == 0))
            rows += batch.num_rows
        for out, table in sinks.values():
            if table:
                table.close()
            out.close()
        return Written(names, rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = self._folder()
        done = [m for m in messages if m is not None]
        manifest = {"version": self.version, "rows": sum(m.rows for m in done), "targets": {t: {"format": f, "files": sorted(m.files[t] for m in done if t in m.files)} for t, f in self.targets.items()}}
        old = published(self.uri)
        files.create_dir(f"{root}/versions/{self.version}", recursive=True)
        with files.open_output_stream(f"{root}/versions/{self.version}/manifest.json") as out:
            out.write(json.dumps(manifest).encode())
        with files.open_output_stream(f"{root}/CURRENT.{self.version}") as out:
            out.write(json.dumps(manifest).encode())
        files.move(f"{root}/CURRENT.{self.version}", f"{root}/CURRENT")
        if old and not self.keep:
            files.delete_dir(f"{root}/versions/{old['version']}")

    def abort(self, messages: list[Written | None]) -> None:
        files, root = self._folder()
        if files.get_file_info(f"{root}/versions/{self.version}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/versions/{self.version}")


class Publishing(DataSource):
    """Format `publishing`: options path (a folder's URI), targets (name:format,...), keepOld (true unless said otherwise)."""

    @classmethod
    def name(cls) -> str:
        return "publishing"

    def writer(self, schema: StructType, overwrite: bool) -> PublishingWriter:
        return PublishingWriter(self.options, schema, overwrite)


def published(uri: str) -> dict | None:
    """The manifest of the version in force; None before the first."""
    files, root = fs.FileSystem.from_uri(uri)
    if files.get_file_info(f"{root.rstrip('/')}/CURRENT").type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(f"{root.rstrip('/')}/CURRENT") as f:
        return json.loads(f.read())


def publish(df: DataFrame, uri: str, targets: dict[str, str], keep_old: bool = True) -> dict:
    """Write df to all targets and put them in force together; the new manifest."""
    df.sparkSession.dataSource.register(Publishing)
    options = {"targets": ",".join(f"{k}:{v}" for k, v in targets.items()), "keepOld": str(keep_old).lower()}
    df.write.format("publishing").options(**options).mode("append").save(uri)
    return published(uri)


def read_published(spark: SparkSession, uri: str, target: str, schema: StructType | None = None) -> DataFrame:
    """A target of the version in force."""
    manifest = published(uri)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published at {uri}")
    found = manifest["targets"][target]
    paths = [f"{uri.rstrip('/')}/versions/{manifest['version']}/{f}" for f in found["files"]]
    reader = spark.read if schema is None else spark.read.schema(schema)
    if found["format"] == "csv":
        return reader.option("header", True).option("multiLine", True).option("escape", "\"").csv(paths)
    return reader.json(paths) if found["format"] == "ndjson" else reader.parquet(*paths)
