"""The paged source resumes where it stopped; the publishing sink changes all targets or none."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from prodlake.session import ship
from prodlake.sources import paged
from prodlake.sources.publishing import publish, published, read_published


def page(folder, name, numbers, following=None):
    body = {"documents": [{"name": f"p/{n}", "fields": {"n": {"integerValue": str(n)}}} for n in numbers]}
    (folder / f"{name}.json").write_text(json.dumps(body | ({"nextPageToken": following} if following else {})))


def parquet_run(spark, folder, work, out):
    spark.dataSource.register(paged.DocumentPages)
    stream = spark.readStream.format("document_pages").load(f"file://{folder}")
    q = stream.writeStream.format("parquet").option("checkpointLocation", str(work)).start(str(out))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return sorted((r["document_id"], r["page"]) for r in spark.read.schema("document_id string, page string").parquet(str(out)).collect())


def test_restart_reads_each_page_once(spark, tmp_path):
    ship(spark)
    folder = tmp_path / "pages"
    folder.mkdir()
    page(folder, "first", [1, 2], "b")
    page(folder, "b", [3], "c")
    page(folder, "c", [4], "d")
    (folder / "d.json").write_text(json.dumps({"documents": "no list"}))
    with pytest.raises(Exception, match="page d"):
        parquet_run(spark, folder, tmp_path / "check", tmp_path / "out")
    assert len(spark.read.parquet(str(tmp_path / "out")).collect()) == 4
    for gone in ("first", "b", "c"):  # pages that were read are not asked again
        (folder / f"{gone}.json").unlink()
    page(folder, "d", [5], "e")
    page(folder, "e", [6, 7])
    got = parquet_run(spark, folder, tmp_path / "check", tmp_path / "out")
    assert got == [("1", "first"), ("2", "first"), ("3", "b"), ("4", "c"), ("5", "d"), ("6", "e"), ("7", "e")]


def test_abort_and_go_on(spark, tmp_path):
    ship(spark)
    folder = tmp_path / "pages"
    folder.mkdir()
    page(folder, "first", [1], "b")
    page(folder, "b", [2])
    (folder / "abort").touch()
    with pytest.raises(Exception, match="stopped before page first"):
        parquet_run(spark, folder, tmp_path / "check", tmp_path / "out")
    (folder / "abort").unlink()
    assert parquet_run(spark, folder, tmp_path / "check", tmp_path / "out") == [("1", "first"), ("2", "b")]


@pytest.mark.parametrize("body", ["[]", "{\"documents\": [{}]}", "{\"documents\": [], \"nextPageToken\": 3}", "x", "{\"documents\": [{\"name\": \"a\", \"fields\": 1}]}"])
def test_shapes(tmp_path, body):
    (tmp_path / "first.json").write_text(body)
    with pytest.raises(paged.ShapeError, match="page first"):
        paged.PageChain({"path": f"file://{tmp_path}"}).read({"token": "first", "pages": 0})


def test_targets_change_together(spark, tmp_path):
    ship(spark)
    uri = f"file://{tmp_path}/out"
    targets = {"table": "parquet", "lines": "ndjson", "sheet": "csv"}
    df = spark.range(50).select("id", F.concat(F.lit("é, \"q\"\n"), "id").alias("name")).repartition(3)
    assert published(uri) is None
    first = publish(df, uri, targets)
    assert first["rows"] == 50
    for target in targets:
        assert sorted((int(r["id"]), r["name"]) for r in read_published(spark, uri, target).select("id", "name").collect()) == sorted(map(tuple, df.collect()))
    failing = df.select("id", F.when(F.col("id") == 49, F.raise_error(F.lit("broken row"))).otherwise(F.col("name")).alias("name"))
    with pytest.raises(Exception, match="broken row"):
        publish(failing, uri, targets)
    assert published(uri) == first and read_published(spark, uri, "lines").count() == 50
    assert (tmp_path / "out" / "versions" / first["version"]).exists()
    second = publish(df.limit(7), uri, targets, keep_old=False)
    assert {read_published(spark, uri, t).count() for t in targets} == {7} and second["version"] != first["version"]
    versions = {p.name for p in (tmp_path / "out" / "versions").iterdir()}
    assert second["version"] in versions and first["version"] not in versions
    with pytest.raises(Exception, match="no format"):
        publish(df, uri, {"x": "xlsx"})


def test_nothing_to_publish(spark, tmp_path):
    ship(spark)
    uri = f"file://{tmp_path}/out"
    assert publish(spark.range(0), uri, {"table": "parquet"})["rows"] == 0
