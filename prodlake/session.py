"""Session factory and the catalogue view over the driver's tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Columns of the catalogue as expressions that Spark and DuckDB read alike.
CATALOG = {
    "pos": "p_partkey",
    "document_id": "concat('doc-', cast(p_partkey as string))",
    "id": "cast(p_partkey as string)",
    "name": "p_name",
    "category": "case when p_size % 13 = 0 then ' ' else p_type end",
    "manufacturer": "p_brand",
    "capacity": "concat(cast(p_size as string), ' ea')",
    "etc": "case when p_size % 5 = 0 then concat(' note ', cast(p_size as string)) else ' ' end",
    "updated": "case when p_partkey % 11 = 0 then 'n/a' else concat('2024-', lpad(cast(p_partkey % 12 + 1 as string), 2, '0'), '-', lpad(cast(p_size % 28 + 1 as string), 2, '0')) end",
    "price": "cast(floor(p_retailprice) as bigint)",
    "image_url": "case when p_partkey % 3 = 0 then '' when p_partkey % 3 = 1 then concat('https://img.example.org/pack/', cast(p_partkey as string), '.png') else concat('http://img.example.org/pill/', cast(p_partkey as string), '.png') end",
    "image_rights_status": "case p_partkey % 4 when 0 then 'verified' when 1 then 'unverified' when 2 then 'blocked' else 'open_license' end",
    "official_match_status": "case p_partkey % 5 when 0 then 'confirmed' when 1 then 'review_required' when 2 then 'not_found' when 3 then '' else 'other' end",
    "official_item_name": "case when p_partkey % 2 = 0 then concat('Official ', p_name) else '' end",
    "official_match_score": "cast(p_partkey % 101 as int)",
}
CATALOG_SQL = "(select " + ", ".join(f"{v} as {k}" for k, v in CATALOG.items()) + " from part)"


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings that results depend on (UTC) and adaptive execution; sizes stay the cluster's."""
    builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers, once an application: they need no path to it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="prodlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors fetch it from here while the application runs
    bundle = Path(folder) / "prodlake-package.zip"
    with zipfile.ZipFile(bundle, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(bundle))
    _SHIPPED.add(context.applicationId)


def lean_batches(spark: SparkSession) -> None:
    """Arrow batches of some megabytes at most, whatever the length of the texts; workers that know this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else one of our own (local runs only)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        set_by_us = spark.sparkContext.getCheckpointDir()
        if not set_by_us:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            own = tempfile.mkdtemp(prefix="prodlake-checkpoint-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            spark.sparkContext.setCheckpointDir(own)
            set_by_us = spark.sparkContext.getCheckpointDir()
        found = set_by_us
    return found.rstrip("/")


def stash(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors.

    Unlike checkpoint() the reread frame carries no partitioning, so that a later join shuffles both
    sides itself and adaptive execution can split skewed keys.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stash/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over as many tasks as a shuffle has: for much work a row on tables that are one small file, which is one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue: part's rows with the columns that the operators expect."""
    return table(spark, sf_dir, "part").selectExpr(*[f"{v} as {k}" for k, v in CATALOG.items()])
