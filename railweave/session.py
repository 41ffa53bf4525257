"""Session set-up and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_chosen: dict[str, str] = {}
_written: list[str] = []


def build_session(app: str = "railweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here expects: UTC, AQE and skew-join handling on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_shared_dir(path: str) -> None:
    """The folder to use where ``spark.checkpoint.dir`` is unset, for local sessions such as tests."""
    _chosen["path"] = path


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, or on a local master what ``use_shared_dir`` named.

    Intermediate tables outlive the executors that wrote them, so the folder is never guessed.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and spark.conf.get("spark.master", "").startswith("local"):
        configured = _chosen.get("path")
    if not configured:
        raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and every executor can reach")
    return configured.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the function that makes its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def delete_folder(spark: SparkSession, path: str) -> None:
    system, make = file_system(spark, path)
    system.delete(make(path), True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, in order; none if it does not exist."""
    system, make = file_system(spark, path)
    if not system.exists(make(path)):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(make(path)) if entry.isDirectory())


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder, by the values of ``partition_by`` if any, and read it back.

    Cuts lineage so that several consumers neither recompute the input nor depend on the
    executors that produced it, and lets each consumer read only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/railweave/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote; returns how many.

    For the end of a job, when its results are stored: frames built on them cannot be read after.
    """
    count = len(_written)
    while _written:
        delete_folder(spark, _written.pop())
    return count
