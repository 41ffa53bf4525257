"""Raw feed payload files."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railweave.operators.retention import PAYLOAD_DAYS
from railweave.session import file_system, subfolders


def scan_payloads(spark: SparkSession, root: str, pattern: str = "*.pb") -> DataFrame:
    """Path, time, size, checksum and bytes of every payload file below ``root``."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select(
        "path", F.col("modificationTime").alias("modified_at"), "length",
        F.sha2("content", 256).alias("checksum_sha256"), "content",
    )


def latest_snapshot(spark: SparkSession, root: str, file_name: str) -> str:
    """Path of ``file_name`` in the dated folder that sorts last."""
    paths = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", file_name)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )
    newest = paths.agg(F.max("path")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"No {file_name} below {root}")
    return newest


def store_payloads(payloads: DataFrame, root: str) -> None:
    """Append payloads (``ingested_at``, ``content``, ...) under their ingestion date."""
    dated = payloads.withColumn("ingest_date", F.to_date("ingested_at"))
    dated.write.mode("append").partitionBy("ingest_date").parquet(root)


IDENTITY = ["path", "modificationTime", "length"]


def _index(spark: SparkSession, archive: str) -> DataFrame:
    """Files whose copy was read back and found intact."""
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, checksum STRING"
    runs = [f"{archive}/{name}/intact" for name in subfolders(spark, archive)]
    system, make = file_system(spark, archive)
    there = [path for path in runs if system.exists(make(path))]
    return spark.read.schema(schema).parquet(*there) if there else spark.range(0).select(
        *(F.lit(None).cast(kind).alias(name) for name, kind in (part.split() for part in schema.split(", ")))
    )


def archived_payloads(spark: SparkSession, archive: str) -> DataFrame:
    """The copies of all runs, with their bytes."""
    return spark.read.parquet(*(f"{archive}/{name}/copies" for name in subfolders(spark, archive)))


def archive_expired_payloads(
    spark: SparkSession, root: str, archive: str, now: datetime, days: int = PAYLOAD_DAYS, pattern: str = "*.pb"
) -> DataFrame:
    """Copy payload files older than ``days`` to ``archive`` and list those safe to delete.

    A file is listed only if the bytes read back from the archive have its checksum. Files
    changed at or after the cutoff are left alone. Every run writes a folder of its own with the files that no earlier run has
    copied. It opens the files from the oldest of those on: the time bounds reach the scan, which opens no file outside of them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .filter(F.col("modificationTime") < F.lit(now - timedelta(days=days)))
    )
    # Path, time and length come from the file listing; no file is opened for them.
    listing = files.select(*IDENTITY)
    fresh = listing.join(_index(spark, archive), IDENTITY, "left_anti")
    oldest = fresh.agg(F.min("modificationTime")).first()[0]
    if oldest is not None:
        run = f"{archive.rstrip('/')}/run-{uuid.uuid4().hex}"
        opened = files.filter(F.col("modificationTime") >= F.lit(oldest))
        new = opened.join(_index(spark, archive), IDENTITY, "left_anti")
        new.select(*IDENTITY, F.sha2("content", 256).alias("checksum"), "content").write.parquet(f"{run}/copies")
        copies = spark.read.parquet(f"{run}/copies")
        intact = copies.filter(F.sha2("content", 256) == F.col("checksum"))
        intact.select(*IDENTITY, "checksum").write.parquet(f"{run}/intact")
    return listing.join(_index(spark, archive), IDENTITY, "left_semi").select("path")
