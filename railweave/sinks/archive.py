"""Archiving and removal of rows that outlived their retention."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railweave.operators.retention import METRIC_DAYS, POSITION_DAYS, expired, kept
from railweave.sinks.published import clean_up, current_version, publish, read_entries, write_parts
from railweave.sources.events import ARCHIVE_TIME_FORMAT


class ArchiveMismatch(RuntimeError):
    """The archive does not hold what was to be deleted; nothing was removed."""


def as_json_lines(df: DataFrame) -> DataFrame:
    options = {"ignoreNullFields": "false", "timestampFormat": ARCHIVE_TIME_FORMAT}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def content_digest(lines: DataFrame) -> tuple[int, str]:
    """Row count and a checksum of a set of lines that does not depend on their order."""
    word = F.conv(F.substring(F.sha2("value", 256), 1, 15), 16, 10).cast("decimal(38,0)")
    row = lines.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(word), F.lit(0)).alias("total"),
        F.coalesce(F.bit_xor(F.xxhash64("value")), F.lit(0)).alias("mixed"),
    ).select("n", F.sha2(F.concat_ws(":", "n", "total", "mixed"), 256).alias("digest")).first()
    return row.n, row.digest


def archive_jsonl(df: DataFrame, folder: str) -> tuple[str, int, str]:
    """Write rows as gzip JSON lines, read them back, and return (path, rows, checksum)."""
    spark = df.sparkSession
    lines = as_json_lines(df)
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    lines.write.option("compression", "gzip").text(path)
    expected, stored = content_digest(lines), content_digest(spark.read.text(path))
    if expected != stored:
        raise ArchiveMismatch(f"Archive {path} holds {stored[0]} of {expected[0]} rows")
    return path, *stored


def store_dated(df: DataFrame, root: str, name: str, column: str) -> None:
    """Publish a table divided by the date of ``column``, which retention can then prune."""
    spark = df.sparkSession
    dated = df.withColumn("_date", F.to_date(column))
    others = [e for e in current_version(spark, root)[1] if e.table_name != name]
    entries = write_parts(dated, root, name, "_date")
    publish(spark, root, others + entries)


def enforce_retention(
    spark: SparkSession, root: str, name: str, column: str, now: datetime, days: int,
    archive: str | None,
) -> int:
    """Archive and remove rows older than ``days``; returns how many.

    Only the dates at or before the cutoff are read and only the cutoff's own date is rewritten.
    Removal is the publication of a manifest without the expired folders, so it happens after
    the archive has been read back and never in part; then the folders are deleted. Rows without a
    time are kept.
    """
    cutoff = now - timedelta(days=days)
    _, entries = current_version(spark, root)
    reached = [
        e for e in entries
        if e.table_name == name and e.part is not None and e.part <= cutoff.date().isoformat()
    ]
    touched = read_entries(spark, reached)
    if touched is None:
        return 0
    old = expired(touched, column, now, days)
    removed = old.count()
    if not removed:
        return 0
    if archive is not None:
        _, stored, _ = archive_jsonl(old.drop("_date"), f"{archive}/{name}")
        if stored != removed:
            raise ArchiveMismatch(f"{name}: archived {stored} rows of {removed}")
    boundary = read_entries(spark, [e for e in reached if e.part == cutoff.date().isoformat()])
    rewritten = []
    if boundary is not None:
        rewritten = write_parts(kept(boundary, column, now, days), root, name, "_date")
    publish(spark, root, [e for e in entries if e not in reached] + rewritten)
    clean_up(spark, root)
    return removed


def retention_run(spark: SparkSession, root: str, archive: str, now: datetime) -> dict[str, int]:
    """One clean-up of all three tables; dead letters are archived, metrics only removed.

    As the result reports positions and metrics only, dead letters are not in it.
    """
    positions = enforce_retention(
        spark, root, "positions", "ingested_at", now, POSITION_DAYS, archive
    )
    enforce_retention(spark, root, "dead_letters", "processed_at", now, METRIC_DAYS, archive)
    metrics = enforce_retention(
        spark, root, "metrics", "metric_timestamp", now, METRIC_DAYS, None
    )
    return {"positions_deleted": positions, "metrics_deleted": metrics}
