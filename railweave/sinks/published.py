"""Tables replaced as a whole by publishing a manifest.

Data goes to new folders first. A version becomes visible when its manifest, one small JSON file in
a folder named by the version, is committed; readers take the highest version, so they see all of a
change or none of it and keep the previous version when a writer fails. Only that manifest is read,
however many there are. One writer per root at a time is assumed.

Replaced folders stay until ``clean_up`` removes them, so that running readers can finish.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railweave.schemas import columns
from railweave.session import delete_folder, file_system, subfolders

MANIFEST_SCHEMA = T.StructType(
    [
        *columns("BIGINT", "version"),
        *columns("TIMESTAMP", "activated_at"),
        *columns("STRING", "checksum_sha256 archive_path"),
        T.StructField(
            "entries",
            T.ArrayType(
                T.StructType([*columns("STRING", "table_name part path"), *columns("BIGINT", "row_count")])
            ),
        ),
    ]
)


# Spark's folder name for rows without a partition value.
NO_PART = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Entry:
    """One folder of a published table; ``part`` tells folders of a divided table apart."""

    table_name: str
    path: str
    row_count: int
    part: str | None = None


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of the committed manifests, oldest first."""
    system, make = file_system(spark, root)
    return [
        name for name in subfolders(spark, f"{root}/_manifest")
        if system.exists(make(f"{root}/_manifest/{name}/_SUCCESS"))
    ]


def manifests(spark: SparkSession, root: str) -> DataFrame | None:
    """All versions that were not cleaned up, None before the first."""
    names = _versions(spark, root)
    if not names:
        return None
    return spark.read.schema(MANIFEST_SCHEMA).json([f"{root}/_manifest/{name}" for name in names])


def _entries(spark: SparkSession, root: str, name: str) -> list[Entry]:
    manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/_manifest/{name}").first()
    return [Entry(e.table_name, e.path, e.row_count, e.part) for e in manifest.entries]


def current_version(spark: SparkSession, root: str) -> tuple[int, list[Entry]]:
    """Newest version number and its entries; (0, []) before the first."""
    names = _versions(spark, root)
    return (int(names[-1][1:]), _entries(spark, root, names[-1])) if names else (0, [])


def publish(
    spark: SparkSession, root: str, entries: list[Entry],
    checksum: str | None = None, archive_path: str | None = None,
) -> int:
    """Make ``entries`` the current version. The list is one item per folder, never per row."""
    version = current_version(spark, root)[0] + 1
    rows = [(version, None, checksum, archive_path, [asdict(e) for e in entries])]
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA).withColumn(
        "activated_at", F.current_timestamp()
    )
    # What a writer that failed left under this number is replaced.
    manifest.coalesce(1).write.mode("overwrite").json(f"{root}/_manifest/v{version:012d}")
    return version


def clean_up(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete manifests older than the newest ``keep`` and every data folder that none of those
    names; returns how many folders went."""
    names = _versions(spark, root)
    system, make = file_system(spark, root)
    named = {
        make(entry.path).toUri().getPath() for name in names[-keep:] for entry in _entries(spark, root, name)
    }
    for name in names[:-keep]:
        delete_folder(spark, f"{root}/_manifest/{name}")
    gone = 0
    for folder in subfolders(spark, f"{root}/data"):
        path = f"{root}/data/{folder}"
        own = make(path).toUri().getPath()
        if own in named:
            continue
        parts = [f"{path}/{part}" for part in subfolders(spark, path) if part.startswith("_part=")]
        unused = [p for p in parts if make(p).toUri().getPath() not in named]
        if len(unused) == len(parts):
            unused = [path]
        for part in unused:
            delete_folder(spark, part)
        gone += len(unused)
    return gone


def write_folder(df: DataFrame, root: str, name: str) -> Entry:
    """Write a new folder that no manifest names yet."""
    path = f"{root}/data/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return Entry(name, path, df.sparkSession.read.parquet(path).count())


def write_parts(df: DataFrame, root: str, name: str, part_column: str) -> list[Entry]:
    """Write one new folder per value of ``part_column`` (a date, so their number is bounded).

    Rebalancing gathers each date into few files, and splits a date too large for one task.
    """
    path = f"{root}/data/{name}-{uuid.uuid4().hex}"
    divided = df.withColumn("_part", F.col(part_column).cast("string"))
    divided.hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
    # With its schema given, a result without any rows can be read back as well.
    written = df.sparkSession.read.schema(divided.schema).parquet(path)
    counts = written.groupBy(F.col("_part").alias("part")).count().collect()
    return [
        Entry(name, f"{path}/_part={NO_PART if row.part is None else row.part}", row["count"], row.part)
        for row in counts
    ]


def read_entries(spark: SparkSession, entries: list[Entry], schema: T.StructType | None = None):
    """Rows of the given folders; None when there are none."""
    if not entries:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*(entry.path for entry in entries))


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The current version of a table, None when it was never published."""
    entries = [e for e in current_version(spark, root)[1] if e.table_name == name]
    return read_entries(spark, entries)


def load_history(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per published version with its row counts per table."""
    versions = manifests(spark, root)
    if versions is None:
        return None
    counts = F.map_from_entries(
        F.transform("entries", lambda e: F.struct(e["table_name"], e["row_count"]))
    )
    return versions.select(
        F.col("version").alias("load_id"), "activated_at", "checksum_sha256", "archive_path",
        counts.alias("row_counts"),
    )
