"""Tables that lie in buckets of their join keys, so that joining them moves no row.

The schedule is joined to observations on (trip, sequence) in every run, and both tables only grow or stay. Stored in equally many
buckets of these keys, bucket i of one meets bucket i of the other where they are read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Buckets of a table; a bucket should fill a task, so it grows with the larger of the tables that are joined.
BUCKETS = 256


def _names(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def append_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Add rows to the buckets below ``path``. One writer at a time; the number of buckets of a path never changes."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spark = df.sparkSession
    # Rows are dealt out by bucket first, so that each bucket gets one file from each write.
    dealt = df.repartition(buckets, *keys)
    spark.sql(_ddl(name, df.schema, path, keys, buckets))
    try:
        dealt.write.mode("append").format("parquet").bucketBy(buckets, keys[0], *keys[1:]).sortBy(
            keys[0], *keys[1:]
        ).saveAsTable(name)
    finally:
        # The catalog forgets the name; the files stay, as the table has a path of its own.
        spark.sql(f"drop table if exists {name}")


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = BUCKETS
) -> DataFrame:
    """The table below ``path``, with its buckets known to the planner."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(_ddl(name, schema, path, keys, buckets))
    try:
        table = spark.table(name)
        # Resolved here, as the name is gone afterwards.
        table.schema  # noqa: B018
        return table
    finally:
        spark.sql(f"drop table if exists {name}")


def _ddl(name: str, schema: T.StructType, path: str, keys: list[str], buckets: int) -> str:
    return (
        f"create table {name} ({schema.toDDL()}) using parquet clustered by ({_names(keys)})"
        f" sorted by ({_names(keys)}) into {buckets} buckets location '{path}'"
    )
