"""Event messages as a stream or a batch, and archived rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railweave.schemas import MESSAGE_SCHEMA

# The default format would cut times to milliseconds.
ARCHIVE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_kafka_events(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Topic messages from the earliest offset; needs Spark's Kafka package on the cluster."""
    reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
    stream = reader.options(**options).load()
    return stream.select(F.col("key").cast("string").alias("key"), "value", "topic", "partition",
                         "offset", "timestamp")


def read_event_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages kept as Parquet files with the same envelope, read as a stream."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_archived_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows archived as (compressed) JSON lines."""
    reader = spark.read.schema(schema).option("timestampFormat", ARCHIVE_TIME_FORMAT)
    return reader.option("mode", "FAILFAST").json(path)
