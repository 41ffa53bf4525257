"""Append-only record of what was ingested."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railweave.schemas import LEDGER_SCHEMA


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise


def record_ingestion(
    spark: SparkSession, path: str, *, source: str, file_name: str, checksum: str, raw_path: str,
    record_count: int | None, at: datetime,
) -> int:
    """Append one ledger row and return its id (one writer is assumed)."""
    last = read_ledger(spark, path).agg(F.coalesce(F.max("ingestion_id"), F.lit(0))).first()[0]
    row = (last + 1, at, source, file_name, record_count, checksum, raw_path)
    spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return last + 1
