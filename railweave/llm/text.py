"""Column expressions shared by the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def plain_text(column: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def word_count(column: Column) -> Column:
    return F.regexp_count(plain_text(column), F.lit(WORD)).cast("long")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(plain_text(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(plain_text(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def packed(df: DataFrame, name: str = "row_") -> DataFrame:
    """``df`` with all columns in one struct, so that added columns cannot clash with them."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name))


def unpacked(df: DataFrame, schema: T.StructType, name: str = "row_") -> DataFrame:
    return df.select(*(F.col(f"{name}.`{c}`").alias(c) for c in schema.fieldNames()))


BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Spark's default, and the rows of text that go to a Python worker at once instead.
DEFAULT_BATCH, TEXT_BATCH = "10000", "500"


def bound_batches(spark: SparkSession) -> None:
    """Lets batches of texts be small, unless the session chose their size: a batch is held by the
    executor and by its Python worker at once."""
    if spark.conf.get(BATCH_SETTING) == DEFAULT_BATCH:
        spark.conf.set(BATCH_SETTING, TEXT_BATCH)
