"""Which rows and files have outlived their retention."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITION_DAYS = 14
METRIC_DAYS = 30
PAYLOAD_DAYS = 7


def expired(df: DataFrame, column: str, now: datetime | Column, days: int) -> DataFrame:
    return df.filter(F.col(column) < F.lit(now) - F.lit(timedelta(days=days)))


def kept(df: DataFrame, column: str, now: datetime | Column, days: int) -> DataFrame:
    """Complement of ``expired``: rows without a time are kept too."""
    limit = F.lit(now) - F.lit(timedelta(days=days))
    return df.filter((F.col(column) >= limit) | F.col(column).isNull())


def expired_count(df: DataFrame, column: str, now: datetime | Column, days: int) -> DataFrame:
    """What a dry run reports."""
    return expired(df, column, now, days).agg(F.count("*").alias("eligible"))


def oldest_batch(df: DataFrame, column: str, key: str, now: datetime | Column, days: int, rows: int) -> DataFrame:
    """The ``rows`` oldest expired rows, the unit of a bounded clean-up."""
    return expired(df, column, now, days).orderBy(column, key).limit(rows)


def without_selected(df: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``selected``."""
    return df.join(selected.select(key), key, "left_anti")


def only_selected(df: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    return df.join(selected.select(key), key, "left_semi")
