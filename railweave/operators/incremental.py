"""Incremental forms of the staging and training tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.operators.staging import stg_positions

LOOKBACK_HOURS = 24


def high_water_mark(staged: DataFrame, column: str = "observation_id") -> int:
    """Largest id already staged, 0 for an empty table."""
    return staged.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]


def new_observations(positions: DataFrame, staged: DataFrame | None) -> DataFrame:
    """Staged form of the rows above the high-water mark.

    The mark is an id and not a time, so a row that arrives late with an old timestamp is
    included. It is passed as a literal, which lets the scan skip files below it.
    """
    if staged is None:
        return stg_positions(positions)
    return stg_positions(positions.filter(F.col("id") > high_water_mark(staged)))


def delete_insert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those that share their key.

    Only keys present in ``new`` are replaced; other old rows stay. The tables must have the
    same columns.
    """
    if set(old.columns) != set(new.columns):
        changed = sorted(set(old.columns) ^ set(new.columns))
        raise ValueError(f"Schema change between table and batch: {', '.join(changed)}")
    return old.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def within_lookback(rows: DataFrame, mart: DataFrame | None, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Rows at most ``hours`` older than the mart's newest prediction; all rows on a first run."""
    if mart is None:
        return rows
    newest = mart.agg(F.max("prediction_timestamp")).first()[0]
    if newest is None:
        return rows
    return rows.filter(F.col("prediction_timestamp") >= F.lit(newest - timedelta(hours=hours)))


def refreshed_training(
    training: DataFrame, mart: DataFrame | None, hours: int = LOOKBACK_HOURS
) -> DataFrame:
    """The mart after one incremental run over freshly computed training rows."""
    recent = within_lookback(training, mart, hours)
    return recent if mart is None else delete_insert(mart, recent, "observation_id")
