"""Data-quality checks. Each returns the offending rows, so an empty result means it passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import event_time
from railweave.operators.features import STOPS_AHEAD

DELAY_LIMIT_SECONDS = 86_400


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, violations) for every column, in one pass."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counted.unpivot([], columns, "column_name", "violations")


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
    )


def relationship_violations(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Non-null child values without a parent, with their row count.

    Child rows are counted per value before the join, so a frequent value moves as one row.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("child_rows"))
    )
    return values.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def missing_in_staging(source: DataFrame, staged: DataFrame) -> DataFrame:
    return source.select(F.col("id").alias("observation_id")).join(
        staged.select("observation_id"), "observation_id", "left_anti"
    )


def has_other_event_time() -> Column:
    return ~F.col("event_timestamp").eqNullSafe(event_time())


def event_time_mismatch(staged: DataFrame) -> DataFrame:
    """Staged rows whose event time is not the preferred one; NULL equals NULL."""
    return staged.filter(has_other_event_time()).select("observation_id")


def duplicate_event_ids(staged: DataFrame) -> DataFrame:
    return unique_violations(staged, "event_id").select(F.col("value").alias("event_id"))


def has_unreasonable_delay(limit: int = DELAY_LIMIT_SECONDS) -> Column:
    current, target = F.col("current_delay_sec"), F.col("target_delay_4_stops_sec")
    return ~current.between(-limit, limit) | ~target.between(-limit, limit)


def unreasonable_delays(training: DataFrame, limit: int = DELAY_LIMIT_SECONDS) -> DataFrame:
    return training.filter(has_unreasonable_delay(limit))


def has_early_target() -> Column:
    return F.col("target_event_timestamp") <= F.col("prediction_timestamp")


def target_not_after_prediction(training: DataFrame) -> DataFrame:
    return training.filter(has_early_target())


def label_sequence_mismatch(
    training: DataFrame, features: DataFrame, stops_ahead: int = STOPS_AHEAD
) -> DataFrame:
    """Training rows whose label row is not exactly ``stops_ahead`` sequence numbers on."""
    labels = features.select(
        F.col("observation_id").alias("target_observation_id"),
        F.col("current_stop_sequence").alias("label_sequence"),
    )
    wanted = F.col("current_stop_sequence") + stops_ahead
    return training.join(labels, "target_observation_id").filter(F.col("label_sequence") != wanted)


def dq_report(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) for every named check."""
    counted = [
        df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def row_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, violations) of conditions on single rows, all in one pass. A NULL condition is no violation."""
    counted = df.agg(*(F.count_if(condition).alias(name) for name, condition in checks.items()))
    return counted.unpivot([], list(checks), "check", "violations")


def not_null_report(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """``not_null_violations`` in the layout of ``dq_report``."""
    check = F.concat(F.lit(f"not_null_{table}_"), F.col("column_name"))
    return not_null_violations(df, columns).select(check.alias("check"), "violations")
