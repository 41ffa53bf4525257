"""From observations and schedule to the training mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from railweave.operators.features import current_features, delay_features, training_projection
from railweave.operators.scan import HOT_ROWS
from railweave.operators.staging import stg_positions, stg_stop_times


def build_features(positions: DataFrame, stop_times: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Delay features of raw observations against the raw schedule."""
    current = current_features(stg_positions(positions), stg_stop_times(stop_times))
    return delay_features(current, hot_rows)


def build_training(positions: DataFrame, stop_times: DataFrame) -> DataFrame:
    """The labelled training mart."""
    return training_projection(build_features(positions, stop_times))
