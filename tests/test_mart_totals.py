"""The training mart extended from totals of old observations."""

from __future__ import annotations

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from railweave.operators import carried
from railweave.operators.features import delay_features, matched_features, schedule_features, training_projection
from railweave.operators.staging import stg_positions, stg_stop_times
from railweave.sinks.mart import TOTALS, extend_training
from railweave.sinks.published import current_version, read_published
from railweave.sources.shaped import Tables

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="bundled data not present")


@pytest.fixture(scope="module")
def tables(spark):
    t = Tables(spark, DATA)
    return stg_positions(t.positions), t.stop_times


def rows_of(df):
    dropped = [c for c in ("training_row_created_at", "_date") if c in df.columns]
    return sorted(map(repr, df.drop(*dropped).select(*sorted(set(df.columns) - set(dropped))).collect()))


def full(staged, stop_times):
    schedule = schedule_features(stg_stop_times(stop_times))
    return training_projection(delay_features(matched_features(staged, schedule)))


def middle(staged):
    return staged.agg(F.max("observation_id")).first()[0] // 2


def test_second_run_needs_no_old_observations(spark, tables, tmp_path):
    staged, stop_times = tables
    half = middle(staged)
    whole, lean = str(tmp_path / "whole"), str(tmp_path / "lean")
    for root in (whole, lean):
        extend_training(spark, staged.filter(F.col("observation_id") <= half), stop_times, root)
    newest = read_published(spark, whole, "ml_delay_training").agg(F.max("prediction_timestamp")).first()[0]
    begin = carried.slice_start(newest - timedelta(hours=24))
    needed = (F.col("observation_id") > half) | (F.col("event_timestamp") >= F.lit(begin))
    assert 0 < staged.filter(needed).count() < staged.count()
    extend_training(spark, staged, stop_times, whole, hot_rows=3)
    extend_training(spark, staged.filter(needed), stop_times, lean)
    after = rows_of(read_published(spark, whole, "ml_delay_training"))
    assert after == rows_of(read_published(spark, lean, "ml_delay_training"))
    # What was recomputed is what a run over all history gives.
    recent = F.col("prediction_timestamp") >= F.lit(newest - timedelta(hours=24))
    assert rows_of(read_published(spark, whole, "ml_delay_training").filter(recent)) == rows_of(
        full(staged, stop_times).filter(recent)
    )


def test_late_observations_enter_the_totals(spark, tables, tmp_path):
    """Observations that come last but are older than any lookback change the history of later ones."""
    staged, stop_times = tables
    root = str(tmp_path)
    late = F.col("observation_id") % 7 == 3
    top = staged.agg(F.max("observation_id")).first()[0] + 1
    shifted = staged.withColumn(
        "observation_id", F.when(late, F.col("observation_id") + top).otherwise(F.col("observation_id"))
    )
    extend_training(spark, shifted.filter(F.col("observation_id") < top), stop_times, root)
    extend_training(spark, shifted, stop_times, root)
    mart = read_published(spark, root, "ml_delay_training")
    newest = mart.agg(F.max("prediction_timestamp")).first()[0]
    recent = F.col("prediction_timestamp") >= F.lit(newest - timedelta(hours=23))
    assert rows_of(mart.filter(recent)) == rows_of(full(shifted, stop_times).filter(recent))


def test_totals_are_folded_to_one_row_per_key(spark, tables, tmp_path):
    staged, stop_times = tables
    root = str(tmp_path)
    for part in (0.5, 0.75, 1.0):
        top = int(staged.agg(F.max("observation_id")).first()[0] * part)
        extend_training(spark, staged.filter(F.col("observation_id") <= top), stop_times, root)
    totals = read_published(spark, root, TOTALS)
    assert totals.filter(F.col("slice") == carried.FOLDED).count() > 0
    assert totals.groupBy("scan", "key", "slice").count().filter("count > 1").isEmpty()
    [entry] = [e for e in current_version(spark, root)[1] if e.table_name == TOTALS]
    begin = carried._micros(carried.datetime.fromisoformat(entry.part))
    old = totals.filter((F.col("slice") < begin) & (F.col("slice") > carried.FOLDED))
    assert old.isEmpty()


def test_a_longer_lookback_than_before_reads_all_history(spark, tables, tmp_path):
    staged, stop_times = tables
    root = str(tmp_path)
    half = middle(staged)
    extend_training(spark, staged.filter(F.col("observation_id") <= half), stop_times, root)
    extend_training(spark, staged.filter(F.col("observation_id") <= half * 3 // 2), stop_times, root, hours=2)
    extend_training(spark, staged, stop_times, root, hours=24 * 60)
    assert rows_of(read_published(spark, root, "ml_delay_training")) == rows_of(full(staged, stop_times))


def test_scan_totals_merge(spark, tables):
    staged, stop_times = tables
    schedule = schedule_features(stg_stop_times(stop_times))
    current = matched_features(staged, schedule)
    parts = [carried.scan_totals(current.filter(F.col("row_id") % 3 == i)) for i in range(3)]
    merged = carried.merged_totals(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows_of(merged) == rows_of(carried.scan_totals(current))


def test_first_runs_without_rows(spark, tables, tmp_path):
    staged, stop_times = tables
    root = str(tmp_path)
    assert extend_training(spark, staged.limit(0), stop_times, root) == 0
    assert extend_training(spark, staged, stop_times, root) == full(staged, stop_times).count()
