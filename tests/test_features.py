from __future__ import annotations

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from warehouse import position, positions, stop_times, utc

from railweave.operators import features as feat
from railweave.operators import incremental, quality, staging
from railweave.plans.delay_training import build_features, build_training
from railweave.session import materialize, release
from railweave.sinks.mart import append_staging, refresh_training
from railweave.sinks.published import current_version, read_published


def test_fixture_gives_one_training_row(spark):
    rows = build_training(positions(spark), stop_times(spark)).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.current_delay_sec, row.target_delay_4_stops_sec) == (60, 120)
    assert (row.scheduled_dwell_time_sec, row.scheduled_travel_time_to_next_stop_sec) == (30, 270)
    assert row.target_observation_id == 2 and row.observed_stop_matches_schedule
    assert row.previous_observed_delay_sec is None
    assert row.historical_route_delay_sec is None and row.historical_stop_delay_sec is None
    assert len(row) == 42


def test_last_stop_has_no_travel_time(spark):
    found = feat.schedule_features(staging.stg_stop_times(stop_times(spark)))
    travel = {r.stop_sequence: r.scheduled_travel_time_to_next_stop_sec for r in found.collect()}
    assert travel == {1: 270, 2: 270, 3: 270, 4: 270, 5: None}


def test_schedule_rows_without_a_place_are_kept(spark):
    rows = stop_times(spark).unionByName(
        spark.createDataFrame(
            [(None, "08:00:00", "08:00:30", "S", "1"), ("T", None, None, "S", None)],
            stop_times(spark).schema,
        )
    )
    found = feat.schedule_features(staging.stg_stop_times(rows)).collect()
    assert len(found) == 7
    assert sum(r.scheduled_travel_time_to_next_stop_sec is None for r in found) == 3


def noon(minute, second=0):
    return utc(2026, 8, 30, 12, minute, second)


def test_earliest_strictly_later_observation_is_the_label(spark):
    rows = [
        position(1, noon(1), 1),
        position(2, noon(1), 5),  # same instant: not later
        position(5, noon(20), 5),
        position(4, noon(20), 5),  # same instant as 5: the smaller id wins
        position(6, noon(30), 5),
        position(7, noon(25), 1),
        position(8, noon(40), 1),  # nothing after it
        position(9, noon(26), 5, vehicle_id="OTHER"),
    ]
    found = build_features(positions(spark, rows), stop_times(spark)).collect()
    assert {r.observation_id: r.target_observation_id for r in found if r.current_stop_sequence == 1} == {
        1: 4, 7: 6, 8: None,
    }


@pytest.mark.parametrize("hot_rows", [1, 2, 1_000_000])
def test_repeated_polls_do_not_change_labels(spark, hot_rows):
    rows = [position(i, noon(1) + timedelta(seconds=15 * i), 1 if i < 40 else 5) for i in range(1, 81)]
    found = build_features(positions(spark, rows), stop_times(spark), hot_rows=hot_rows)
    labelled = {r.observation_id: r.target_observation_id for r in found.collect()}
    assert len(labelled) == 80
    assert all(labelled[i] == 40 for i in range(1, 40))
    assert all(labelled[i] is None for i in range(40, 81))


def test_label_may_come_from_another_service_day_unless_asked(spark):
    rows = [
        position(1, noon(1), 1),
        position(2, noon(20) + timedelta(days=1), 5, start_date="20260831"),
    ]
    current = feat.current_features(
        staging.stg_positions(positions(spark, rows)), staging.stg_stop_times(stop_times(spark))
    )
    assert feat.delay_features(current).filter("has_target_delay_4_stops").count() == 1
    same_day = feat.delay_features(current, same_service_day=True)
    assert same_day.filter("has_target_delay_4_stops").count() == 0


def test_history_excludes_the_current_row(spark):
    rows = [
        position(1, noon(1), 1),
        position(2, noon(3), 1, vehicle_id="B"),
        position(3, noon(3), 1),
    ]
    found = {
        r.observation_id: r
        for r in build_features(positions(spark, rows), stop_times(spark)).collect()
    }
    assert found[1].historical_route_delay_sec is None
    assert found[2].historical_route_delay_sec == 60
    assert found[3].historical_route_delay_sec == (60 + 180) / 2
    assert found[3].historical_stop_delay_sec == (60 + 180) / 2
    assert found[3].previous_observed_delay_sec == 60
    assert found[2].previous_observed_delay_sec is None


def test_repeated_schedule_rows_multiply_observations(spark):
    doubled = stop_times(spark).unionAll(stop_times(spark).filter("stop_sequence = '1'"))
    found = build_features(positions(spark), doubled)
    assert [r.observation_id for r in found.orderBy("observation_id").collect()] == [1, 1, 2]
    assert quality.unique_violations(found, "observation_id").collect()[0].copies == 2


def test_incomplete_observations_are_left_out(spark):
    rows = [position(i, noon(1), 1, **{name: None}) for i, name in enumerate(
        ["vehicle_id", "trip_id", "route_id", "start_date", "current_stop_sequence"])]
    staged = staging.stg_positions(positions(spark, rows))
    assert feat.eligible_observations(staged).isEmpty()


def test_staging_takes_late_rows_with_higher_ids(spark):
    first = positions(spark)
    staged = staging.stg_positions(first)
    late = position(3, utc(2020, 1, 1, 0, 0, 0), 1)
    grown = first.unionByName(positions(spark, [late]))
    assert [r.observation_id for r in incremental.new_observations(grown, staged).collect()] == [3]
    assert incremental.new_observations(first, staged).isEmpty()
    assert incremental.new_observations(first, None).count() == 2


def test_delete_insert_replaces_only_keys_of_the_batch(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "observation_id INT, v STRING")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "observation_id INT, v STRING")
    merged = incremental.delete_insert(old, new, "observation_id")
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(ValueError, match="extra"):
        incremental.delete_insert(old, new.withColumn("extra", F.lit(1)), "observation_id")


def test_lookback_admits_late_labels_and_keeps_dropped_rows(spark):
    at = utc(2026, 8, 30, 12, 0, 0)
    schema = "observation_id INT, prediction_timestamp TIMESTAMP, v STRING"
    mart = spark.createDataFrame([(1, at - timedelta(days=3), "old"), (2, at, "x"), (4, at, "gone")], schema)
    fresh = spark.createDataFrame(
        [(1, at - timedelta(days=3), "new"), (2, at, "y"), (3, at - timedelta(hours=24), "late"),
         (5, at - timedelta(hours=25), "too late")],
        schema,
    )
    merged = incremental.refreshed_training(fresh, mart)
    assert sorted((r.observation_id, r.v) for r in merged.collect()) == [
        (1, "old"), (2, "y"), (3, "late"), (4, "gone"),
    ]
    assert incremental.refreshed_training(fresh, None).count() == 4


def test_stored_mart_rewrites_only_touched_dates(spark, tmp_path):
    root, staged = str(tmp_path / "mart"), str(tmp_path / "staged")

    def day(number, minute):
        return utc(2026, 8, number, 12, minute, 0)

    def at(id_, number, minute, sequence):
        return position(id_, day(number, minute), sequence, start_date=f"202608{number:02d}", trip_id="CI_TRIP", vehicle_id=f"V{number}")

    early = [at(1, 10, 1, 1), at(2, 10, 22, 5), at(3, 20, 1, 1), at(4, 20, 22, 5), at(5, 20, 23, 1)]
    late = [at(6, 20, 40, 5), at(7, 21, 1, 1), at(8, 21, 22, 5)]

    def run(rows):
        added = append_staging(spark, positions(spark, rows), staged)
        current = feat.current_features(spark.read.parquet(staged), staging.stg_stop_times(stop_times(spark)))
        refresh_training(spark, feat.training_projection(feat.delay_features(current)), root)
        return added

    assert run(early) == 5
    before = {e.part: e.path for e in current_version(spark, root)[1]}
    assert set(before) == {"2026-08-10", "2026-08-20"}
    assert run(early + late) == 3
    after = {e.part: e.path for e in current_version(spark, root)[1]}
    assert after["2026-08-10"] == before["2026-08-10"] and after["2026-08-20"] != before["2026-08-20"]
    mart = read_published(spark, root, "ml_delay_training")
    # Observation 5 got its label only from the second run.
    assert sorted(r.observation_id for r in mart.collect()) == [1, 3, 5, 7]
    assert run(early + late) == 0
    assert read_published(spark, root, "ml_delay_training").count() == 4


def test_intermediate_tables_can_be_released(spark):
    table = materialize(spark.range(3), "t")
    folder = table.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    assert release(spark) >= 1 and not os.path.isdir(folder)
    assert release(spark) == 0
