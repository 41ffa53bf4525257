"""Joins of tables that lie in buckets of their keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from railweave.sinks.bucketed import append_bucketed, read_bucketed


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path, no_broadcast):
    left = spark.range(200).select(F.concat(F.lit("t"), F.col("id") % 20).alias("trip_id"), (F.col("id") % 7).cast("int").alias("seq"), "id")
    right = spark.range(140).select(F.concat(F.lit("t"), F.col("id") % 20).alias("trip_id"), (F.col("id") % 7).cast("int").alias("place"), (F.col("id") * 2).alias("due"))
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for part in (0, 1, 2):
        append_bucketed(left.filter(F.col("id") % 3 == part), a, ["trip_id", "seq"], buckets=4)
    append_bucketed(right, b, ["trip_id", "place"], buckets=4)
    x = read_bucketed(spark, a, left.schema, ["trip_id", "seq"], buckets=4)
    y = read_bucketed(spark, b, right.schema, ["trip_id", "place"], buckets=4)
    joined = x.join(y.withColumnRenamed("place", "seq"), ["trip_id", "seq"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    expected = left.join(right.withColumnRenamed("place", "seq"), ["trip_id", "seq"])
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, expected.collect()))
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")] == []


def test_matched_observations_read_their_buckets(spark, tmp_path, no_broadcast):
    from railweave.operators.features import observations_with_schedule, schedule_features

    times = spark.createDataFrame(
        [("t1", "08:00:00", "08:00:30", "s1", 1), ("t1", "08:05:00", "08:05:30", "s2", 2), ("t2", "09:00:00", "09:00:30", "s1", 1)],
        "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int",
    )
    seen = spark.createDataFrame(
        [(1, "t1", 2, "20240105", "s2"), (2, "t2", 1, "20240105", "s9"), (3, "t3", 1, "20240105", "s1")],
        "observation_id long, trip_id string, current_stop_sequence int, start_date string, stop_id string",
    ).withColumn("event_timestamp", F.lit("2024-01-05 13:06:00").cast("timestamp"))
    schedule = schedule_features(times)
    paths = [str(tmp_path / name) for name in ("seen", "schedule")]
    append_bucketed(seen, paths[0], ["trip_id", "current_stop_sequence"], buckets=4)
    append_bucketed(schedule, paths[1], ["trip_id", "stop_sequence"], buckets=4)
    found = observations_with_schedule(
        read_bucketed(spark, paths[0], seen.schema, ["trip_id", "current_stop_sequence"], buckets=4),
        read_bucketed(spark, paths[1], schedule.schema, ["trip_id", "stop_sequence"], buckets=4),
    )
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows = {r.observation_id: (r.current_delay_sec, r.observed_stop_matches_schedule) for r in found.collect()}
    assert rows == {1: (60, True), 2: (-3240, False)}
