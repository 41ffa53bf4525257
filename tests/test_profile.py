"""The profile of the training mart from one histogram."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from railweave.operators.profile import profile_histogram, training_profile

SCHEMA = (
    "vehicle_id string, trip_id string, route_id string, prediction_timestamp timestamp,"
    " target_delay_4_stops_sec int, has_target_delay_4_stops boolean"
)
START = datetime(2024, 3, 1)


def rows(n):
    return [
        (f"v{i % 7}", None if i % 11 == 0 else f"t{i % 13}", f"r{i % 3}", START + timedelta(minutes=i), i * i % 301 - 90, True)
        for i in range(n)
    ]


def test_profile_equals_plain_counts(spark):
    made = rows(250)
    training = spark.createDataFrame(made, SCHEMA)
    features = training.unionByName(training.limit(50).withColumn("has_target_delay_4_stops", F.lit(False)))
    found = {r.metric: r.value for r in training_profile(training, features).collect()}
    labels = [r[4] for r in made]
    middle, high = (int(np.rint(np.percentile(labels, p))) for p in (50, 95))
    assert found == {
        "training_rows": "250", "distinct_vehicles": "7", "distinct_trips": "13", "routes": "3",
        "time_coverage": "2024-03-01 00:00:00 to 2024-03-01 04:09:00",
        "target_delay_min_p50_avg_p95_max": f"{min(labels)}, {middle}, {np.mean(labels):.2f}, {high}, {max(labels)}",
        "eligible_feature_rows": "300", "valid_4_stop_target_pct": "83.33",
    }


def test_empty_mart(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = {r.metric: r.value for r in training_profile(empty, empty).collect()}
    assert (found["training_rows"], found["distinct_trips"], found["time_coverage"]) == ("0", "0", None)


def test_histogram_scans_the_mart_once_and_combines_before_the_shuffle(spark, tmp_path):
    spark.createDataFrame(rows(20), SCHEMA).write.parquet(str(tmp_path / "mart"))
    plan = profile_histogram(spark.read.parquet(str(tmp_path / "mart")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_count" in plan
