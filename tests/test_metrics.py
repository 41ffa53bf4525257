from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from warehouse import position, positions, utc

from railweave.operators import metrics
from railweave.schemas import DEAD_LETTER_SCHEMA, METRIC_SCHEMA

NOW = utc(2026, 8, 30, 12, 0, 0)


def metric_rows(spark, rows):
    filled = []
    for number, row in enumerate(rows):
        base = {name: None for name in METRIC_SCHEMA.names}
        base.update({f.name: 0 for f in METRIC_SCHEMA.fields if f.dataType.typeName() == "integer"})
        base.update(metric_id=number, metric_timestamp=NOW, metric_kind="valid_batch", topic="t",
                    processing_duration_seconds=0.0)
        base.update(row)
        filled.append(tuple(base[n] for n in METRIC_SCHEMA.names))
    return spark.createDataFrame(filled, METRIC_SCHEMA)


@pytest.mark.parametrize(
    ("batch", "expected"),
    [((5, 3, 0, 0, 1.0), (2, 0)), ((1, 0, 1, 1, 1.0), (0, 1)), ((1, 3, 0, 0, -4.0), (0, 0))],
)
def test_batch_metric(spark, batch, expected):
    df = spark.createDataFrame([batch], "batch_size INT, persisted INT, dead_letters INT, errors INT, duration DOUBLE")
    row = metrics.batch_metric(df).first()
    assert (row.duplicate_events, row.error_count) == expected
    assert row.processing_duration_seconds >= 0


def test_freshness(spark):
    df = spark.createDataFrame([(NOW - timedelta(seconds=8),), (NOW - timedelta(seconds=97),), (None,), (NOW + timedelta(seconds=5),)], "t TIMESTAMP")
    found = metrics.with_freshness(df, "t", NOW, 60).collect()
    assert [(r.freshness_seconds, r.freshness_status) for r in found] == [
        (8.0, "HEALTHY"), (97.0, "STALE"), (None, "UNKNOWN"), (0.0, "HEALTHY"),
    ]


def test_progress_probe(spark):
    ages = [0, 300, 301, -1]
    df = spark.createDataFrame([(NOW - timedelta(seconds=a),) for a in ages] + [(None,)], "t TIMESTAMP")
    assert [r.healthy for r in metrics.with_progress_health(df, "t", NOW).collect()] == [True, True, False, False, False]


def test_lag(spark):
    committed = spark.createDataFrame([("t", 0, 95), ("t", 1, None), ("t", 2, 105), ("t", 3, -1001), ("t", 4, 3)], "topic STRING, partition INT, committed LONG")
    marks = spark.createDataFrame([("t", 0, 0, 100), ("t", 1, 20, 100), ("t", 2, 0, 100), ("t", 3, 20, 100), ("t", 4, 10, 100), ("t", 5, 7, 9)], "topic STRING, partition INT, low LONG, high LONG")
    found = metrics.consumer_lag(committed, marks)
    assert {r.partition: r.lag for r in found.collect()} == {0: 5, 1: 80, 2: 0, 3: 80, 4: 90, 5: 2}
    assert metrics.total_lag(found).first().total_lag == 257


def test_success_rate(spark):
    df = spark.createDataFrame([(10, 2), (0, 0)], "ok INT, bad INT")
    rates = [r[0] for r in df.select(metrics.success_rate(F.col("ok"), F.col("bad"))).collect()]
    assert rates == [10 / 12, None]


def test_throughput(spark):
    df = metric_rows(spark, [
        {"events_received": 10, "events_persisted": 9, "duplicate_events": 1},
        {"events_received": 30, "events_persisted": 30, "metric_timestamp": NOW - timedelta(hours=1), "failed_batch_count": 2, "retry_count": 2},
        {"events_received": 5, "events_persisted": 5, "metric_timestamp": NOW - timedelta(hours=1, seconds=-20)},
        {"events_persisted": 500, "metric_kind": "dead_letter", "dead_letter_events": 1, "metric_timestamp": NOW - timedelta(minutes=5)},
        {"events_persisted": 999, "metric_timestamp": NOW - timedelta(days=31)},
        {"events_persisted": 999, "metric_timestamp": NOW + timedelta(seconds=1)},
    ])
    row = metrics.throughput_totals(df, NOW).first()
    assert (row.events_received_total, row.events_persisted_total) == (45, 544)
    assert (row.batches_processed_total, row.batches_failed_total, row.retry_count_total) == (3, 2, 2)
    assert row.current_events_per_minute == (9 + 500) / 5
    assert row.peak_events_per_minute == 35
    empty = metrics.throughput_totals(df.limit(0), NOW).first()
    assert empty.events_received_total == 0 and empty.peak_events_per_minute == 0 and empty.current_events_per_minute == 0
    for minutes in (0, -1):
        with pytest.raises(ValueError, match="at least one minute"):
            metrics.throughput_totals(df, NOW, minutes)
        with pytest.raises(ValueError, match="at least one minute"):
            metrics.latency_distribution(df, NOW, minutes)


def test_latency_leaves_out_impossible_times(spark):
    rows = [
        position(1, NOW, 1, ingested_at=NOW, feed_timestamp=NOW - timedelta(seconds=1), vehicle_timestamp=None),
        position(2, NOW, 1, ingested_at=NOW, feed_timestamp=NOW - timedelta(seconds=2), vehicle_timestamp=None),
        position(3, NOW, 1, ingested_at=NOW, feed_timestamp=NOW - timedelta(seconds=3), vehicle_timestamp=None),
        position(4, NOW, 1, ingested_at=NOW, feed_timestamp=NOW - timedelta(seconds=10), vehicle_timestamp=None),
        position(5, NOW, 1, ingested_at=NOW, feed_timestamp=NOW + timedelta(seconds=1), vehicle_timestamp=None),
        position(6, NOW, 1, ingested_at=NOW, feed_timestamp=NOW - timedelta(seconds=86_401), vehicle_timestamp=None),
        position(7, NOW, 1, ingested_at=NOW, feed_timestamp=None, vehicle_timestamp=None),
    ]
    row = metrics.latency_distribution(positions(spark, rows), NOW).first()
    assert row.ingestion_latency_count == 4 and row.event_age_count == 4
    assert (row.ingestion_latency_p50, row.ingestion_latency_max) == (2.5, 10.0)
    assert row.ingestion_latency_p95 == pytest.approx(8.95)


def test_quality_and_health_of_empty_tables(spark):
    letters = spark.createDataFrame([], DEAD_LETTER_SCHEMA)
    assert tuple(metrics.quality_counts(letters, NOW).first()) == (0, 0, 0, 0)
    row = metrics.health_summary(metric_rows(spark, []), letters).first()
    assert (row.events_received, row.dead_letter_events, row.recent_batch_size) == (0, 0, None)


def test_static_counts_prefer_the_manifest(spark):
    routes = spark.range(3)
    history = spark.createDataFrame(
        [(1, {"routes": 7}), (2, {"routes": 8, "stops": 9})], "load_id LONG, row_counts MAP<STRING, LONG>"
    )
    row = metrics.static_counts(history, {"routes": routes}).first()
    assert (row.routes, row.stops, row.trips, row.static_count_source) == (8, 9, None, "load_manifest")
    row = metrics.static_counts(None, {"routes": routes}).first()
    assert (row.routes, row.stops, row.static_count_source) == (3, None, "table_count")
    row = metrics.static_counts(history.limit(0), {"routes": routes.limit(0)}).first()
    assert (row.routes, row.static_count_source) == (None, "unavailable")


def test_snapshot_is_one_row_and_one_json_object(spark):
    lag = spark.createDataFrame([("t", 0, 5)], "topic STRING, partition INT, lag LONG")
    snapshot = metrics.production_snapshot(
        positions(spark), metric_rows(spark, [{}]), spark.createDataFrame([], DEAD_LETTER_SCHEMA),
        lag, None, {"routes": spark.range(3)}, NOW,
    )
    assert snapshot.count() == 1
    value = json.loads(metrics.snapshot_json(snapshot).first().value)
    assert list(value) == sorted(value)
    assert value["total_lag"] == 5 and value["freshness_status"] == "UNKNOWN" and value["success_rate"] == 1.0
