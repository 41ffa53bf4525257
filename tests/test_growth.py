"""Queries that divide their work by the size of the tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from railweave.functions.identity import json_text
from railweave.operators import features
from railweave.plans import ingest_queries, model_queries
from railweave.sinks import mart
from railweave.sources.shaped import Tables
from railweave.streaming import ingest


def bundled(spark, folder, events=200):
    """Events and line items in the form of the bundled tables."""
    rows = spark.range(events).selectExpr(
        "id event_id", "timestamp_seconds(1700000000 + id) ts", "id % 7 user_id", "'view' event_type",
        "cast(id as double) value", "concat('{\"k\": ', id % 5, '}') props",
    )
    rows.write.parquet(f"{folder}/events.parquet")
    lines = spark.range(events).selectExpr("id div 7 l_orderkey", "id % 7 + 1 l_linenumber", "id % 20 l_partkey")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, str(folder))


def test_a_larger_topic_has_more_files_and_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest_queries, "FILE_MESSAGES", 10, raising=False)
    t = bundled(spark, tmp_path)
    made = ingest_queries._message_files(t, 2)
    path, files = made if isinstance(made, tuple) else (made, 8)
    assert files > 15
    stored = spark.read.parquet(path)
    assert stored.count() == 400
    assert stored.groupBy("key").count().filter("count <> 2").isEmpty()
    with ingest_queries._a_task_per_file(spark, files):
        assert spark.conf.get("spark.sql.files.minPartitionNum") == str(files)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_larger_tables_lie_in_more_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(model_queries, "BUCKET_ROWS", 10, raising=False)
    t, used = bundled(spark, tmp_path), []
    append = model_queries.append_bucketed

    def counted(df, path, keys, buckets):
        used.append(buckets)
        append(df, path, keys, buckets=buckets)

    monkeypatch.setattr(model_queries, "append_bucketed", counted)
    found = model_queries.observations_with_bucketed_schedule(t)
    plain = model_queries.observations_with_schedule(t).select(*found.columns)
    assert used == [20, 20, 20]
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_stop_times_are_grouped_once_for_all_passes_over_the_schedule(spark, tmp_path):
    t = bundled(spark, tmp_path)
    schedule = features.schedule_features(model_queries._schedule(t), hot_rows=2)
    plan = schedule._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan
    assert schedule.count() == 200


def test_texts_with_and_without_escapes(spark):
    texts = ["", "plain 1", "tail\n", "\n", 'quo"te', "back\\slash", "é", "\x7f", "a\tb", "🚌"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v string")
    found = {r.i: r.j for r in frame.select("i", json_text(F.col("v")).alias("j")).collect()}
    assert [found[i] for i in range(len(texts))] == [json.dumps(v) if v != "\x7f" else found[i] for i, v in enumerate(texts)]


def test_only_what_the_schedule_holds_is_moved_by_its_scan(spark, tmp_path, monkeypatch):
    t, moved = bundled(spark, tmp_path), []
    scan = features.exclusive_scan

    def seen(rows, *args, **options):
        moved.extend(rows.columns)
        return scan(rows, *args, **options)

    monkeypatch.setattr(features, "exclusive_scan", seen)
    rows = features.schedule_features(model_queries._schedule(t)).collect()
    assert "trip_id" in moved and "scheduled_departure_seconds" not in moved
    by_trip = {}
    for row in rows:
        by_trip.setdefault(row.trip_id, {})[row.stop_sequence] = row
    for trip in by_trip.values():
        for n, row in trip.items():
            after = trip.get(n + 1)
            travel = after and after.scheduled_arrival_seconds - row.scheduled_departure_seconds
            assert row.scheduled_travel_time_to_next_stop_sec == travel
            assert row.scheduled_dwell_time_sec == 30


def test_a_mart_run_joins_the_schedule_once(spark, tmp_path, monkeypatch):
    t, joins = bundled(spark, tmp_path), []
    join = features.observations_with_schedule

    def counted(observations, schedule):
        joins.append(1)
        return join(observations, schedule)

    for module in (features, mart):
        monkeypatch.setattr(module, "observations_with_schedule", counted, raising=False)
    runs = ingest_queries._two_runs(t)
    assert len(runs) == 2 and len(joins) == 2


def test_messages_are_made_once_and_written_as_files(spark, tmp_path, monkeypatch):
    t = bundled(spark, tmp_path)

    def refused(*args):
        raise AssertionError("messages written beside their topic")

    monkeypatch.setattr(ingest_queries, "materialize", refused)
    path, files = ingest_queries._message_files(t, 1)
    assert files >= 8
    stored = spark.read.parquet(path)
    assert sorted(map(str, stored.collect())) == sorted(map(str, t.messages.select(*stored.columns).collect()))


def test_new_rows_of_a_batch_are_found_once(spark, tmp_path, monkeypatch):
    t, kept = bundled(spark, tmp_path), []
    number = ingest.numbered

    def seen(rows, *args, **options):
        kept.append(rows.is_cached)
        return number(rows, *args, **options)

    monkeypatch.setattr(ingest, "numbered", seen)
    tables = ingest_queries._run(t, copies=1)
    assert kept == [True, True]
    messages = t.messages.count()
    assert tables.read(spark, "positions").count() + tables.read(spark, "dead_letters").count() == messages


@pytest.mark.parametrize("identified", [False, True])
def test_a_batch_takes_no_memory_of_the_executors_between_its_steps(spark, tmp_path, monkeypatch, identified):
    t, kept, moved = bundled(spark, tmp_path), [], []
    write, number = ingest.StreamTables.write_batch, ingest.numbered

    def stored():
        return sum(info.memSize() for info in spark.sparkContext._jsc.sc().getRDDStorageInfo())

    def written(*args):
        found = write(*args)
        kept.append(stored())
        return found

    def seen(rows, *args, **options):
        moved.append(rows.columns)
        return number(rows, *args, **options)

    monkeypatch.setattr(ingest.StreamTables, "write_batch", written)
    monkeypatch.setattr(ingest, "numbered", seen)
    before = stored()
    ingest_queries._run(t, copies=1, messages=ingest_queries._identified(t) if identified else None)
    assert kept == [before] * 3
    # New rows are found and numbered by their places alone.
    assert [len(columns) for columns in moved] == [4, 4]
