"""Decoding, dead letters and the stream."""

from __future__ import annotations

import json
import math
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from railweave.functions.event_json import (
    dead_letters,
    decode_events,
    to_event_envelope,
    valid_records,
)
from railweave.operators.serving import newest_by_id
from railweave.functions.identity import build_event_id
from railweave.schemas import MESSAGE_SCHEMA
from railweave.sinks.inserts import insert_new
from railweave.sources.events import read_event_files
from railweave.streaming import ingest
from railweave.streaming import tables as streaming_tables
from railweave.session import subfolders
from railweave.streaming.ingest import BatchWriter, stream_to_tables
from railweave.streaming.tables import StreamTables, stream_retention
from warehouse import positions

EVENT = {
    "event_id": "e1", "ingested_at": "2026-08-30T12:00:00+00:00", "feed_timestamp": None,
    "vehicle_timestamp": "2026-08-30T11:59:59.5+00:00", "entity_id": "en", "vehicle_id": "v",
    "trip_id": "t", "route_id": "r", "direction_id": 1, "current_stop_sequence": 4,
    "latitude": 42.5, "longitude": -71, "speed": 1e1, "source": "s",
}
AT = datetime(2026, 8, 30, 12, tzinfo=UTC)


def event(**changes):
    return json.dumps({**EVENT, **changes}).encode()


def without(*names):
    return json.dumps({k: v for k, v in EVENT.items() if k not in names}).encode()


def messages(spark, values, partition=0, first=0):
    rows = [(f"k{i}", v, "topic", partition, first + i, AT) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


MISSING = "Missing or invalid required event fields: "
CASES = [
    (event(), None, None),
    (None, "ValueError", "Kafka message has no value"),
    (b"\xff\xfe{}", "UnicodeDecodeError", None),
    (b'{"event_id": ', "JSONDecodeError", None),
    (b"", "JSONDecodeError", None),
    (event() + b" x", "JSONDecodeError", None),
    (event() + event(), "JSONDecodeError", None),
    (event() + b"],[", "JSONDecodeError", None),
    (event() + b"},{", "JSONDecodeError", None),
    (event() + b',"k":1', "JSONDecodeError", None),
    (b" \n" + event() + b"\t ", None, None),
    (b"[1, 2]", "TypeError", "Kafka message value must decode to a JSON object"),
    (b"null", "TypeError", "Kafka message value must decode to a JSON object"),
    (b"5", "TypeError", "Kafka message value must decode to a JSON object"),
    (b'"{}"', "TypeError", "Kafka message value must decode to a JSON object"),
    (b'{"event_id":"malformed"}', "ValueError", MISSING + "vehicle_id, ingested_at, entity_id, source"),
    (without("source"), "ValueError", MISSING + "source"),
    (event(vehicle_id="  "), "ValueError", MISSING + "vehicle_id"),
    (event(vehicle_id=7, entity_id=None), "ValueError", MISSING + "vehicle_id, entity_id"),
    (event(ingested_at="soon"), "ValueError", "ingested_at must be a valid ISO-8601 timestamp"),
    (event(ingested_at="2026-08-30T12:00:00"), "ValueError", "ingested_at must include a timezone"),
    (event(ingested_at="2026-08-30"), "ValueError", "ingested_at must include a timezone"),
    (event(ingested_at="2026-08-30T12:00:00Z"), None, None),
    (event(feed_timestamp=""), "ValueError", "Invalid isoformat string: ''"),
    (event(vehicle_timestamp="x"), "ValueError", "Invalid isoformat string: 'x'"),
    (event(feed_timestamp=5), None, None),
    (event(nested={"vehicle_id": 1}), None, None),
    (event(latitude=float("nan"), speed=float("-inf")), None, None),
    (event(trip_id='NaN, " Infinity'), None, None),
    (event().replace(b'{', b'{"vehicle_id": 5, "extra": {"a": 1, "a": 2}, ', 1), None, None),
    (event()[:-1] + b', "vehicle_id": 5}', "ValueError", MISSING + "vehicle_id"),
    (event()[:-1] + b', "odd": NaNa}', "JSONDecodeError", None),
]


def test_every_message_gets_its_verdict(spark):
    found = decode_events(messages(spark, [c[0] for c in CASES])).orderBy("offset").collect()
    assert len(found) == len(CASES)
    for (value, error_type, reason), row in zip(CASES, found):
        assert row.error_type == error_type, value
        assert (row.record is None) == (error_type is not None)
        if reason is not None:
            assert row.error_reason == reason


def test_fields_of_the_wrong_type_become_null(spark):
    changes = {
        "trip_id": 5, "direction_id": "1", "current_stop_sequence": 4.0, "latitude": "42",
        "longitude": True, "speed": 3, "route_id": {"a": 1}, "bearing": 1.25,
    }
    row = valid_records(decode_events(messages(spark, [event(**changes)]))).first()
    assert (row.trip_id, row.direction_id, row.current_stop_sequence) == (None, None, None)
    assert (row.latitude, row.longitude, row.speed, row.route_id, row.bearing) == (None, 1.0, 3.0, None, 1.25)
    row = valid_records(decode_events(messages(spark, [event(latitude=float("nan"), speed=float("-inf"))]))).first()
    assert math.isnan(row.latitude) and row.speed == -math.inf
    row = valid_records(decode_events(messages(spark, [event(direction_id=True)]))).first()
    assert (row.direction_id, row.current_stop_sequence, row.longitude, row.speed) == (1, 4, -71.0, 10.0)
    assert row.vehicle_timestamp.isoformat() == "2026-08-30T11:59:59.500000"


def test_dead_letters_keep_bytes_and_readable_ids(spark):
    values = [b"\xff", event(source=None), None, event(ingested_at="x" * 10, vehicle_id="")]
    letters = dead_letters(decode_events(messages(spark, values)), F.lit(AT)).orderBy("kafka_offset").collect()
    assert [bytes(r.raw_payload) for r in letters] == [b"\xff", values[1], b"", values[3]]
    assert [r.original_event_id for r in letters] == [None, "e1", None, "e1"]
    assert [r.vehicle_id for r in letters] == [None, "v", None, None]


def test_long_reasons_are_kept_whole(spark):
    letter = dead_letters(
        decode_events(messages(spark, [event(feed_timestamp="y" * 5000)])), F.lit(AT)
    ).first()
    assert letter.error_reason == f"Invalid isoformat string: '{'y' * 5000}'"


def test_event_json_round_trip(spark):
    stored = positions(spark)
    envelope = to_event_envelope(stored)
    text = json.loads(envelope.orderBy("key").first().value)
    assert list(text) == sorted(text) and len(text) == 21 and text["speed"] is None
    assert text["ingested_at"] == "2026-08-30T12:01:02+00:00"
    sent = envelope.select(
        "key", F.col("value").cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
    )
    back = valid_records(decode_events(sent)).drop("topic", "partition", "offset")
    assert back.exceptAll(stored.drop("id")).isEmpty() and back.count() == 2


@pytest.mark.parametrize("batch_rows", [None, 3])
def test_insert_new_keeps_the_first_and_every_null(spark, batch_rows):
    schema = "k STRING, o INT"
    target = spark.createDataFrame([("a", 0), (None, 0)], schema)
    batch = spark.createDataFrame([("b", 2), ("a", 1), ("b", 1), (None, 3), (None, 4)], schema)
    found = insert_new(target, batch, ["k"], ["o"], batch_rows=batch_rows).collect()
    assert sorted(map(tuple, found), key=str) == [("b", 1), (None, 3), (None, 4)]
    assert insert_new(None, batch, ["k"], ["o"]).count() == 4


def test_insert_new_can_prune_by_a_shared_column(spark, tmp_path):
    schema = "k STRING, d STRING, o INT"
    spark.createDataFrame([("a", "1", 0), ("b", "2", 0)], schema).write.partitionBy("d").parquet(str(tmp_path / "t"))
    target = spark.read.schema(schema).parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([("a", "1", 1), ("c", "1", 1)], schema)
    found = insert_new(target, batch, ["k"], ["o"], shared=["d"], batch_rows=2)
    assert [r.k for r in found.collect()] == ["c"]


def totals(tables, spark):
    row = tables.read(spark, "metrics").groupBy("metric_kind").agg(
        F.sum("events_received"), F.sum("events_persisted"), F.sum("duplicate_events"),
        F.sum("dead_letter_events"), F.sum("error_count"),
    )
    return {r[0]: tuple(r)[1:] for r in row.collect()}


def test_a_batch_run_twice_gives_the_same_tables(spark, tmp_path):
    tables = StreamTables(str(tmp_path / "s"))
    write = BatchWriter(tables)
    batch = messages(spark, [event(), event(event_id="e2"), event(), b"bad", None])
    for _ in range(2):
        write(decode_events(batch), 0)
    assert tables.read(spark, "positions").count() == 2
    assert totals(tables, spark) == {"valid_batch": (3, 2, 1, 0, 0), "dead_letter": (2, 0, 0, 2, 2)}
    # The same messages again under a later batch id: nothing new, all counted as repeats.
    write(decode_events(batch), 1)
    assert tables.read(spark, "positions").count() == 2
    assert tables.read(spark, "dead_letters").count() == 2
    assert totals(tables, spark) == {"valid_batch": (6, 2, 4, 0, 0), "dead_letter": (4, 0, 2, 2, 4)}


@pytest.mark.parametrize("few", [200_000, 0])
def test_messages_of_one_place_are_told_apart(spark, tmp_path, monkeypatch, few):
    """A topic can be read twice into one batch; new ids are joined to their messages either way."""
    monkeypatch.setattr(ingest, "BROADCAST_KEYS", few, raising=False)
    tables = StreamTables(str(tmp_path / "s"))
    once = messages(spark, [event(), b"bad", event(event_id="e2")])
    other = messages(spark, [event(event_id="e3", vehicle_id="v3"), b"[]"])
    BatchWriter(tables)(decode_events(once.unionByName(once).unionByName(other)), 0)
    rows = tables.read(spark, "positions").collect()
    assert sorted((r.event_id, r.vehicle_id) for r in rows) == [
        (EVENT["event_id"], EVENT["vehicle_id"]), ("e2", EVENT["vehicle_id"]), ("e3", "v3"),
    ]
    assert sorted(r.id for r in rows) == [1, 2, 3]
    letters = tables.read(spark, "dead_letters").collect()
    assert [(r.kafka_offset, bytes(r.raw_payload)) for r in letters] == [(1, b"bad")]
    assert totals(tables, spark) == {"valid_batch": (5, 3, 2, 0, 0), "dead_letter": (3, 0, 2, 1, 3)}
    assert [p.name for p in (tmp_path / "s").iterdir() if p.name not in ("positions", "dead_letters", "metrics")] == []


def named(spark, **changes):
    """An event whose id is the one its record gives."""
    row = {**EVENT, **changes}
    key = build_event_id(
        F.lit(row["source"]), F.lit(row["entity_id"]), F.lit(row["vehicle_id"]),
        F.to_timestamp(F.lit(row["feed_timestamp"])),
    )
    return event(**{**changes, "event_id": spark.range(1).select(key).first()[0]})


def test_an_id_is_unique_over_all_dates(spark, tmp_path):
    write = BatchWriter(StreamTables(str(tmp_path / "s")))
    own = named(spark, feed_timestamp="2026-08-30T11:00:00Z")
    key = json.loads(own)["event_id"]
    first = [own, event(event_id="e2", feed_timestamp="2026-08-30T11:00:00Z")]
    # Both ids once more on another feed date, where their records do not give them.
    second = [*first, *(event(event_id=i, feed_timestamp="2026-08-29T11:00:00Z") for i in (key, "e2"))]
    third = [named(spark, feed_timestamp="2026-08-28T11:00:00Z"), own]
    for batch_id, values in enumerate((first, second, third, second)):
        write(decode_events(messages(spark, values)), batch_id)
    rows = write.tables.read(spark, "positions").collect()
    assert sorted((r.event_id == key, r.named, r.batch_id, str(r.feed_date)) for r in rows) == [
        (False, False, 0, "2026-08-30"), (False, True, 2, "2026-08-28"), (True, True, 0, "2026-08-30"),
    ]


def test_joined_batches_hold_the_same_rows(spark, tmp_path):
    tables = StreamTables(str(tmp_path / "s"))
    plain = StreamTables(str(tmp_path / "p"))
    for target, every in ((tables, 3), (plain, 1000)):
        write = BatchWriter(target, compact_every=every)
        for batch_id in range(8):
            values = [event(event_id=f"{batch_id}-{i}") for i in range(2)] + [event(), b"bad"]
            write(decode_events(messages(spark, values, first=10 * batch_id)), batch_id)
    for table, columns in (("positions", ["id", "event_id"]), ("dead_letters", ["dead_letter_id", "kafka_offset"]),
                           ("metrics", ["metric_id", "events_persisted"])):
        found, expected = (x.read(spark, table).select(*columns) for x in (tables, plain))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
        # The folders of a date do not grow with the number of batches.
        assert all(len(subfolders(spark, f"{tables.folder(table)}/{p}")) <= 4 for p in tables._parents(spark, table))
    assert {r.event_id for r in tables.newest_positions(spark, 2).collect()} == {"7-0", "7-1"}


def test_a_replacement_is_finished_after_a_failure(spark, tmp_path, monkeypatch):
    tables = StreamTables(str(tmp_path / "s"))
    write = BatchWriter(tables)
    for batch_id in range(4):
        days = [f"2026-08-{d}T11:00:00Z" for d in (28, 29)]
        write(decode_events(messages(spark, [event(event_id=f"{batch_id}-{d}", feed_timestamp=d) for d in days])), batch_id)
    before = sorted(r.event_id for r in tables.read(spark, "positions").collect())
    drop, dropped = streaming_tables.delete_folder, []

    def dies(spark, path):
        if len(dropped) == 3:
            raise OSError("the writer died")
        dropped.append(path)
        drop(spark, path)

    monkeypatch.setattr(streaming_tables, "delete_folder", dies)
    with pytest.raises(OSError):
        tables.compact(spark, "positions", before=4)
    monkeypatch.undo()
    # Nothing is lost meanwhile; what the next run finds twice it takes once.
    assert {r.event_id for r in tables.read(spark, "positions").collect()} == set(before)
    tables.compact(spark, "positions", before=4)
    assert sorted(r.event_id for r in tables.read(spark, "positions").collect()) == before
    assert [len(tables._batches(spark, "positions", p, 100)) for p in tables._parents(spark, "positions")] == [1, 1]
    assert sorted({r.event_id for r in tables.newest_positions(spark, 2).collect()}) == sorted(b for b in before if b[0] == "3")


def test_stream_retention_archives_then_deletes(spark, tmp_path):
    tables, archive = StreamTables(str(tmp_path / "s")), str(tmp_path / "archive")
    write = BatchWriter(tables)
    times = {"old": "2026-08-01T10:00:00Z", "new": "2026-08-30T10:00:00Z", "edge": "2026-08-16T13:00:00Z"}
    for batch_id, (name, at) in enumerate(times.items()):
        write(decode_events(messages(spark, [event(event_id=name, ingested_at=at, feed_timestamp=at)])), batch_id)
    write(decode_events(messages(spark, [event(event_id="last", ingested_at=times["old"])])), 3)
    removed = stream_retention(spark, tables, archive, AT, before=3)
    # The newest batch, which a restart may write again, is left alone.
    assert removed["positions_deleted"] == 1
    assert sorted(r.event_id for r in tables.read(spark, "positions").collect()) == ["edge", "last", "new"]
    assert "old" in spark.read.text(f"{archive}/positions/*").first().value
    assert not (tmp_path / "s/positions/named=false/feed_date=2026-08-01/batch_id=0").exists()
    assert stream_retention(spark, tables, archive, AT, before=3)["positions_deleted"] == 0


def test_ids_follow_topic_order_and_grow_over_batches(spark, tmp_path):
    tables = StreamTables(str(tmp_path / "s"))
    write = BatchWriter(tables)
    for batch_id in range(2):
        parts = [
            messages(spark, [event(event_id=f"{batch_id}-{p}-{i}") for i in range(3)], p, 10 * batch_id)
            for p in range(2)
        ]
        write(decode_events(parts[1].unionByName(parts[0])), batch_id)
    rows = tables.read(spark, "positions").orderBy("id").collect()
    assert [r.event_id for r in rows] == [f"{b}-{p}-{i}" for b in range(2) for p in range(2) for i in range(3)]
    assert len({r.id for r in rows}) == 12


@pytest.mark.parametrize("sliced", [False, True])
def test_numbers_are_dense_in_topic_order(spark, monkeypatch, sliced):
    monkeypatch.setattr(ingest, "OFFSET_RUN", 16)
    rows = spark.range(300).selectExpr(
        "'t' topic", "cast(if(id % 3 > 0, 1, id % 7) as int) partition", "id * 5 offset"
    )
    found = ingest.numbered(rows, 1000, "id", sliced=sliced).orderBy("partition", "offset").collect()
    assert [r.id for r in found] == list(range(1000, 1300))


def test_newest_positions_skip_older_batches(spark, tmp_path):
    tables = StreamTables(str(tmp_path / "s"))
    write = BatchWriter(tables)
    assert tables.newest_positions(spark, 5) is None
    for batch_id in range(4):
        values = [b"[]"] if batch_id == 2 else [event(event_id=f"{batch_id}-{i}") for i in range(3)]
        write(decode_events(messages(spark, values, first=10 * batch_id)), batch_id)
    for rows, batches in ((1, {3}), (3, {3}), (4, {1, 3}), (7, {0, 1, 3}), (100, {0, 1, 3})):
        found = tables.newest_positions(spark, rows)
        assert {r.batch_id for r in found.collect()} == batches
        newest = newest_by_id(found, rows).select("event_id").collect()
        every = newest_by_id(tables.read(spark, "positions"), rows).select("event_id").collect()
        assert newest == every


def test_stream_resumes_after_a_restart(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    messages(spark, [event(), event(event_id="e2"), b"[]"]).write.parquet(source)

    def run():
        stream = read_event_files(spark, source, files_per_batch=1)
        stream_to_tables(stream, root, checkpoint, available_now=True).awaitTermination()
        return StreamTables(root)

    assert run().read(spark, "positions").count() == 2
    # Nothing new: no further batch, so no further metric rows.
    before = run().read(spark, "metrics").count()
    messages(spark, [event(), event(event_id="e3")], first=3).write.mode("append").parquet(source)
    tables = run()
    assert tables.read(spark, "positions").count() == 3
    assert tables.read(spark, "metrics").count() > before
    assert tables.read(spark, "dead_letters").count() == 1
