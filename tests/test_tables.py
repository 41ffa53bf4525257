"""Feed loading, activation, archive and retention."""

from __future__ import annotations

import os
from datetime import timedelta

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from warehouse import position, positions, utc

from railweave.functions.identity import build_event_id
from railweave.operators import retention
from railweave.schemas import FEED_SCHEMA, LEDGER_SCHEMA
from railweave.sinks import archive as archiving
from railweave.sinks.ledger import read_ledger, record_ingestion
from railweave.sinks.published import load_history, read_published
from railweave.sinks.static_snapshot import activate_snapshot
from railweave.sources import payloads
from railweave.sources.events import read_archived_rows
from railweave.sources.realtime_feed import flatten_feed
from railweave.sources.static_feed import (
    InvalidFeed,
    header_columns,
    read_feed,
    read_gtfs_table,
    validate_feed,
)

NOW = utc(2026, 8, 30, 12, 0, 0)
FEED = {
    "agency": "agency_id\nA\n",
    "routes": "route_id,route_type\nold,3\n",
    "stops": "stop_id,stop_name\nS,\"Stop \"\"S\"\", main\"\n",
    "trips": "trip_id,route_id\nT,old\n",
    "stop_times": "trip_id,stop_id\nT,S\n",
    "calendar": "service_id\nC\n",
}


def write_feed(folder, **changes):
    folder.mkdir()
    for name, text in {**FEED, **changes}.items():
        if text is not None:
            (folder / f"{name}.txt").write_bytes(text.encode() if isinstance(text, str) else text)
    return str(folder)


def test_tables_are_read_as_text(spark, tmp_path):
    folder = write_feed(tmp_path / "f", stops=b"\xef\xbb\xbfstop_id,stop_name\n007,\n8,\"a,b\"\n9,\"\"\n10,\"two\nlines\"\n")
    stops = read_gtfs_table(spark, folder, "stops")
    assert stops.dtypes == [("stop_id", "string"), ("stop_name", "string")]
    assert sorted(map(tuple, stops.collect())) == [("007", None), ("10", "two\nlines"), ("8", "a,b"), ("9", "")]


def test_part_files_with_another_header_are_rejected(spark, tmp_path):
    folder = tmp_path / "f" / "stop_times.txt"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("trip_id,stop_id\nT,S\n")
    (folder / "b.csv").write_text("stop_id,trip_id\nS,T\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_gtfs_table(spark, str(tmp_path / "f"), "stop_times").collect()


@pytest.mark.parametrize("header", ["a,a\n1,2\n", "a,,b\n1,2,3\n", ""])
def test_bad_headers_are_rejected(spark, tmp_path, header):
    folder = write_feed(tmp_path / "f", stops=header)
    with pytest.raises(InvalidFeed):
        header_columns(spark, f"{folder}/stops.txt")


def test_activation_replaces_everything_or_nothing(spark, tmp_path):
    root = str(tmp_path / "static")
    counts = activate_snapshot(spark, read_feed(spark, write_feed(tmp_path / "1")), root, "sum1", "a/1")
    assert counts["routes"] == 1 and read_published(spark, root, "stops").first().stop_name == 'Stop "S", main'

    changed = {"routes": "route_id,route_color,route_type\nreplacement,red,3\n"}
    broken = {
        "too many fields": {**changed, "stops": "stop_id,stop_name\nbad,too,many,columns\n"},
        "empty": {**changed, "trips": "trip_id,route_id\n"},
        "no stop times": {**changed, "stop_times": None},
        "no calendar": {**changed, "calendar": None},
    }
    for name, texts in broken.items():
        with pytest.raises((InvalidFeed, PySparkException, Py4JJavaError)):
            activate_snapshot(spark, read_feed(spark, write_feed(tmp_path / name, **texts)), root)
        assert [r.route_id for r in read_published(spark, root, "routes").collect()] == ["old"]
    with pytest.raises(InvalidFeed, match="Unsupported"):
        activate_snapshot(spark, {**read_feed(spark, str(tmp_path / "1")), "extra": spark.range(1)}, root)

    feed = write_feed(tmp_path / "2", **changed, stops="stop_id\nS\n", calendar=None, calendar_dates="service_id,date\n")
    activate_snapshot(spark, read_feed(spark, feed), root, "sum2", "a/2")
    assert [tuple(r) for r in read_published(spark, root, "routes").collect()] == [("replacement", "3", "red")]
    # A column the new feed lacks stays, as NULL; an optional table it lacks is emptied.
    assert [tuple(r) for r in read_published(spark, root, "stops").collect()] == [("S", None)]
    assert read_published(spark, root, "calendar").isEmpty()
    history = load_history(spark, root).orderBy("load_id").collect()
    assert [(r.load_id, r.checksum_sha256, r.row_counts["routes"]) for r in history] == [(1, "sum1", 1), (2, "sum2", 1)]


def test_feed_report(spark, tmp_path):
    feed = read_feed(spark, write_feed(tmp_path / "f", trips="trip_id,route_id\n", agency=None, calendar=None))
    bad = {(r.table_name, r.check_name) for r in validate_feed(feed).filter("not ok").collect()}
    assert bad == {("agency", "present"), ("trips", "not_empty"), ("calendar", "calendar_or_dates_present")}


def test_latest_snapshot_and_payloads(spark, tmp_path):
    for day in ("2026-08-29", "2026-08-30"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "feed.pb").write_bytes(day.encode())
    assert payloads.latest_snapshot(spark, str(tmp_path), "feed.pb").endswith("2026-08-30/feed.pb")
    with pytest.raises(FileNotFoundError):
        payloads.latest_snapshot(spark, str(tmp_path), "other.pb")
    rows = payloads.scan_payloads(spark, str(tmp_path)).orderBy("path").collect()
    assert [r.length for r in rows] == [10, 10] and rows[0].checksum_sha256 != rows[1].checksum_sha256
    stored = payloads.scan_payloads(spark, str(tmp_path)).withColumn("ingested_at", F.lit(NOW))
    payloads.store_payloads(stored, str(tmp_path / "stored"))
    assert os.listdir(tmp_path / "stored") and spark.read.parquet(str(tmp_path / "stored")).count() == 2
    assert (tmp_path / "stored" / "ingest_date=2026-08-30").is_dir()


def test_old_payloads_are_listed_once_their_copy_is_intact(spark, tmp_path):
    root, archive = tmp_path / "raw", tmp_path / "archive"
    root.mkdir()

    def add(name, days):
        (root / name).write_bytes(name.encode())
        at = (NOW - timedelta(days=days)).timestamp()
        os.utime(root / name, (at, at))

    def run():
        found = payloads.archive_expired_payloads(spark, str(root), str(archive), NOW)
        return sorted(r.path.rsplit("/", 1)[1] for r in found.collect())

    for name, days in (("old.pb", 8), ("new.pb", 6), ("other.txt", 9)):
        add(name, days)
    assert run() == ["old.pb"] == run()
    assert payloads.archived_payloads(spark, str(archive)).count() == 1
    # A later run copies only what is new, however old its time is.
    add("late.pb", 20)
    assert run() == ["late.pb", "old.pb"]
    assert sorted(bytes(r.content) for r in payloads.archived_payloads(spark, str(archive)).collect()) == [b"late.pb", b"old.pb"]


def feed(spark, entities, header=1_788_091_200):
    return spark.createDataFrame([(NOW, (header,), entities)], FEED_SCHEMA)


def test_feed_entities_become_events(spark):
    full = ("e1", (("T", "R", 1, "", "20260830"), ("v", ""), (1.5, 2.5, None, 0.0), "", 3, 2, 1_788_091_195, 5))
    bare = ("", (None, None, None, "S", None, 77, None, -1))
    found = flatten_feed(feed(spark, [full, bare, ("alert", None)]), "src").orderBy("current_stop_sequence").collect()
    assert len(found) == 2
    empty, row = found
    assert (row.trip_id, row.start_time, row.vehicle_label, row.stop_id) == ("T", None, None, None)
    assert (row.current_status, row.occupancy_status, row.speed) == ("IN_TRANSIT_TO", "FULL", 0.0)
    assert (empty.entity_id, empty.vehicle_id, empty.current_status, empty.occupancy_status) == (None, None, None, None)
    assert empty.stop_id == "S" and row.feed_timestamp is not None
    assert flatten_feed(feed(spark, [bare], header=0), "src").first().feed_timestamp is None
    key = build_event_id(*map(F.col, ("source", "entity_id", "vehicle_id", "feed_timestamp")))
    again = flatten_feed(feed(spark, [full]), "src")
    assert again.filter(key != F.col("event_id")).isEmpty()


def test_ledger_numbers_its_rows(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert read_ledger(spark, path).isEmpty()
    for count in (5, None):
        record_ingestion(spark, path, source="s", file_name="f", checksum="c", raw_path="p", record_count=count, at=NOW)
    rows = read_ledger(spark, path).orderBy("ingestion_id").collect()
    assert [(r.ingestion_id, r.record_count) for r in rows] == [(1, 5), (2, None)]
    assert read_ledger(spark, path).schema.names == LEDGER_SCHEMA.names


def old_and_new(spark):
    return positions(spark, [position(1, NOW - timedelta(days=30), 1), position(2, NOW, 1),
                             position(3, NOW - timedelta(days=14, seconds=-60), 1),
                             position(4, NOW - timedelta(days=14, seconds=60), 1)])


def test_retention_archives_then_removes(spark, tmp_path):
    root, folder = str(tmp_path / "tables"), str(tmp_path / "archive")
    archiving.store_dated(old_and_new(spark), root, "positions", "ingested_at")
    dry = retention.expired_count(read_published(spark, root, "positions"), "ingested_at", NOW, 14)
    assert dry.first().eligible == 2
    assert archiving.retention_run(spark, root, folder, NOW) == {"positions_deleted": 2, "metrics_deleted": 0}
    assert archiving.retention_run(spark, root, folder, NOW) == {"positions_deleted": 0, "metrics_deleted": 0}
    left = read_published(spark, root, "positions")
    assert sorted(r.id for r in left.collect()) == [2, 3]
    kept = read_archived_rows(spark, f"{folder}/positions/*", old_and_new(spark).schema)
    assert kept.exceptAll(old_and_new(spark).filter("id in (1, 4)")).isEmpty() and kept.count() == 2


def test_rows_without_a_time_stay_and_old_folders_go(spark, tmp_path):
    root = str(tmp_path / "tables")
    rows = old_and_new(spark).unionByName(positions(spark, [position(5, NOW, 1, ingested_at=NOW)]))
    rows = rows.withColumn("ingested_at", F.when(F.col("id") != 5, F.col("ingested_at")))
    archiving.store_dated(rows, root, "positions", "ingested_at")
    assert read_published(spark, root, "positions").count() == 5
    archiving.retention_run(spark, root, str(tmp_path / "a"), NOW)
    assert sorted(r.id for r in read_published(spark, root, "positions").collect()) == [2, 3, 5]
    dates = {path.name for path in (tmp_path / "tables/data").glob("*/_part=*")}
    assert "_part=2026-07-31" not in dates and len(list((tmp_path / "tables/_manifest").iterdir())) == 1


def test_failed_archive_removes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    archiving.store_dated(old_and_new(spark), root, "positions", "ingested_at")
    monkeypatch.setattr(archiving, "archive_jsonl", lambda df, folder: (folder, 1, ""))
    with pytest.raises(archiving.ArchiveMismatch):
        archiving.retention_run(spark, root, str(tmp_path / "a"), NOW)
    assert read_published(spark, root, "positions").count() == 4


def test_archive_digest_ignores_order(spark):
    lines = spark.createDataFrame([("a",), ("b",), ("a",)], "value STRING")
    assert archiving.content_digest(lines) == archiving.content_digest(lines.orderBy(F.col("value").desc()))
    assert archiving.content_digest(lines) != archiving.content_digest(lines.limit(2))
    assert archiving.content_digest(lines.limit(0))[0] == 0
