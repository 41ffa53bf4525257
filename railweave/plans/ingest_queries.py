"""Queries that run the ingestion path, its sinks and its streams over the bundled tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railweave.functions.event_json import (
    dead_letters,
    decode_events,
    to_event_envelope,
    valid_records,
)
from railweave.functions.identity import build_event_id
from railweave.operators.metrics import static_counts
from railweave.plans.registry import query
from railweave.session import materialize, shared_dir
from railweave.sinks.archive import archive_jsonl, retention_run, store_dated
from railweave.sinks.inserts import insert_new
from railweave.sinks.ledger import read_ledger, record_ingestion
from railweave.sinks.mart import append_staging, extend_training
from railweave.sinks.published import load_history, read_published
from railweave.sinks.static_snapshot import activate_snapshot, load_manifest
from railweave.sources.events import read_archived_rows, read_event_files
from railweave.sources.payloads import (
    archive_expired_payloads,
    archived_payloads,
    latest_snapshot,
    scan_payloads,
    store_payloads,
)
from railweave.sources.realtime_feed import flatten_feed
from railweave.sources.shaped import Tables
from railweave.sources.static_feed import read_feed, validate_feed
from railweave.streaming import live
from railweave.streaming.ingest import (
    stream_dedupe,
    stream_minute_rates,
    stream_to_tables,
)
from railweave.streaming.tables import StreamTables, stream_retention


def _now_value(t: Tables) -> datetime:
    """``now_of`` as a value, for jobs that write."""
    return t.positions.agg(F.max("ingested_at").alias("now")).first().now


def _folder(t: Tables, label: str) -> str:
    """A new folder in the cluster's shared one."""
    return f"{shared_dir(t.spark)}/railweave/{label}-{uuid.uuid4().hex}"


# Decoding


query(
    "decode_validate",
    'select key, "partition", "offset", error_type, error_reason from v_decoded',
)(
    lambda t: decode_events(t.messages).select(
        "key", "partition", "offset", "error_type", "error_reason"
    )
)
query(
    "valid_records",
    """select 'evt-' || p.id event_id, p.* exclude (id, event_id, bearing), p.bearing
    from v_positions p join v_decoded d on d.key = 'evt-' || p.id where error_type is null""",
)(lambda t: valid_records(decode_events(t.messages)).drop("topic", "partition", "offset"))
query(
    "route_dead_letters",
    """select case when json_valid(txt) and json_type(txt, '$.event_id') = 'VARCHAR'
            then json_extract_string(txt, '$.event_id') end original_event_id,
        topic, "partition", "offset" kafka_offset, error_type, error_reason,
        case when json_valid(txt) and json_type(txt, '$.vehicle_id') = 'VARCHAR'
            then nullif(json_extract_string(txt, '$.vehicle_id'), '') end vehicle_id,
        case when json_valid(txt) and json_type(txt, '$.trip_id') = 'VARCHAR'
            then nullif(json_extract_string(txt, '$.trip_id'), '') end trip_id,
        coalesce(octet_length(value), 0) = 0 empty_payload
    from v_decoded where error_type is not null""",
)(
    lambda t: dead_letters(decode_events(t.messages), F.current_timestamp())
    .withColumn("empty_payload", F.octet_length("raw_payload") == 0)
    .drop("processed_at", "raw_payload")
)


@query(
    "write_event_json",
    "select * exclude (id) from v_positions where event_id is not null"
    " and coalesce(vehicle_id, '') <> ''",
)
def write_event_json(t: Tables) -> DataFrame:
    """Positions written as event JSON and decoded again; rows without an id are rejected."""
    envelope = to_event_envelope(t.positions)
    messages = envelope.select(
        "key", F.col("value").cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
    )
    return valid_records(decode_events(messages)).drop("topic", "partition", "offset")


@query(
    "event_ids",
    """select id, sha256('{"entity_id": "' || entity_id || '", "feed_timestamp": '
        || coalesce('"' || strftime(feed_timestamp, '%Y-%m-%dT%H:%M:%S')
            || case when epoch_us(feed_timestamp) % 1000000 <> 0
                then strftime(feed_timestamp, '.%f') else '' end || '+00:00"', 'null')
        || ', "source": "events", "vehicle_id": ' || coalesce('"' || vehicle_id || '"', 'null') || '}')
        event_hash
    from v_positions""",
)
def event_ids(t: Tables) -> DataFrame:
    key = build_event_id(*map(F.col, ("source", "entity_id", "vehicle_id", "feed_timestamp")))
    return t.positions.select("id", key.alias("event_hash"))


FEED_SQL = """
select ingested_at, feed_timestamp, vehicle_timestamp, entity_id, vehicle_id, vehicle_label, trip_id,
    route_id, direction_id, start_time, start_date, stop_id, current_stop_sequence, current_status,
    latitude, longitude, bearing, speed, occupancy_status, source
from (
    select max(ts) over (partition by event_id // 100) + interval 2 seconds ingested_at,
        case when (event_id // 100) % 9 <> 0
            then date_trunc('second', max(ts) over (partition by event_id // 100)) end feed_timestamp,
        case when event_id % 11 <> 0 then date_trunc('second', ts) end vehicle_timestamp,
        'entity-' || event_id entity_id,
        case when event_id % 23 <> 0 and event_id % 29 <> 0 then cast(user_id as varchar) end vehicle_id,
        case when event_id % 23 <> 0 then 'Bus ' || user_id end vehicle_label,
        case when event_id % 31 <> 0 then cast(user_id as varchar) end trip_id,
        case when event_id % 31 <> 0 and event_id % 37 <> 0 then cast(user_id % 25 as varchar) end route_id,
        case when event_id % 31 <> 0 then event_id % 2 end direction_id,
        null::varchar start_time,
        case when event_id % 31 <> 0 then strftime(ts, '%Y%m%d') end start_date,
        case when event_id % 13 <> 0 then cast(event_id % 1000 as varchar) end stop_id,
        cast(json_extract_string(props, '$.k') as bigint) % 10 + 1 current_stop_sequence,
        case event_type when 'purchase' then 'INCOMING_AT' when 'view' then 'STOPPED_AT'
            when 'click' then 'IN_TRANSIT_TO' end current_status,
        case when event_id % 50 <> 0 then round(value / 4e0 - 10e0, 6) end latitude,
        case when event_id % 50 <> 0 then round(-71e0 - value / 10e0, 6) end longitude,
        case when event_id % 50 <> 0 then cast(event_id % 360 as double) end bearing,
        case when event_id % 50 <> 0 and event_id % 3 <> 0 then value end speed,
        ['EMPTY', 'MANY_SEATS_AVAILABLE', 'FEW_SEATS_AVAILABLE', 'STANDING_ROOM_ONLY',
            'CRUSHED_STANDING_ROOM_ONLY', 'FULL', 'NOT_ACCEPTING_PASSENGERS', 'NO_DATA_AVAILABLE',
            'NOT_BOARDABLE'][event_id % 11 + 1] occupancy_status,
        'events' source, event_id
    from events)
where event_id % 17 <> 0
"""


query("flatten_feed", FEED_SQL)(lambda t: flatten_feed(t.feeds, "events").drop("event_id"))


@query(
    "direct_ingest",
    f"""select count(*) inserted_rows, count(*) ledger_rows from (
        select distinct source, entity_id, vehicle_id, feed_timestamp from ({FEED_SQL}))""",
)
def direct_ingest(t: Tables) -> DataFrame:
    """Feed to table without a topic: flatten, insert what is new, and record it."""
    events = flatten_feed(t.feeds, "events")
    stored = materialize(insert_new(None, events, ["event_id"], ["ingested_at"]), "positions")
    again = insert_new(stored, events, ["event_id"], ["ingested_at"])
    ledger = _folder(t, "ledger")
    record_ingestion(
        t.spark, ledger, source="events", file_name="feed.pb", checksum="", raw_path="events",
        record_count=stored.count() + again.count(), at=_now_value(t),
    )
    return read_ledger(t.spark, ledger).select(
        F.lit(stored.count()).alias("inserted_rows"), F.col("record_count").alias("ledger_rows")
    )


# Inserts


@query(
    "idempotent_insert",
    """select id, event_id from (
        select *, row_number() over (partition by event_id order by id) place from v_positions)
    where event_id is null or (place = 1 and event_id not in (
        select event_id from v_positions where event_id is not null and current_status = 'STOPPED_AT'))""",
)
def idempotent_insert(t: Tables) -> DataFrame:
    """All observations against a table that already holds the stopped ones."""
    target = t.positions.filter("current_status = 'STOPPED_AT'")
    return insert_new(target, t.positions, ["event_id"], ["id"]).select("id", "event_id")


@query(
    "idempotent_insert_broadcast",
    """select id, event_id from (
        select *, row_number() over (partition by event_id order by id) place
        from v_positions where current_status = 'STOPPED_AT')
    where event_id is null or (place = 1 and event_id not in (
        select event_id from v_positions where event_id is not null
            and coalesce(current_status, '') <> 'STOPPED_AT'))""",
)
def idempotent_insert_broadcast(t: Tables) -> DataFrame:
    """A smaller batch, whose keys are sent to the table when their number allows it."""
    batch = t.positions.filter("current_status = 'STOPPED_AT'")
    target = t.positions.filter("coalesce(current_status, '') <> 'STOPPED_AT'")
    return insert_new(
        target, batch, ["event_id"], ["id"], batch_rows=batch.count()
    ).select("id", "event_id")


@query(
    "dead_letter_sink",
    """select dead_letter_id, "partition", kafka_offset from v_dead_letters
    where error_type <> 'ValueError'""",
)
def dead_letter_sink(t: Tables) -> DataFrame:
    """Every letter delivered twice, to a table that already holds the rejected events."""
    letters = t.dead_letters
    return insert_new(
        letters.filter("error_type = 'ValueError'"), letters.unionByName(letters),
        ["topic", "partition", "kafka_offset"], ["dead_letter_id"],
    ).select("dead_letter_id", "partition", "kafka_offset")


@query(
    "dead_letter_replay",
    "select count(*) batch_size, 0::bigint inserted, count(*) duplicates from v_dead_letters",
)
def dead_letter_replay(t: Tables) -> DataFrame:
    letters = t.dead_letters
    fresh = insert_new(
        letters, letters, ["topic", "partition", "kafka_offset"], ["dead_letter_id"]
    ).agg(F.count("*"))
    return letters.agg(F.count("*").alias("batch_size")).select(
        "batch_size", fresh.scalar().alias("inserted")
    ).withColumn("duplicates", F.greatest(F.col("batch_size") - F.col("inserted"), F.lit(0)))


# Streams


# Messages of a topic's file; decoding takes long, so the files and with them the tasks grow in number and not in size.
FILE_MESSAGES = 50_000


def _message_files(t: Tables, copies: int, messages: DataFrame | None = None) -> tuple[str, int]:
    """Messages as files, the whole set ``copies`` times over, as after a replayed topic; and the files of one copy."""
    path = _folder(t, "topic")
    messages = t.messages if messages is None else messages
    # Tasks cut what they write into files, so messages are made once and not moved.
    most = min(FILE_MESSAGES, max(1, -(-messages.count() // 8)))
    messages.write.mode("append").option("maxRecordsPerFile", most).parquet(path)
    # The files of the first copy alone, whatever is added to their folder.
    first = t.spark.read.schema(messages.schema).parquet(path)
    for _ in range(copies - 1):
        first.write.mode("append").parquet(path)
    return path, max(1, len(first.inputFiles()))


@contextmanager
def _a_task_per_file(spark: SparkSession, files: int) -> Iterator[None]:
    """Streams that run meanwhile do not gather their files into as few tasks as there are cores."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _run(t: Tables, copies: int = 2, messages: DataFrame | None = None, **options) -> StreamTables:
    root = _folder(t, "stream")
    path, files = _message_files(t, copies, messages)
    source = read_event_files(t.spark, path, files_per_batch=files)
    with _a_task_per_file(t.spark, files):
        stream_to_tables(source, root, _folder(t, "checkpoint"), available_now=True, **options).awaitTermination()
    return StreamTables(root)


@query(
    "stream_to_table",
    """select d.key event_id, p.vehicle_id, p.trip_id, p.ingested_at, p.feed_timestamp, p.latitude, p.speed
    from v_decoded d join v_positions p on d.key = 'evt-' || p.id where error_type is null""",
)
def stream_to_table(t: Tables) -> DataFrame:
    """The stored table after the stream has seen every message twice."""
    return _run(t).read(t.spark, "positions").select(
        "event_id", "vehicle_id", "trip_id", "ingested_at", "feed_timestamp", "latitude", "speed"
    )


def _identified(t: Tables) -> DataFrame:
    """Messages whose ids are made from their records, and each seventh once more on another feed date."""
    key = build_event_id(*map(F.col, ("source", "entity_id", "vehicle_id", "feed_timestamp")))
    own = t.positions.withColumn("event_id", key)
    moved = own.filter("id % 7 = 0").withColumns(
        {
            "feed_timestamp": F.col("ingested_at") + F.expr("interval 3 days"),
            "id": F.col("id") + 1_000_000_000,
        }
    )
    rows = own.unionByName(moved)
    sent = to_event_envelope(rows.withColumn("event_id", F.concat_ws(":", "event_id", "id")))
    # The place in the topic travels in the key: repeats come after the first of their id.
    return sent.select(
        F.split("key", ":")[0].alias("key"),
        F.encode(F.regexp_replace("value", '("event_id":"[0-9a-f]+):[0-9]+"', '$1"'), "UTF-8").alias("value"),
        F.lit("vehicle_positions").alias("topic"),
        F.lit(0).alias("partition"),
        F.split("key", ":")[1].cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


@query(
    "stream_to_table_by_feed_date",
    """select distinct entity_id, vehicle_id, feed_timestamp from v_positions
    where trim(coalesce(vehicle_id, '')) <> ''""",
)
def stream_to_table_by_feed_date(t: Tables) -> DataFrame:
    """Ids made from their records are looked up by date; those that repeat on another date are still found."""
    stored = _run(t, messages=_identified(t), compact_every=2).read(t.spark, "positions")
    return stored.select("entity_id", "vehicle_id", "feed_timestamp")


@query(
    "ingest_totals",
    """select 2 * count(*) events_received, count(*) filter (where error_type is null) events_persisted,
        count(*) filter (where error_type is not null) dead_letter_events,
        count(*) duplicate_events, 2 * count(*) filter (where error_type is not null) error_count,
        count(*) filter (where error_type is null) position_rows,
        count(*) filter (where error_type is null) position_ids,
        count(*) filter (where error_type is not null) letter_rows
    from v_decoded""",
)
def ingest_totals(t: Tables) -> DataFrame:
    """What the metric rows add up to, next to what the tables hold, after a full replay."""
    tables = _run(t)
    letters = tables.read(t.spark, "dead_letters")
    stored = tables.read(t.spark, "positions")
    totals = tables.read(t.spark, "metrics").agg(
        *(F.sum(c).alias(c) for c in (
            "events_received", "events_persisted", "dead_letter_events", "duplicate_events",
            "error_count"))
    )
    return totals.withColumns({
        "position_rows": stored.agg(F.count("*")).scalar(),
        "position_ids": stored.agg(F.countDistinct("id")).scalar(),
        "letter_rows": letters.agg(F.count("*")).scalar(),
    })


def _drain(t: Tables, stream: DataFrame, label: str, files: int = 1) -> DataFrame:
    """Run a stream over what is there, so many files, into a Parquet table and read that."""
    out = _folder(t, label)
    writer = stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", _folder(t, "checkpoint")
    ).trigger(availableNow=True)
    with _a_task_per_file(t.spark, files):
        writer.start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


def _drain_events(t: Tables, copies: int, stream, label: str) -> DataFrame:
    """What ``stream`` makes of the decoded events of a topic."""
    path, files = _message_files(t, copies)
    events = valid_records(decode_events(read_event_files(t.spark, path)))
    return _drain(t, stream(events), label, copies * files)


query(
    "event_stream_source",
    'select key, topic, "partition", "offset", value is null as empty from v_messages',
)(
    lambda t: _drain(t, read_event_files(t.spark, _message_files(t, 1)[0]), "events").select(
        "key", "topic", "partition", "offset", F.col("value").isNull().alias("empty")
    )
)
query("stream_dedupe", "select key event_id from v_decoded where error_type is null")(
    lambda t: _drain_events(
        t, 2, lambda events: stream_dedupe(events.select("event_id", "ingested_at"), "40 days"), "dedupe"
    ).select("event_id")
)
query(
    "stream_minute_rates",
    """with seen as (select ingested_at from v_decoded where error_type is null)
    select date_trunc('minute', ingested_at) as minute, count(*) events from seen
    group by 1 having date_trunc('minute', min(ingested_at)) + interval 1 minute
        <= (select max(ingested_at) from seen) - interval 10 minutes""",
)(
    lambda t: _drain_events(t, 1, lambda events: stream_minute_rates(events, "10 minutes"), "minutes").select(
        "minute", "events"
    )
)


def _as_stream(t: Tables, parts: list[DataFrame], label: str) -> DataFrame:
    """Tables as a stream of files, one after the other."""
    path = _folder(t, label)
    for part in parts:
        part.coalesce(2).write.mode("append").parquet(path)
    return t.spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 2).parquet(path)


@query(
    "stream_sliding_rates",
    """select w window_end, round(sum(events_persisted) / 5.0::double, 6) events_per_minute
    from (select *, unnest(generate_series(
        date_trunc('minute', metric_timestamp) + interval 1 minute,
        date_trunc('minute', metric_timestamp) + interval 5 minutes, interval 1 minute)) w
        from v_metrics)
    where w <= (select max(metric_timestamp) from v_metrics) - interval 10 days
    group by w""",
)
def stream_sliding_rates(t: Tables) -> DataFrame:
    """Every window that the watermark has closed, of a stream of metric rows."""
    at = F.col("metric_timestamp")
    ends = t.metrics.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    cuts = [ends.low + (ends.high - ends.low) * i / 3 for i in range(4)]
    parts = [t.metrics.filter((at >= a) & (at < b)) for a, b in zip(cuts, cuts[1:])]
    rows = _as_stream(t, [*parts, t.metrics.filter(at >= cuts[-1])], "metric-rows")
    return _drain(t, live.stream_sliding_rates(rows, "10 days"), "sliding")


FLEET_AGE = timedelta(hours=12)


@query(
    "stream_current_fleet",
    """select vehicle_key, event_timestamp, id, route_id, latitude, speed from (
        select *, row_number() over (partition by vehicle_key order by event_timestamp desc, id desc) place
        from (select *, coalesce(nullif(vehicle_id, ''), nullif(entity_id, ''), cast(id as varchar)) vehicle_key
            from v_recent where event_timestamp >= (select max(event_timestamp) from v_recent) - interval 12 hours))
    where place = 1""",
)
def stream_current_fleet(t: Tables) -> DataFrame:
    """The fleet view after a stream whose rows come out of order."""
    rows = _as_stream(t, [t.positions.filter(F.col("id") % 4 == i) for i in range(4)], "position-rows")
    root = _folder(t, "fleet")
    live.stream_fleet(rows, root, _folder(t, "checkpoint"), FLEET_AGE, available_now=True).awaitTermination()
    fleet = live.read_fleet(t.spark, root, rows.schema, FLEET_AGE)
    return fleet.select("vehicle_key", "event_timestamp", "id", "route_id", "latitude", "speed")


# Schedule feeds


def _feed_tables(t: Tables) -> dict[str, DataFrame]:
    agency = t.routes.select(
        "agency_id", F.concat(F.lit("Agency \"A\", "), "agency_id").alias("agency_name")
    ).distinct()
    dates = t.positions.select(
        F.lit("P").alias("service_id"), F.col("start_date").alias("date"),
        F.lit("1").alias("exception_type"),
    ).distinct()
    return {
        "agency": agency, "routes": t.routes, "stops": t.stops, "trips": t.trips,
        "stop_times": t.stop_times, "calendar_dates": dates,
    }


def _extracted_feed(t: Tables) -> str:
    """The feed as CSV, one folder of part files per table."""
    folder = _folder(t, "feed")
    for name, table in _feed_tables(t).items():
        table.write.option("header", "true").option("escape", '"').csv(f"{folder}/{name}.txt")
    return folder


@query("scan_static_table", "select * from v_stop_times")
def scan_static_table(t: Tables) -> DataFrame:
    return read_feed(t.spark, _extracted_feed(t))["stop_times"]


@query(
    "feed_completeness",
    """select unnest(['agency', 'routes', 'stops', 'trips', 'stop_times', 'calendar', 'agency',
            'routes', 'stops', 'trips', 'stop_times']) table_name,
        unnest(['present', 'present', 'present', 'present', 'present', 'calendar_or_dates_present',
            'not_empty', 'not_empty', 'not_empty', 'not_empty', 'not_empty']) check_name, true ok""",
)
def feed_completeness(t: Tables) -> DataFrame:
    return validate_feed(read_feed(t.spark, _extracted_feed(t)))


@query(
    "activate_static_snapshot",
    "select * exclude (shape_id), null::varchar shape_id from v_trips",
)
def activate_static_snapshot(t: Tables) -> DataFrame:
    """Two activations; the second feed lost a column, which stays as NULL."""
    root = _folder(t, "static")
    feed = read_feed(t.spark, _extracted_feed(t))
    activate_snapshot(t.spark, feed, root, "first", "archive/first")
    activate_snapshot(
        t.spark, {**feed, "trips": feed["trips"].drop("shape_id")}, root, "second", "archive/second"
    )
    return read_published(t.spark, root, "trips")


@query(
    "load_history",
    """select 1::bigint load_id, 'first' checksum_sha256, (select count(*) from v_routes) routes,
        (select count(*) from v_stop_times) stop_times""",
)
def load_history_of(t: Tables) -> DataFrame:
    root = _folder(t, "static")
    activate_snapshot(t.spark, _feed_tables(t), root, "first", "archive/first")
    return load_history(t.spark, root).select(
        "load_id", "checksum_sha256",
        F.col("row_counts")["routes"].alias("routes"),
        F.col("row_counts")["stop_times"].alias("stop_times"),
    )


@query(
    "load_manifest",
    """select 'c' checksum_sha256, 'archive/c.zip' archive_path, (select count(*) from v_routes) routes,
        (select count(*) from v_stops) stops, (select count(*) from v_trips) trips,
        (select count(*) from v_stop_times) stop_times""",
)
def manifest(t: Tables) -> DataFrame:
    names = ("routes", "stops", "trips", "stop_times")
    tables = {name: getattr(t, name) for name in names}
    return load_manifest(tables, "c", "archive/c.zip").select(
        "checksum_sha256", "archive_path", *(F.col("row_counts")[n].alias(n) for n in names)
    )


@query(
    "static_counts_of_manifest",
    """select (select count(*) from v_routes) routes, (select count(*) from v_stops) stops,
        (select count(*) from v_trips) trips, (select count(*) from v_stop_times) stop_times,
        null::bigint calendar, (select count(distinct start_date) from v_positions) calendar_dates,
        'load_manifest' static_count_source""",
)
def static_counts_of_manifest(t: Tables) -> DataFrame:
    """Counts that the newest load wrote down, without reading its tables."""
    root = _folder(t, "static")
    activate_snapshot(t.spark, _feed_tables(t), root, "first", "archive/first")
    return static_counts(load_history(t.spark, root), {})


# Archive and retention


@query(
    "raw_date_partition",
    """select cast(ingested_at as date) ingest_date, count(*) payloads from v_messages
    where value is not null group by 1""",
)
def raw_date_partition(t: Tables) -> DataFrame:
    """Message bodies stored by ingestion date, counted per date folder."""
    root = _folder(t, "payloads")
    bodies = t.messages.filter("value is not null")
    store_payloads(
        bodies.select(F.col("timestamp").alias("ingested_at"), F.col("value").alias("content")), root
    )
    return t.spark.read.parquet(root).groupBy("ingest_date").agg(F.count("*").alias("payloads"))


@query("archive_jsonl", "select * from v_positions")
def archive_round_trip(t: Tables) -> DataFrame:
    path, _, _ = archive_jsonl(t.positions, _folder(t, "archive"))
    return read_archived_rows(t.spark, path, t.positions.schema)


@query(
    "retention_job",
    """select 'positions' table_name, id, "at" from (
        select id, case when id % 501 <> 0 then ingested_at end "at", now_ts from v_positions, v_now)
        where "at" >= now_ts - interval 14 days or "at" is null
    union all select 'dead_letters', dead_letter_id, processed_at from v_dead_letters, v_now
        where processed_at >= now_ts - interval 30 days
    union all select 'metrics', metric_id, metric_timestamp from v_metrics, v_now
        where metric_timestamp >= now_ts - interval 30 days""",
)
def retention_job(t: Tables) -> DataFrame:
    """Rows that survive one clean-up of the three tables; those without a time do."""
    root = _folder(t, "tables")
    keys = {
        "positions": ("id", "ingested_at"), "dead_letters": ("dead_letter_id", "processed_at"),
        "metrics": ("metric_id", "metric_timestamp"),
    }
    timed = t.positions.withColumn("ingested_at", F.expr("if(id % 501 <> 0, ingested_at, null)"))
    for name, (_, column) in keys.items():
        store_dated(timed if name == "positions" else getattr(t, name), root, name, column)
    retention_run(t.spark, root, _folder(t, "archive"), _now_value(t))
    left = [
        read_published(t.spark, root, name).select(
            F.lit(name).alias("table_name"), F.col(key).alias("id"), F.col(column).alias("at")
        )
        for name, (key, column) in keys.items()
    ]
    return left[0].unionByName(left[1]).unionByName(left[2])


@query(
    "stream_retention",
    """select count(*) filter (where p.ingested_at >= now_ts - interval 14 days) left_rows,
        count(*) filter (where p.ingested_at < now_ts - interval 14 days) archived_rows
    from v_decoded d join v_positions p on d.key = 'evt-' || p.id, v_now where error_type is null""",
)
def stream_retention_of(t: Tables) -> DataFrame:
    """Positions that survive a clean-up of what the stream wrote, and what its archive holds."""
    tables, archive = _run(t, copies=1), _folder(t, "archive")
    stream_retention(t.spark, tables, archive, _now_value(t), before=1 << 30)
    left = tables.read(t.spark, "positions").agg(F.count("*").alias("left_rows"))
    return left.withColumn("archived_rows", t.spark.read.text(f"{archive}/positions/*").agg(F.count("*")).scalar())


# Payload files


def _payload_files(t: Tables) -> str:
    """Message bodies as files below one folder per day."""
    folder = _folder(t, "raw")
    bodies = t.messages.filter("value is not null").select(
        F.hex("value").alias("value"), F.to_date("timestamp").alias("day")
    )
    bodies.hint("rebalance", "day").write.partitionBy("day").text(folder)
    return folder


@query(
    "raw_payload_scan",
    """select cast(ingested_at as date) as day, count(*) payloads, true whole, true checked
    from v_messages where value is not null group by 1""",
)
def raw_payload_scan(t: Tables) -> DataFrame:
    """Files read whole: the bodies in them per day, and whether sizes and checksums are those of the bytes."""
    files = scan_payloads(t.spark, _payload_files(t), "*.txt")
    lines = F.size(F.split(F.col("content").cast("string"), "\n")) - 1
    day = F.regexp_extract("path", r"day=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    return files.groupBy(day.alias("day")).agg(
        F.sum(lines).alias("payloads"),
        F.bool_and(F.col("length") == F.octet_length("content")).alias("whole"),
        F.bool_and(F.col("checksum_sha256") == F.sha2("content", 256)).alias("checked"),
    )


@query("latest_snapshot", "select max(cast(ingested_at as date)) as day from v_messages where value is not null")
def latest_snapshot_of(t: Tables) -> DataFrame:
    path = latest_snapshot(t.spark, _payload_files(t), "*.txt")
    day = F.regexp_extract(F.lit(path), r"day=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    return t.spark.range(1).select(day.alias("day"))


@query(
    "payload_retention",
    "select count(*) archived from v_messages where value is not null",
)
def payload_retention(t: Tables) -> DataFrame:
    """What the archive holds after two runs over the same expired files."""
    raw, archive = _payload_files(t), _folder(t, "archive")
    later = datetime.now(UTC) + timedelta(days=30)
    for _ in range(2):
        archive_expired_payloads(t.spark, raw, archive, later, pattern="*.txt")
    content = archived_payloads(t.spark, archive).select(F.col("content").cast("string").alias("content"))
    return content.agg(F.sum(F.size(F.split("content", "\n")) - 1).alias("archived"))


# Stored marts


@query(
    "training_mart_refresh",
    """with first_run as (
        select * from v_training where target_observation_id <= (select max(id) // 2 from v_positions)),
    again as (
        select * from v_training
        where prediction_timestamp >= (select max(prediction_timestamp) from first_run) - interval 24 hours)
    select observation_id, prediction_timestamp, target_observation_id, target_delay_4_stops_sec
    from first_run where observation_id not in (select observation_id from again)
    union all
    select observation_id, prediction_timestamp, target_observation_id, target_delay_4_stops_sec
    from again""",
)
def training_mart_refresh(t: Tables) -> DataFrame:
    """The published mart after a run over the older half and one over everything."""
    return _two_runs(t)[1].select(*LABEL_COLUMNS)


LABEL_COLUMNS = [
    "observation_id", "prediction_timestamp", "target_observation_id", "target_delay_4_stops_sec",
]


def _two_runs(t: Tables, **options) -> list[DataFrame]:
    """The mart after a run over the older half and after one that knows that half by its totals."""
    root, staging = _folder(t, "mart"), _folder(t, "staging")
    middle = t.positions.agg((F.max("id") / 2).cast("long").alias("id")).first().id
    marts = []
    for positions in (t.positions.filter(F.col("id") <= middle), t.positions):
        append_staging(t.spark, positions, staging)
        extend_training(t.spark, t.spark.read.parquet(staging), t.stop_times, root, **options)
        marts.append(read_published(t.spark, root, "ml_delay_training"))
    return marts


@query(
    "incremental_lookback",
    """with first_run as (
        select * from v_training where target_observation_id <= (select max(id) // 2 from v_positions)),
    again as (
        select * from v_training
        where prediction_timestamp >= (select max(prediction_timestamp) from first_run) - interval 24 hours)
    select observation_id, prediction_timestamp, target_observation_id, target_delay_4_stops_sec
    from first_run where observation_id not in (select observation_id from again)
    union all
    select observation_id, prediction_timestamp, target_observation_id, target_delay_4_stops_sec
    from again""",
)
def incremental_lookback(t: Tables) -> DataFrame:
    """A first run over the older half of the observations, then a run over all of them."""
    return _two_runs(t)[1].select(*LABEL_COLUMNS)


@query(
    "late_label_arrival",
    """with first_run as (
        select * from v_training where target_observation_id <= (select max(id) // 2 from v_positions))
    select observation_id from v_training
    where prediction_timestamp >= (select max(prediction_timestamp) from first_run) - interval 24 hours
        and observation_id not in (select observation_id from first_run)
        and observation_id <= (select max(id) // 2 from v_positions)""",
)
def late_label_arrival(t: Tables) -> DataFrame:
    """Old observations that gain their label in the second run."""
    first, second = _two_runs(t)
    middle = t.positions.agg((F.max("id") / 2).cast("long").alias("id")).first().id
    gained = second.join(first.select("observation_id"), "observation_id", "left_anti")
    return gained.filter(F.col("observation_id") <= middle).select("observation_id")


@query(
    "training_mart_extended",
    """with first_run as (select * from v_half_training),
    again as (
        select * from v_training
        where prediction_timestamp >= (select max(prediction_timestamp) from first_run) - interval 24 hours)
    select * from first_run where observation_id not in (select observation_id from again)
    union all by name select * from again""",
)
def training_mart_extended(t: Tables) -> DataFrame:
    """All columns of the mart after two runs, with every scan of the second cut into slices."""
    return _two_runs(t, hot_rows=3)[1].drop("training_row_created_at", "_date", "_part")
