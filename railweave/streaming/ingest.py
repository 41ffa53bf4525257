"""The event stream: decode, insert once, dead-letter the rest, and count every batch."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railweave.functions.event_json import dead_letters, decode_events, valid_records
from railweave.functions.gtfs_time import source_time
from railweave.functions.identity import build_event_id
from railweave.operators.metrics import batch_metric
from railweave.operators.scan import HOT_ROWS, Measure, exclusive_scan
from railweave.schemas import DEAD_LETTER_SCHEMA, METRIC_SCHEMA, POSITION_SCHEMA
from railweave.sinks.inserts import BROADCAST_KEYS, insert_new
from railweave.streaming.tables import (
    BATCH_IDS,
    DAY,
    DEAD_LETTERS,
    FEED_DATE,
    METRICS,
    NAMED,
    POSITIONS,
    StreamTables,
)

OFFSET_RUN = 1 << 17
# Batches of a date are joined after this many.
COMPACT_EVERY = 100
# The number of a message within its batch; unlike its place in the topic, it never repeats there.
ROW = "_row"
PLACE = ["topic", "partition", "offset"]
# What only dead letters need of a message.
LETTER_COLUMNS = ["value", "context_event_id", "context_vehicle_id", "context_trip_id"]


def numbered(
    rows: DataFrame, first: int, id_column: str, offset: str = "offset", sliced: bool = False
) -> DataFrame:
    """Ids from ``first`` in topic order, the same on every attempt.

    Rows are numbered within their source partition and shifted by the sizes of the partitions
    before it. ``sliced`` numbers a large batch in runs of offsets instead of whole partitions;
    offsets are unique in a partition, so a run holds at most ``OFFSET_RUN`` rows.
    """
    place = ["topic", "partition"]
    sizes = rows.groupBy(*place).agg(F.count("*").alias("_size"))
    # One row per source partition, so this window is small whatever the batch.
    earlier = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*place, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    counted = exclusive_scan(
        rows.withColumn("_one", F.lit(1).cast("long")), place, offset,
        [Measure("_before", "sum", "_one")],
        slice_width=OFFSET_RUN, hot_rows=None, sliced=sliced,
    )
    return (
        counted.join(F.broadcast(shifts), place)
        .withColumn(id_column, F.lit(first) + F.col("_shift") + F.coalesce("_before", F.lit(0)))
        .drop("_one", "_before", "_shift")
    )


def _metric_row(spark: SparkSession, batch_id: int, at: datetime, kind: str, number: int, **values):
    types = {
        "topic": "string", "batch_size": "int", "persisted": "int", "dead_letters": "int",
        "errors": "int", "duration": "double", "latest_source_event_timestamp": "timestamp",
        "latest_ingestion_timestamp": "timestamp",
    }
    # Literals over one row: this needs no Python worker, as createDataFrame would.
    counters = spark.range(1).select(
        *(F.lit(values.get(name)).cast(kind_).alias(name) for name, kind_ in types.items())
    )
    return batch_metric(counters).select(
        F.lit(batch_id * 2 + number).cast("long").alias("metric_id"),
        F.lit(at).alias("metric_timestamp"),
        F.lit(kind).alias("metric_kind"),
        "topic", "batch_size", "events_received", "events_persisted", "duplicate_events",
        "dead_letter_events", "error_count",
        F.lit(0).alias("retry_count"), F.lit(0).alias("failed_batch_count"),
        "processing_duration_seconds", "latest_source_event_timestamp",
        "latest_ingestion_timestamp",
    )


@contextmanager
def _kept(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows of a batch that are read more than once: what it takes to find them is done once.

    They lie on the executors' disks, so memory does not grow with the batch. Rows should be narrow: a task
    that does not run where its rows lie takes them into memory at once.
    """
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        yield rows
    finally:
        rows.unpersist()


def _with_numbers(rows: DataFrame, numbers: DataFrame, count: int) -> DataFrame:
    """The rows that ``count`` numbers are for; few numbers are sent to where the rows are read."""
    return rows.join(F.broadcast(numbers) if count <= BROADCAST_KEYS else numbers, ROW)


class BatchWriter:
    """``foreachBatch`` function for decoded messages.

    A batch is decoded once, into files. Which of its messages are new, and their ids, is found from keys and
    places alone; what else a message holds is moved once, to where it is stored. Neither is kept in
    memory, so executors need no more of it for a larger batch.

    Every write replaces what an earlier attempt of the batch left, so running a batch again after a
    failure gives the same tables; offsets advance only after it returns.

    An event id is unique over the whole history. Ids that ``build_event_id`` gives for their record
    name its feed time and are looked up on that date; the others lie apart, and are looked up everywhere.
    Either way every id that is equal is found.
    """

    def __init__(self, tables: StreamTables, compact_every: int = COMPACT_EVERY):
        self.tables = tables
        self.compact_every = compact_every

    def __call__(self, decoded: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        spark = decoded.sparkSession
        own = build_event_id(
            *(F.col(f"record.{c}") for c in ("source", "entity_id", "vehicle_id", "feed_timestamp"))
        )
        rejected = F.col("error_type").isNotNull()
        # Whether an id is its record's own takes a hash, which is kept with the message.
        kept = decoded.select(
            *PLACE, "record", "error_type", "error_reason",
            *(F.when(rejected, F.col(name)).alias(name) for name in LETTER_COLUMNS),
            (F.col("record.event_id") == own).alias(NAMED.name),
            F.monotonically_increasing_id().alias(ROW),
        )
        with self.tables.staged(kept, batch_id) as decoded:
            self._write(spark, decoded, batch_id, started)
        if batch_id % self.compact_every == self.compact_every - 1:
            for table in (POSITIONS, DEAD_LETTERS, METRICS):
                self.tables.compact(spark, table, before=batch_id)

    def _stored_positions(self, spark: SparkSession, records: DataFrame, batch_id: int):
        """What the batch's ids can be equal to, without what an earlier attempt of it left."""
        seen = records.groupBy(NAMED.name, FEED_DATE.name).agg(F.count("event_id").alias("ids")).collect()
        everywhere = any(row.ids and not row.named for row in seen)
        stored = self.tables.lookup(spark, {row.feed_date for row in seen}, everywhere)
        return None if stored is None else stored.filter(F.col("batch_id") != batch_id)

    def _write(self, spark: SparkSession, decoded: DataFrame, batch_id: int, started: float) -> None:
        tables = self.tables
        arrived = decoded.agg(
            F.max("topic").alias("topic"),
            F.count_if(F.col("error_type").isNull()).alias("valid"),
            F.count_if(F.col("error_type").isNotNull()).alias("rejected"),
            F.max(F.coalesce("record.vehicle_timestamp", "record.feed_timestamp")).alias("source"),
            F.max("record.ingested_at").alias("ingested"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.first(F.current_timestamp()).alias("now"),
        ).first()
        metrics = []
        if arrived.valid:
            records = valid_records(decoded, NAMED.name, ROW).withColumn(FEED_DATE.name, F.to_date("feed_timestamp"))
            fresh = insert_new(
                self._stored_positions(spark, records, batch_id), records.select("event_id", *PLACE, ROW),
                ["event_id"], [*PLACE, ROW], batch_rows=arrived.valid,
            ).select(*PLACE, ROW)
            with _kept(fresh) as fresh:
                ids = numbered(
                    fresh, batch_id * BATCH_IDS + 1, "id", sliced=arrived.valid > HOT_ROWS
                ).select(ROW, "id")
                rows = _with_numbers(records, ids, fresh.count()).select(
                    *POSITION_SCHEMA.names, NAMED.name, FEED_DATE.name
                )
                persisted = tables.write_batch(rows, POSITIONS, batch_id)
            metrics.append(_metric_row(
                spark, batch_id, arrived.now, "valid_batch", 0, topic=arrived.topic,
                batch_size=arrived.valid, persisted=persisted,
                dead_letters=0, errors=0, duration=time.monotonic() - started,
                latest_source_event_timestamp=arrived.source,
                latest_ingestion_timestamp=arrived.ingested,
            ))
        if arrived.rejected:
            letters = dead_letters(decoded, F.lit(arrived.now), ROW)
            stored = tables.read(spark, DEAD_LETTERS)
            if stored is not None:
                # Offsets grow, so file statistics skip what earlier batches left unless a batch is sent again.
                near = F.col("kafka_offset").between(arrived.first_offset, arrived.last_offset)
                stored = stored.filter((F.col("batch_id") != batch_id) & near)
            place = ["topic", "partition", "kafka_offset"]
            fresh = insert_new(
                stored, letters.select(*place, ROW), place, ["kafka_offset", ROW], batch_rows=arrived.rejected,
            )
            with _kept(fresh) as fresh:
                ids = numbered(
                    fresh, batch_id * BATCH_IDS + 1, "dead_letter_id", "kafka_offset",
                    sliced=arrived.rejected > HOT_ROWS,
                ).select(ROW, "dead_letter_id")
                rows = _with_numbers(letters, ids, fresh.count()).select(
                    *DEAD_LETTER_SCHEMA.names, F.to_date("processed_at").alias(DAY.name)
                )
                rejected = tables.write_batch(rows, DEAD_LETTERS, batch_id)
            metrics.append(_metric_row(
                spark, batch_id, arrived.now, "dead_letter", 1, topic=arrived.topic,
                batch_size=arrived.rejected, persisted=0, dead_letters=rejected,
                errors=arrived.rejected, duration=time.monotonic() - started,
            ))
        if metrics:
            rows = reduce(DataFrame.unionByName, metrics).select(
                *METRIC_SCHEMA.names, F.to_date("metric_timestamp").alias(DAY.name)
            )
            tables.write_batch(rows, METRICS, batch_id)


def stream_to_tables(
    messages: DataFrame, root: str, checkpoint: str, *, available_now: bool = False,
    compact_every: int = COMPACT_EVERY,
):
    """Start the stream. ``available_now`` works off what is there and stops."""
    # Decoding is part of the streaming plan, so it is analysed once and not once per batch.
    writer = decode_events(messages).writeStream.foreachBatch(
        BatchWriter(StreamTables(root), compact_every)
    )
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_dedupe(events: DataFrame, delay: str, time_column: str = "ingested_at") -> DataFrame:
    """Drop repeats of an event id that arrive within ``delay``, with state bounded by it.

    The exact form, over the whole history, is ``insert_new`` against the stored table.
    """
    return events.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["event_id"])


def stream_minute_rates(events: DataFrame, delay: str, time_column: str = "ingested_at") -> DataFrame:
    """Events per minute of a stream; a minute is emitted once the watermark has passed it."""
    return (
        events.withWatermark(time_column, delay)
        .groupBy(F.window(time_column, "1 minute").alias("w"))
        .agg(F.count("*").alias("events"), F.max(source_time()).alias("latest_source"))
        .select(F.col("w.start").alias("minute"), "events", "latest_source")
    )
