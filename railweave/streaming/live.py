"""Views that a stream keeps up to date: the fleet as last seen, and sliding rates."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from railweave.functions.gtfs_time import event_time
from railweave.operators.metrics import RATE_WINDOW_MINUTES, sliding_rates
from railweave.operators.serving import vehicle_key
from railweave.session import delete_folder, file_system, subfolders

# Executors need not have the package: the functions they run travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STATE = "at long, id long, row string"
_CHANGE = "vehicle_key string, at long, id long, row string, gone boolean"
# Rows travel through the state as text; their times keep microseconds.
_AS_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keeps a vehicle's newest row by event time and id, until the watermark passes it."""
    held = state.getOption
    if state.hasTimedOut:
        state.remove()
        yield pd.DataFrame([(*key, *held, True)], columns=["vehicle_key", "at", "id", "row", "gone"])
        return
    best = held
    for frame in frames:
        for row in zip(frame["at"].tolist(), frame["id"].tolist(), frame["row"].tolist()):
            # A repeated event changes nothing, and one that comes late is older than what is held.
            if best is None or row[:2] > tuple(best[:2]):
                best = row
    if best is not None and best is not held:
        state.update(tuple(best))
        # Gone as soon as the watermark, which trails the newest event by the age allowed, has passed its time.
        expires = max(best[0] // 1000 + 1, state.getCurrentWatermarkMs() + 1)
        state.setTimeoutTimestamp(expires)
        yield pd.DataFrame([(*key, *best, False)], columns=["vehicle_key", "at", "id", "row", "gone"])


def fleet_changes(positions: DataFrame, max_age: timedelta) -> DataFrame:
    """Changes of the fleet view: per batch a row for each vehicle that was seen anew, and for each that was not seen for
    ``max_age`` of event time. The state has a row per vehicle in view."""
    rows = positions.withColumn("event_timestamp", event_time()).withColumn("vehicle_key", vehicle_key())
    seen = rows.withWatermark("event_timestamp", f"{int(max_age.total_seconds())} seconds").select(
        "vehicle_key", "event_timestamp", F.unix_micros("event_timestamp").alias("at"), "id",
        F.to_json(F.struct(*positions.columns), _AS_TEXT).alias("row"),
    )
    return seen.filter("event_timestamp is not null").groupBy("vehicle_key").applyInPandasWithState(
        _newest, _CHANGE, _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )


class FleetWriter:
    """``foreachBatch`` function: each batch writes the whole view, a row per vehicle, to a folder of its own from the
    one before it. Run again after a failure it writes the same folder; readers take the last finished one."""

    def __init__(self, root: str):
        self.root = root

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession
        # A vehicle that was seen and left in the same batch has left.
        last = changes.groupBy("vehicle_key").agg(
            F.max_by(F.struct("at", "id", "row", "gone"), F.struct("gone", "at", "id")).alias("c")
        )
        last = last.select("vehicle_key", "c.*").persist()
        try:
            fleet = last.filter("not gone").drop("gone")
            done = [n for n in _finished(spark, self.root) if n < batch_id]
            if done:
                before = spark.read.schema(fleet.schema).parquet(_folder(self.root, done[-1]))
                fleet = before.join(last.select("vehicle_key"), "vehicle_key", "left_anti").unionByName(fleet)
            fleet.write.mode("overwrite").parquet(_folder(self.root, batch_id))
        finally:
            last.unpersist()
        # The view before the last stays for readers that have opened it.
        for old in done[:-1]:
            delete_folder(spark, _folder(self.root, old))


def _folder(root: str, batch_id: int) -> str:
    return f"{root}/batch={batch_id:012d}"


def _finished(spark: SparkSession, root: str) -> list[int]:
    system, make = file_system(spark, root)
    return [
        int(name.removeprefix("batch=")) for name in subfolders(spark, root)
        if name.startswith("batch=") and system.exists(make(f"{root}/{name}/_SUCCESS"))
    ]


def stream_fleet(
    positions: DataFrame, root: str, checkpoint: str, max_age: timedelta, *, available_now: bool = False
):
    """Start keeping the fleet view of a stream of positions below ``root``."""
    writer = fleet_changes(positions, max_age).writeStream.outputMode("update").foreachBatch(FleetWriter(root))
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_fleet(spark: SparkSession, root: str, schema: T.StructType, max_age: timedelta) -> DataFrame | None:
    """Newest position of every vehicle in view, with ``schema``, the columns of the stream; None before the first batch.
    Vehicles whose expiry waits for the next batch are left out by their age."""
    done = _finished(spark, root)
    if not done:
        return None
    kept = spark.read.schema("vehicle_key string, at long, id long, row string").parquet(_folder(root, done[-1]))
    newest = kept.agg(F.max("at")).scalar()
    fresh = kept.filter(F.col("at") >= newest - round(max_age / timedelta(microseconds=1)))
    return fresh.select(
        "vehicle_key", F.timestamp_micros("at").alias("event_timestamp"), F.from_json("row", schema, _AS_TEXT).alias("row")
    ).select("vehicle_key", "event_timestamp", "row.*")


def stream_sliding_rates(
    metrics: DataFrame, delay: str, minutes: int = RATE_WINDOW_MINUTES
) -> DataFrame:
    """Trailing rate for every minute of a stream of metric rows; a window is emitted once, when the watermark has passed its end.
    State holds the open windows, as many as ``minutes`` and the delay cover."""
    return sliding_rates(metrics.withWatermark("metric_timestamp", delay), minutes)
