"""Feed snapshots to one row per vehicle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.functions.identity import build_event_id
from railweave.schemas import EVENT_FIELDS

# Enum names of the public GTFS-realtime specification, by number from 0.
STOP_STATUS = ("INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO")
OCCUPANCY_STATUS = (
    "EMPTY", "MANY_SEATS_AVAILABLE", "FEW_SEATS_AVAILABLE", "STANDING_ROOM_ONLY",
    "CRUSHED_STANDING_ROOM_ONLY", "FULL", "NOT_ACCEPTING_PASSENGERS", "NO_DATA_AVAILABLE",
    "NOT_BOARDABLE",
)


def _filled(path: str) -> Column:
    return F.nullif(F.col(path), F.lit(""))


def _enum_name(path: str, names: tuple[str, ...]) -> Column:
    """Name of an enum number, NULL for numbers the specification does not know."""
    number = F.col(path)
    known = F.when(number >= 0, number)
    return F.get(F.array(*map(F.lit, names)), known)


def flatten_feed(feeds: DataFrame, source: str) -> DataFrame:
    """One event per entity that carries a vehicle; absent and empty values become NULL."""
    header_time = F.nullif(F.col("header.timestamp"), F.lit(0))
    entities = feeds.select(
        "ingested_at",
        F.timestamp_seconds(header_time).alias("feed_timestamp"),
        F.explode("entity").alias("entity"),
    ).filter("entity.vehicle is not null")
    v = "entity.vehicle"
    flat = entities.select(
        "ingested_at",
        "feed_timestamp",
        F.timestamp_seconds(f"{v}.timestamp").alias("vehicle_timestamp"),
        _filled("entity.id").alias("entity_id"),
        _filled(f"{v}.vehicle.id").alias("vehicle_id"),
        _filled(f"{v}.vehicle.label").alias("vehicle_label"),
        _filled(f"{v}.trip.trip_id").alias("trip_id"),
        _filled(f"{v}.trip.route_id").alias("route_id"),
        F.col(f"{v}.trip.direction_id").alias("direction_id"),
        _filled(f"{v}.trip.start_time").alias("start_time"),
        _filled(f"{v}.trip.start_date").alias("start_date"),
        _filled(f"{v}.stop_id").alias("stop_id"),
        F.col(f"{v}.current_stop_sequence").alias("current_stop_sequence"),
        _enum_name(f"{v}.current_status", STOP_STATUS).alias("current_status"),
        F.col(f"{v}.position.latitude").alias("latitude"),
        F.col(f"{v}.position.longitude").alias("longitude"),
        F.col(f"{v}.position.bearing").alias("bearing"),
        F.col(f"{v}.position.speed").alias("speed"),
        _enum_name(f"{v}.occupancy_status", OCCUPANCY_STATUS).alias("occupancy_status"),
        F.lit(source).alias("source"),
    )
    event_id = build_event_id(*map(F.col, ("source", "entity_id", "vehicle_id", "feed_timestamp")))
    return flat.withColumn("event_id", event_id).select(*(f.name for f in EVENT_FIELDS))
