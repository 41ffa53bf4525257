"""Staging and dimension projections of the static and realtime tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import event_time

ROUTE_COLUMNS = ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"]
TRIP_COLUMNS = ["route_id", "service_id", "trip_id", "trip_headsign", "direction_id", "shape_id"]
COORDINATE = "decimal(38,10)"


def stg_routes(routes: DataFrame) -> DataFrame:
    return routes.select(*ROUTE_COLUMNS)


def stg_stops(stops: DataFrame) -> DataFrame:
    return stops.select(
        "stop_id",
        "stop_code",
        "stop_name",
        F.col("stop_lat").cast(COORDINATE).alias("stop_latitude"),
        F.col("stop_lon").cast(COORDINATE).alias("stop_longitude"),
        "location_type",
    )


def stg_trips(trips: DataFrame) -> DataFrame:
    return trips.select(*TRIP_COLUMNS)


def stg_stop_times(stop_times: DataFrame) -> DataFrame:
    return stop_times.select(
        "trip_id",
        "arrival_time",
        "departure_time",
        "stop_id",
        F.col("stop_sequence").cast("int").alias("stop_sequence"),
    )


def stg_positions(positions: DataFrame) -> DataFrame:
    return positions.select(
        F.col("id").alias("observation_id"),
        "event_id",
        "ingested_at",
        "feed_timestamp",
        "vehicle_timestamp",
        event_time().alias("event_timestamp"),
        "entity_id",
        "vehicle_id",
        "vehicle_label",
        "trip_id",
        "route_id",
        "direction_id",
        "start_time",
        "start_date",
        "stop_id",
        F.col("current_stop_sequence").cast("int").alias("current_stop_sequence"),
        "current_status",
        "latitude",
        "longitude",
        "bearing",
        "speed",
        "occupancy_status",
        "source",
    )


def trip_stop_times(staged_stop_times: DataFrame, staged_trips: DataFrame) -> DataFrame:
    """Scheduled stops with the route of their trip."""
    return staged_stop_times.join(staged_trips.select("trip_id", "route_id"), "trip_id").select(
        "trip_id", "route_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"
    )


def dim_route(staged_routes: DataFrame) -> DataFrame:
    return staged_routes.select(*ROUTE_COLUMNS)


def dim_stop(staged_stops: DataFrame) -> DataFrame:
    return staged_stops.select(
        "stop_id", "stop_code", "stop_name", "stop_latitude", "stop_longitude", "location_type"
    )


def fct_stop_arrival(scheduled_stops: DataFrame) -> DataFrame:
    return scheduled_stops.withColumnsRenamed(
        {"arrival_time": "scheduled_arrival_time", "departure_time": "scheduled_departure_time"}
    )
