"""One trip with five stops and two observations, four stops apart."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from railweave.schemas import POSITION_SCHEMA

STOP_TIMES = "trip_id STRING, arrival_time STRING, departure_time STRING, stop_id STRING, stop_sequence STRING"


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=UTC)


def stop_times(spark):
    rows = [
        ("CI_TRIP", f"08:{minute:02d}:00", f"08:{minute:02d}:30", f"CI_STOP_{n}", str(n))
        for n, minute in enumerate(range(0, 25, 5), start=1)
    ]
    return spark.createDataFrame(rows, STOP_TIMES)


def position(id_, at, sequence, **values):
    row = {name: None for name in POSITION_SCHEMA.names}
    row.update(
        id=id_, event_id=f"event-{id_}", ingested_at=at + timedelta(seconds=2), feed_timestamp=at,
        vehicle_timestamp=at, entity_id="CI_ENTITY", vehicle_id="CI_VEHICLE", trip_id="CI_TRIP",
        route_id="CI_ROUTE", start_date="20260830", stop_id=f"CI_STOP_{sequence}",
        current_stop_sequence=sequence, current_status="STOPPED_AT", source="fixture",
    )
    row.update(values)
    return tuple(row[name] for name in POSITION_SCHEMA.names)


def positions(spark, rows=None):
    if rows is None:
        rows = [
            position(1, utc(2026, 8, 30, 12, 1, 0), 1),
            position(2, utc(2026, 8, 30, 12, 22, 0), 5),
        ]
    return spark.createDataFrame(rows, POSITION_SCHEMA)
