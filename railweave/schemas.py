"""Fixed schemas of the realtime and ledger tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "BINARY": T.BinaryType(),
}


def columns(kind: str, names: str, nullable: bool = True) -> list[T.StructField]:
    """Fields of one type; usable before a session exists, unlike a DDL string."""
    return [T.StructField(name, _TYPES[kind], nullable) for name in names.split()]


# A decoded event: a position before the table assigned its id.
EVENT_FIELDS = [
    *columns("STRING", "event_id"),
    *columns("TIMESTAMP", "ingested_at", nullable=False),
    *columns("TIMESTAMP", "feed_timestamp vehicle_timestamp"),
    *columns("STRING", "entity_id vehicle_id vehicle_label trip_id route_id"),
    *columns("INT", "direction_id"),
    *columns("STRING", "start_time start_date stop_id"),
    *columns("INT", "current_stop_sequence"),
    *columns("STRING", "current_status"),
    *columns("DOUBLE", "latitude longitude bearing speed"),
    *columns("STRING", "occupancy_status"),
    *columns("STRING", "source", nullable=False),
]

POSITION_SCHEMA = T.StructType([*columns("BIGINT", "id"), *EVENT_FIELDS])

DEAD_LETTER_SCHEMA = T.StructType(
    [
        *columns("BIGINT", "dead_letter_id"),
        *columns("STRING", "original_event_id topic"),
        *columns("INT", "partition"),
        *columns("BIGINT", "kafka_offset"),
        *columns("TIMESTAMP", "processed_at"),
        *columns("STRING", "error_type error_reason"),
        *columns("BINARY", "raw_payload"),
        *columns("STRING", "vehicle_id trip_id"),
    ]
)

METRIC_SCHEMA = T.StructType(
    [
        *columns("BIGINT", "metric_id"),
        *columns("TIMESTAMP", "metric_timestamp"),
        *columns("STRING", "metric_kind topic"),
        *columns(
            "INT",
            "batch_size events_received events_persisted duplicate_events dead_letter_events"
            " error_count retry_count failed_batch_count",
        ),
        *columns("DOUBLE", "processing_duration_seconds"),
        *columns("TIMESTAMP", "latest_source_event_timestamp latest_ingestion_timestamp"),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        *columns("BIGINT", "ingestion_id"),
        *columns("TIMESTAMP", "ingestion_timestamp"),
        *columns("STRING", "source file_name"),
        *columns("BIGINT", "record_count"),
        *columns("STRING", "checksum_sha256 raw_path"),
    ]
)

# One message of a realtime feed after wire decoding; field names follow the public
# GTFS-realtime specification, enum fields hold their numbers.
_VEHICLE = T.StructType(
    [
        T.StructField(
            "trip",
            T.StructType(
                [
                    *columns("STRING", "trip_id route_id"),
                    *columns("INT", "direction_id"),
                    *columns("STRING", "start_time start_date"),
                ]
            ),
        ),
        T.StructField("vehicle", T.StructType(columns("STRING", "id label"))),
        T.StructField(
            "position", T.StructType(columns("DOUBLE", "latitude longitude bearing speed"))
        ),
        *columns("STRING", "stop_id"),
        *columns("INT", "current_stop_sequence current_status"),
        *columns("BIGINT", "timestamp"),
        *columns("INT", "occupancy_status"),
    ]
)
FEED_SCHEMA = T.StructType(
    [
        *columns("TIMESTAMP", "ingested_at"),
        T.StructField("header", T.StructType(columns("BIGINT", "timestamp"))),
        T.StructField(
            "entity",
            T.ArrayType(
                T.StructType([*columns("STRING", "id"), T.StructField("vehicle", _VEHICLE)])
            ),
        ),
    ]
)

MESSAGE_SCHEMA = T.StructType(
    [
        *columns("STRING", "key"),
        *columns("BINARY", "value"),
        *columns("STRING", "topic"),
        *columns("INT", "partition"),
        *columns("BIGINT", "offset"),
        *columns("TIMESTAMP", "timestamp"),
    ]
)
