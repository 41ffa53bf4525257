"""Views of the bundled star-schema tables in the shapes of the transit tables.

Every view reads its whole source table. ``events`` stands for vehicle observations, ``orders``
for trips, ``lineitem`` for scheduled stops, ``part`` for stops and ``nation`` for routes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railweave.schemas import EVENT_FIELDS

class Tables:
    """Lazily opened transit tables over one data folder."""

    def __init__(self, spark: SparkSession, data_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
        self.spark = spark
        self.data_dir = data_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.data_dir}/{name}.parquet")

    @property
    def routes(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "cast(n_nationkey as string) route_id",
            "concat('agency-', n_regionkey) agency_id",
            "case when n_nationkey % 5 = 0 then null else concat('N', n_nationkey) end route_short_name",
            "n_name route_long_name",
            "cast(n_regionkey as string) route_type",
        )

    @property
    def stops(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "cast(p_partkey as string) stop_id",
            "cast(p_partkey % 1000 as string) stop_code",
            "p_name stop_name",
            "concat('42.', lpad(cast(p_size as string), 2, '0')) stop_lat",
            "concat('-71.', lpad(cast(p_size as string), 2, '0')) stop_lon",
            "cast(p_size % 2 as string) location_type",
        )

    @property
    def trips(self) -> DataFrame:
        customers = self.raw("customer").select("c_custkey", "c_nationkey")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
            "cast(c_nationkey as string) route_id",
            "o_orderstatus service_id",
            "cast(o_orderkey as string) trip_id",
            "o_orderpriority trip_headsign",
            "cast(o_orderkey % 2 as string) direction_id",
            "concat('shape-', o_orderkey % 100) shape_id",
        )

    @property
    def stop_times(self) -> DataFrame:
        def clock(seconds: str) -> str:
            parts = (f"({seconds}) div 3600", f"(({seconds}) div 60) % 60", f"({seconds}) % 60")
            return "concat_ws(':', " + ", ".join(f"lpad(cast({p} as string), 2, '0')" for p in parts) + ")"

        arrival = "l_linenumber * 14400 + stop % 3600"
        return (
            self.raw("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.min("l_partkey").alias("stop"))
            .selectExpr(
                "cast(l_orderkey as string) trip_id",
                f"{clock(arrival)} arrival_time",
                f"{clock(arrival + ' + 30')} departure_time",
                "cast(stop as string) stop_id",
                "cast(l_linenumber as string) stop_sequence",
            )
        )

    @property
    def positions(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id id",
            "case when event_id % 997 = 0 then null"
            " when event_id % 500 = 1 then concat('evt-', event_id - 1)"
            " else concat('evt-', event_id) end event_id",
            "cast(ts as timestamp) + make_dt_interval(0, 0, 0, 2 + event_id % 5) ingested_at",
            "case when event_id % 7 <> 0 then cast(ts as timestamp) + interval 1 second end feed_timestamp",
            "case when event_id % 11 <> 0 then cast(ts as timestamp) end vehicle_timestamp",
            "concat('entity-', user_id) entity_id",
            "case when event_id % 23 = 0 then null when event_id % 29 = 0 then ''"
            " else cast(user_id as string) end vehicle_id",
            "case when event_id % 4 = 0 then null when event_id % 9 = 0 then 'unavailable'"
            " else concat('Bus ', user_id) end vehicle_label",
            "case when event_id % 31 <> 0 then cast(user_id as string) end trip_id",
            "case when event_id % 37 = 0 then null when event_id % 41 = 0 then '  '"
            " else cast(user_id % 25 as string) end route_id",
            "cast(event_id % 2 as int) direction_id",
            "'08:00:00' start_time",
            "date_format(ts, 'yyyyMMdd') start_date",
            "case when event_id % 13 <> 0 then cast(event_id % 1000 as string) end stop_id",
            "cast(get_json_object(props, '$.k') as int) % 10 + 1 current_stop_sequence",
            "case event_type when 'click' then 'IN_TRANSIT_TO' when 'view' then 'STOPPED_AT'"
            " when 'purchase' then 'INCOMING_AT' when 'signup' then 'out_of_service' end current_status",
            "case when event_id % 50 <> 0 then value / 4e0 - 10e0 end latitude",
            "-71e0 - value / 10e0 longitude",
            "cast(event_id % 360 as double) bearing",
            "case when event_id % 3 <> 0 then value end speed",
            "case event_id % 4 when 0 then 'MANY_SEATS_AVAILABLE' when 1 then 'FEW_SEATS_AVAILABLE'"
            " when 2 then 'FULL' end occupancy_status",
            "'events' source",
        )

    @property
    def messages(self) -> DataFrame:
        """Stream messages: positions as JSON bytes, some broken in each way that is rejected."""
        fields = [
            F.concat(F.lit("evt-"), F.col("id")).alias("event_id"),
            *(F.col(field.name) for field in EVENT_FIELDS if field.name != "event_id"),
        ]
        options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"}
        return (
            self.positions.withColumn("json", F.to_json(F.struct(*fields), options))
            .selectExpr(
                "concat('evt-', id) key",
                """case id % 13
                     when 1 then unhex('FFFE7B7D')
                     when 2 then cast('{"event_id": ' as binary)
                     when 3 then cast('[1, 2]' as binary)
                     when 4 then cast(concat('{"event_id": "evt-', id, '", "trip_id": "t", "source": 5}') as binary)
                     when 5 then cast(replace(json, '+00:00"', '"') as binary)
                     when 6 then cast(replace(json, '"ingested_at":"', '"ingested_at":"soon ') as binary)
                     when 7 then null
                     when 8 then cast(concat('{"source":"earlier",', substr(json, 2)) as binary)
                     when 9 then cast(concat('{"noise":NaN,', substr(json, 2)) as binary)
                     else cast(json as binary) end value""",
                "'vehicle_positions' topic",
                "cast(id % 3 as int) partition",
                "id div 3 offset",
                "ingested_at timestamp",
            )
        )

    @property
    def metrics(self) -> DataFrame:
        repeated = F.count_if(F.col("id") % 500 == 1)
        size = F.count("*")
        dead = F.col("metric_id") % 10 == 0
        return (
            self.positions.groupBy(F.expr("id div 100").alias("metric_id"))
            .agg(
                F.max("ingested_at").alias("metric_timestamp"),
                size.alias("size"),
                repeated.alias("repeated"),
                F.max(F.coalesce("vehicle_timestamp", "feed_timestamp")).alias("source_time"),
                F.max("ingested_at").alias("latest_ingestion_timestamp"),
            )
            .select(
                "metric_id",
                "metric_timestamp",
                F.when(dead, "dead_letter").otherwise("valid_batch").alias("metric_kind"),
                F.lit("vehicle_positions").alias("topic"),
                F.col("size").cast("int").alias("batch_size"),
                F.col("size").cast("int").alias("events_received"),
                F.when(dead, 0).otherwise(F.col("size") - F.col("repeated")).cast("int").alias("events_persisted"),
                F.when(dead, 0).otherwise(F.col("repeated")).cast("int").alias("duplicate_events"),
                F.when(dead, F.col("size")).otherwise(0).cast("int").alias("dead_letter_events"),
                F.when(dead, F.col("size")).otherwise(0).cast("int").alias("error_count"),
                (F.col("metric_id") % 3).cast("int").alias("retry_count"),
                (F.col("metric_id") % 3).cast("int").alias("failed_batch_count"),
                (F.col("size") * F.lit(0.001) + (F.col("metric_id") % 7) * F.lit(0.01)).alias("processing_duration_seconds"),
                F.when(~dead, F.col("source_time")).alias("latest_source_event_timestamp"),
                F.when(~dead, F.col("latest_ingestion_timestamp")).alias("latest_ingestion_timestamp"),
            )
        )

    @property
    def dead_letters(self) -> DataFrame:
        return (
            self.raw("events")
            .filter("event_type = 'error'")
            .selectExpr(
                "event_id dead_letter_id",
                "concat('evt-', event_id) original_event_id",
                "'vehicle_positions' topic",
                "cast(event_id % 3 as int) partition",
                "event_id div 3 kafka_offset",
                "cast(ts as timestamp) + interval 3 seconds processed_at",
                "case event_id % 5 when 0 then 'JSONDecodeError' when 1 then 'UnicodeDecodeError'"
                " when 2 then 'TypeError' else 'ValueError' end error_type",
                "case event_id % 5 when 0 then 'Expecting value' when 1 then 'invalid start byte'"
                " when 2 then 'Kafka message value must decode to a JSON object'"
                " when 3 then 'Missing or invalid required event fields: vehicle_id'"
                " else 'ingested_at must include a timezone' end error_reason",
                "cast(props as binary) raw_payload",
                "cast(user_id as string) vehicle_id",
                "cast(user_id as string) trip_id",
            )
        )

    @property
    def committed_offsets(self) -> DataFrame:
        """What a consumer had committed: unknown for one partition, behind or beyond for others."""
        return self.watermark_offsets.selectExpr(
            "topic", "partition",
            "case partition when 0 then null when 1 then high - 5 else high + 5 end committed",
        )

    @property
    def watermark_offsets(self) -> DataFrame:
        return (
            self.raw("events")
            .groupBy((F.col("event_id") % 3).cast("int").alias("partition"))
            .agg(F.expr("min(event_id div 3)").alias("low"), F.expr("max(event_id div 3) + 1").alias("high"))
            .selectExpr("'vehicle_positions' topic", "partition", "low", "high")
        )

    @property
    def ledger(self) -> DataFrame:
        """One ledger row per stored batch of events."""
        return self.positions.groupBy(F.expr("id div 100").alias("ingestion_id")).agg(
            F.max("ingested_at").alias("ingestion_timestamp"),
            F.max("source").alias("source"),
            F.concat(F.lit("feed-"), F.expr("id div 100"), F.lit(".pb")).alias("file_name"),
            F.count("*").alias("record_count"),
        )

    @property
    def feeds(self) -> DataFrame:
        """Feed snapshots rebuilt from events: one message per 100 observations.

        A snapshot carries one header time for all its entities, as a real feed does.
        """
        status = "case event_type when 'purchase' then 0 when 'view' then 1 when 'click' then 2 when 'signup' then 9 end"
        vehicle = f"""
            case when event_id % 17 <> 0 then named_struct(
                'trip', case when event_id % 31 <> 0 then named_struct(
                    'trip_id', cast(user_id as string),
                    'route_id', case when event_id % 37 = 0 then '' else cast(user_id % 25 as string) end,
                    'direction_id', cast(event_id % 2 as int),
                    'start_time', '', 'start_date', date_format(ts, 'yyyyMMdd')) end,
                'vehicle', case when event_id % 23 <> 0 then named_struct(
                    'id', case when event_id % 29 = 0 then '' else cast(user_id as string) end,
                    'label', concat('Bus ', user_id)) end,
                'position', case when event_id % 50 <> 0 then named_struct(
                    'latitude', value / 4e0 - 10e0, 'longitude', -71e0 - value / 10e0,
                    'bearing', cast(event_id % 360 as double),
                    'speed', case when event_id % 3 <> 0 then value end) end,
                'stop_id', case when event_id % 13 = 0 then '' else cast(event_id % 1000 as string) end,
                'current_stop_sequence', cast(get_json_object(props, '$.k') as int) % 10 + 1,
                'current_status', {status},
                'timestamp', case when event_id % 11 <> 0 then unix_seconds(cast(ts as timestamp)) end,
                'occupancy_status', cast(event_id % 11 as int)) end
        """
        entities = self.raw("events").selectExpr(
            "event_id div 100 snapshot",
            "cast(ts as timestamp) ts",
            f"struct(concat('entity-', event_id) as id, {vehicle} as vehicle) entity",
        )
        header = F.when(F.col("snapshot") % 9 == 0, F.lit(0)).otherwise(F.unix_seconds("last"))
        return (
            entities.groupBy("snapshot")
            .agg(F.max("ts").alias("last"), F.collect_list("entity").alias("entity"))
            .select(
                (F.col("last") + F.expr("interval 2 seconds")).alias("ingested_at"),
                F.struct(header.cast(T.LongType()).alias("timestamp")).alias("header"),
                "entity",
            )
        )
