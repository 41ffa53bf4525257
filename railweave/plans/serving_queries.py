"""Queries behind the fleet map, the route lists and the activity feed."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import event_time, iso_text
from railweave.functions.labels import (
    format_age,
    format_bytes,
    format_count,
    format_decimal,
    format_seconds,
    format_timestamp,
    friendly_status,
    friendly_value,
    route_label,
    route_marker_color,
)
from railweave.operators import metrics, serving
from railweave.plans.duckdb_views import (
    ROUTE_LABEL,
    STATUS_LABEL,
    informative,
    local_text,
    route_color,
)
from railweave.plans.registry import query
from railweave.sources.shaped import Tables

# The bundled events are minutes apart, so "current" spans half a day here.
MAX_AGE_SECONDS = 12 * 3600
ROUTE = "7"


def now_of(t: Tables) -> Column:
    """Newest ingestion time, which stands for the wall clock, as a scalar query."""
    return t.positions.agg(F.max("ingested_at").alias("now")).scalar()


def _oldest(t: Tables) -> Column:
    return now_of(t) - F.lit(timedelta(seconds=MAX_AGE_SECONDS))


def _vehicles(t: Tables, route_id: str | None = None) -> DataFrame:
    return serving.current_vehicles(t.positions, t.routes, t.trips, t.stops, _oldest(t), route_id)


query("bounded_recent", "select * from v_positions order by id desc limit 5000")(
    lambda t: serving.newest_by_id(t.positions, 5000)
)
query(
    "freshness_cutoff",
    "select * from v_recent, v_now where event_timestamp >= now_ts - interval 12 hours",
)(
    lambda t: serving.recent_observations(t.positions, _oldest(t)).withColumn(
        "now_ts", F.lit(now_of(t))
    )
)
query("latest_per_vehicle", "select * from v_latest")(
    lambda t: serving.latest_per_vehicle(
        serving.recent_observations(t.positions, _oldest(t))
    ).withColumn("now_ts", F.lit(now_of(t)))
)
query(
    "latest_per_vehicle_all",
    """select vehicle_key, id, event_timestamp from (
        select *, row_number() over (partition by vehicle_key order by event_timestamp desc, id desc) place
        from (select id, coalesce(nullif(vehicle_id, ''), nullif(entity_id, ''), cast(id as varchar)) vehicle_key,
            coalesce(vehicle_timestamp, feed_timestamp, ingested_at) event_timestamp from v_positions))
    where place = 1""",
)(
    lambda t: serving.latest_per_vehicle(
        t.positions.select("id", "vehicle_id", "entity_id", event_time().alias("event_timestamp"))
    ).select("vehicle_key", "id", "event_timestamp")
)
query("current_vehicles", "select * from v_vehicles")(_vehicles)
query("current_vehicles_on_route", f"select * from v_vehicles where route_id = '{ROUTE}'")(
    lambda t: _vehicles(t, ROUTE)
)
query("route_filter", f"select * from v_positions where route_id = '{ROUTE}'")(
    lambda t: serving.on_route(t.positions, ROUTE)
)
query(
    "nonblank_route",
    "select id, route_id from v_positions where route_id is not null and trim(route_id) <> ''",
)(lambda t: serving.with_nonblank_route(t.positions).select("id", "route_id"))

ROUTE_OPTIONS_SQL = """
select distinct p.route_id, route_short_name, route_long_name
from (select * from v_recent, v_now where event_timestamp >= now_ts - interval 12 hours) p
left join v_routes r on r.route_id = p.route_id
where p.route_id is not null and trim(p.route_id) <> ''
"""
query("route_options", ROUTE_OPTIONS_SQL)(
    lambda t: serving.route_options(t.positions, t.routes, _oldest(t))
)
query(
    "distinct_routes",
    """select distinct route_id from v_recent, v_now
    where event_timestamp >= now_ts - interval 12 hours and trim(coalesce(route_id, '')) <> ''""",
)(
    lambda t: serving.with_nonblank_route(serving.recent_observations(t.positions, _oldest(t)))
    .select("route_id").distinct()
)
query(
    "route_option_labels",
    f"select route_id, {ROUTE_LABEL} as label from ({ROUTE_OPTIONS_SQL})",
)(
    lambda t: serving.route_option_labels(
        serving.route_options(t.positions, t.routes, _oldest(t))
    )
)

RECENT_EVENTS_SQL = """
select coalesce(vehicle_timestamp, feed_timestamp, ingested_at) event_timestamp, p.vehicle_id,
    p.vehicle_label, p.entity_id, p.trip_id, p.route_id, route_short_name, route_long_name,
    p.stop_id, stop_name, p.current_status, p.latitude, p.longitude
from v_positions p left join v_routes r on r.route_id = p.route_id
left join v_stops s on s.stop_id = p.stop_id
{where} order by p.id desc limit 25
"""
query("recent_events", RECENT_EVENTS_SQL.format(where=""))(
    lambda t: serving.recent_events(t.positions, t.routes, t.stops)
)
query("recent_events_on_route", RECENT_EVENTS_SQL.format(where=f"where p.route_id = '{ROUTE}'"))(
    lambda t: serving.recent_events(t.positions, t.routes, t.stops, ROUTE)
)

ROUTE_SUMMARY_SQL = """
select route_short_name, route_long_name, count(distinct trip_id) trips
from v_routes r left join v_trips t on r.route_id = t.route_id
group by 1, 2
order by trips desc, route_short_name nulls last, route_long_name nulls last limit 25
"""
query("route_summary", ROUTE_SUMMARY_SQL)(lambda t: serving.route_summary(t.routes, t.trips))
query("top_routes", ROUTE_SUMMARY_SQL.replace("limit 25", "limit 5"))(
    lambda t: serving.route_summary(t.routes, t.trips, rows=5)
)
query(
    "static_summary",
    """select (select count(*) from v_routes) routes, (select count(*) from v_stops) stops,
        (select count(*) from v_trips) trips, (select count(*) from v_stop_times) stop_arrivals""",
)(
    lambda t: metrics.table_counts(
        {"routes": t.routes, "stops": t.stops, "trips": t.trips, "stop_arrivals": t.stop_times}
    )
)
query(
    "latest_event",
    "select coalesce(vehicle_timestamp, feed_timestamp, ingested_at) event_timestamp, ingested_at"
    " from v_positions order by id desc limit 1",
)(lambda t: serving.latest_event(t.positions))
query("latest_ingested", "select * from v_positions order by ingested_at desc, id desc limit 20")(
    lambda t: serving.latest_ingested(t.positions)
)

VEHICLE_TABLE_SQL = f"""
select {ROUTE_LABEL} "Route", {informative('trip_headsign')} "Destination",
    {informative('vehicle_label', 'vehicle_id', 'entity_id')} "Vehicle",
    {informative('trip_id')} "Trip", {informative('stop_name', 'stop_id')} "Current stop",
    {STATUS_LABEL} "Status", {local_text('event_timestamp')} "Last update",
    coalesce(cast(round(latitude, 5) as varchar), 'Unknown') "Latitude",
    coalesce(cast(round(longitude, 5) as varchar), 'Unknown') "Longitude"
from v_vehicles
"""
query("vehicle_table", VEHICLE_TABLE_SQL)(lambda t: serving.vehicle_table(_vehicles(t)))
query("vehicle_map", "select * from v_map")(lambda t: serving.vehicle_map(_vehicles(t)))
query(
    "map_positions",
    "select latitude, longitude from v_vehicles"
    " where latitude between -90 and 90 and longitude between -180 and 180",
)(lambda t: serving.map_positions(_vehicles(t)))
query(
    "valid_coordinates",
    "select id, latitude, longitude from v_positions"
    " where latitude between -90 and 90 and longitude between -180 and 180",
)(
    lambda t: t.positions.filter(serving.has_valid_coordinates()).select(
        "id", "latitude", "longitude"
    )
)
query(
    "route_legend",
    "select route, case min(marker_color) when '120,120,120,210' then '#787878' else '#ffc72c' end color,"
    " count(*) vehicles from v_map group by route"
    " order by vehicles desc, route nulls last limit 6",
)(lambda t: serving.route_legend(serving.vehicle_map(_vehicles(t))))
query(
    "map_omitted_count",
    "select count(*) - (select count(*) from v_map) omitted from v_vehicles",
)(lambda t: serving.map_omitted_count(_vehicles(t)))


# Labels over whole tables, beyond what the bounded fleet shows.


query(
    "vehicle_labels",
    f"select id, {informative('vehicle_label', 'vehicle_id', 'entity_id')} vehicle,"
    f" {STATUS_LABEL} status, {local_text('vehicle_timestamp')} updated from v_positions",
)(
    lambda t: t.positions.select(
        "id",
        friendly_value(F.col("vehicle_label"), F.col("vehicle_id"), F.col("entity_id")).alias("vehicle"),
        friendly_status(F.col("current_status")).alias("status"),
        format_timestamp(F.col("vehicle_timestamp")).alias("updated"),
    )
)
query("route_labels", f"select route_id, {ROUTE_LABEL} as label from v_routes")(
    lambda t: t.routes.select(
        "route_id",
        route_label(F.col("route_short_name"), F.col("route_long_name"), F.col("route_id")).alias("label"),
    )
)
query(
    "route_colors",
    f"select p_name, {route_color('p_name')} color from (select distinct p_name from part)",
)(
    lambda t: t.raw("part").select("p_name").distinct().select(
        "p_name", route_marker_color(F.col("p_name")).alias("color")
    )
)
query(
    "iso_times",
    "select id, strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') fine,"
    " strftime(ingested_at, '%Y-%m-%dT%H:%M:%S+00:00') whole from v_positions",
)(
    lambda t: t.positions.select(
        "id",
        # A zero fraction would be left out of the text; ids keep their own form below.
        F.when(F.unix_micros("ingested_at") % 1_000_000 != 0, iso_text(F.col("ingested_at")))
        .otherwise(F.concat(F.substring(iso_text(F.col("ingested_at")), 1, 19), F.lit(".000000+00:00")))
        .alias("fine"),
        iso_text(F.date_trunc("second", "ingested_at")).alias("whole"),
    )
)
query(
    "human_formats",
    """select id, case when id % 240 < 60 then printf('%.0f seconds', (id % 240)::double)
            else printf('%.1f minutes', (id % 240) / 60) end age,
        case when id * 4096 < 1024 then printf('%.1f B', id * 4096.0::double)
            when id * 4096 < 1048576 then printf('%.1f KiB', id * 4096 / 1024.0::double)
            when id * 4096 < 1073741824 then printf('%.1f MiB', id * 4096 / 1048576.0::double)
            else printf('%.1f GiB', id * 4096 / 1073741824.0::double) end size,
        format('{:,}', id) n, coalesce(format('{:,.2f}', speed) || ' s', 'Unavailable') speed_text,
        coalesce(printf('%.3fs', speed), 'n/a') seconds_text
    from v_positions""",
)(
    lambda t: t.positions.select(
        "id",
        format_age(F.col("id") % 240).alias("age"),
        format_bytes(F.col("id") * 4096).alias("size"),
        format_count(F.col("id")).alias("n"),
        format_decimal(F.col("speed"), " s").alias("speed_text"),
        format_seconds(F.col("speed")).alias("seconds_text"),
    )
)
