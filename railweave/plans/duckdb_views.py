"""The transit views of ``sources.shaped`` and the delay features, written for DuckDB.

They serve the checks that compare every Spark query with an independent SQL formulation. Times
are plain UTC timestamps.
"""

from __future__ import annotations

import re

from railweave.functions.labels import FAMILY_COLORS, KNOWN_ALPHA, ROUTE_PALETTE, UNKNOWN_COLOR

VIEWS: dict[str, str] = {}

VIEWS["v_routes"] = """
select cast(n_nationkey as varchar) route_id, 'agency-' || n_regionkey agency_id,
    case when n_nationkey % 5 = 0 then null else 'N' || n_nationkey end route_short_name,
    n_name route_long_name, cast(n_regionkey as varchar) route_type
from nation
"""

VIEWS["v_stops"] = """
select cast(p_partkey as varchar) stop_id, cast(p_partkey % 1000 as varchar) stop_code,
    p_name stop_name, '42.' || lpad(cast(p_size as varchar), 2, '0') stop_lat,
    '-71.' || lpad(cast(p_size as varchar), 2, '0') stop_lon,
    cast(p_size % 2 as varchar) location_type
from part
"""

VIEWS["v_trips"] = """
select cast(c_nationkey as varchar) route_id, o_orderstatus service_id,
    cast(o_orderkey as varchar) trip_id, o_orderpriority trip_headsign,
    cast(o_orderkey % 2 as varchar) direction_id, 'shape-' || (o_orderkey % 100) shape_id
from orders join customer on o_custkey = c_custkey
"""

VIEWS["v_stop_times"] = """
select cast(l_orderkey as varchar) trip_id,
    lpad(cast(secs // 3600 as varchar), 2, '0') || ':' || lpad(cast((secs // 60) % 60 as varchar), 2, '0')
        || ':' || lpad(cast(secs % 60 as varchar), 2, '0') arrival_time,
    lpad(cast((secs + 30) // 3600 as varchar), 2, '0') || ':'
        || lpad(cast(((secs + 30) // 60) % 60 as varchar), 2, '0')
        || ':' || lpad(cast((secs + 30) % 60 as varchar), 2, '0') departure_time,
    cast(stop as varchar) stop_id, cast(l_linenumber as varchar) stop_sequence
from (
    select l_orderkey, l_linenumber, min(l_partkey) stop,
        l_linenumber * 14400 + min(l_partkey) % 3600 secs
    from lineitem group by l_orderkey, l_linenumber)
"""

VIEWS["v_positions"] = """
select event_id id,
    case when event_id % 997 = 0 then null when event_id % 500 = 1 then 'evt-' || (event_id - 1)
        else 'evt-' || event_id end event_id,
    ts + to_seconds(2 + event_id % 5) ingested_at,
    case when event_id % 7 <> 0 then ts + interval 1 second end feed_timestamp,
    case when event_id % 11 <> 0 then ts end vehicle_timestamp,
    'entity-' || user_id entity_id,
    case when event_id % 23 = 0 then null when event_id % 29 = 0 then ''
        else cast(user_id as varchar) end vehicle_id,
    case when event_id % 4 = 0 then null when event_id % 9 = 0 then 'unavailable'
        else 'Bus ' || user_id end vehicle_label,
    case when event_id % 31 <> 0 then cast(user_id as varchar) end trip_id,
    case when event_id % 37 = 0 then null when event_id % 41 = 0 then '  '
        else cast(user_id % 25 as varchar) end route_id,
    event_id % 2 direction_id, '08:00:00' start_time, strftime(ts, '%Y%m%d') start_date,
    case when event_id % 13 <> 0 then cast(event_id % 1000 as varchar) end stop_id,
    cast(json_extract_string(props, '$.k') as bigint) % 10 + 1 current_stop_sequence,
    case event_type when 'click' then 'IN_TRANSIT_TO' when 'view' then 'STOPPED_AT'
        when 'purchase' then 'INCOMING_AT' when 'signup' then 'out_of_service' end current_status,
    case when event_id % 50 <> 0 then value / 4e0 - 10e0 end latitude,
    -71e0 - value / 10e0 longitude, cast(event_id % 360 as double) bearing,
    case when event_id % 3 <> 0 then value end speed,
    case event_id % 4 when 0 then 'MANY_SEATS_AVAILABLE' when 1 then 'FEW_SEATS_AVAILABLE'
        when 2 then 'FULL' end occupancy_status,
    'events' source
from events
"""

VIEWS["v_now"] = "select max(ingested_at) now_ts from v_positions"

VIEWS["v_messages"] = """
select 'evt-' || id as key,
    case id % 13
        when 1 then '\\xFF\\xFE{}'::blob
        when 2 then encode('{"event_id": ')
        when 3 then encode('[1, 2]')
        when 4 then encode('{"event_id": "evt-' || id || '", "trip_id": "t", "source": 5}')
        when 5 then encode(replace(js, '+00:00"', '"'))
        when 6 then encode(replace(js, '"ingested_at":"', '"ingested_at":"soon '))
        when 7 then null
        when 8 then encode('{"source":"earlier",' || js[2:])
        when 9 then encode('{"noise":NaN,' || js[2:])
        else encode(js) end as value,
    'vehicle_positions' topic, id % 3 as "partition", id // 3 as "offset", ingested_at
from (
    select id, ingested_at, cast(json_object(
        'event_id', 'evt-' || id,
        'ingested_at', strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f+00:00'),
        'feed_timestamp', strftime(feed_timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00'),
        'vehicle_timestamp', strftime(vehicle_timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00'),
        'entity_id', entity_id, 'vehicle_id', vehicle_id, 'trip_id', trip_id,
        'route_id', route_id, 'source', source) as varchar) js
    from v_positions)
"""

VIEWS["v_decoded"] = """
select key, topic, "partition", "offset", value, ingested_at,
    case when reason is null then null
        when reason in ('value is not valid UTF-8') then 'UnicodeDecodeError'
        when reason = 'value is not valid JSON' then 'JSONDecodeError'
        when reason = 'Kafka message value must decode to a JSON object' then 'TypeError'
        else 'ValueError' end error_type,
    reason error_reason, txt
from (
    select *,
        case when value is null then 'Kafka message has no value'
            when txt is null then 'value is not valid UTF-8'
            when not json_valid(txt) then 'value is not valid JSON'
            when json_type(txt) <> 'OBJECT' then 'Kafka message value must decode to a JSON object'
            when missing <> '' then 'Missing or invalid required event fields: ' || missing
            when try_cast(json_extract_string(txt, '$.ingested_at') as timestamptz) is null
                then 'ingested_at must be a valid ISO-8601 timestamp'
            when not regexp_matches(json_extract_string(txt, '$.ingested_at'), '(Z|[+-]\\d\\d:\\d\\d)$')
                then 'ingested_at must include a timezone' end reason
    from (
        select *, case when json_valid(txt) then concat_ws(', ',
            case when coalesce(json_type(txt, '$.event_id') <> 'VARCHAR', true)
                or trim(json_extract_string(txt, '$.event_id')) = '' then 'event_id' end,
            case when coalesce(json_type(txt, '$.vehicle_id') <> 'VARCHAR', true)
                or trim(json_extract_string(txt, '$.vehicle_id')) = '' then 'vehicle_id' end,
            case when coalesce(json_type(txt, '$.ingested_at') <> 'VARCHAR', true)
                or trim(json_extract_string(txt, '$.ingested_at')) = '' then 'ingested_at' end,
            case when coalesce(json_type(txt, '$.entity_id') <> 'VARCHAR', true)
                or trim(json_extract_string(txt, '$.entity_id')) = '' then 'entity_id' end,
            case when coalesce(json_type(txt, '$.source') <> 'VARCHAR', true)
                or trim(json_extract_string(txt, '$.source')) = '' then 'source' end) end missing
        from (select *, replace(try(decode(value)), '"noise":NaN', '"noise":null') txt from v_messages)))
"""

VIEWS["v_metrics"] = """
select metric_id, metric_timestamp,
    case when metric_id % 10 = 0 then 'dead_letter' else 'valid_batch' end metric_kind,
    'vehicle_positions' topic, n batch_size, n events_received,
    case when metric_id % 10 = 0 then 0 else n - repeated end events_persisted,
    case when metric_id % 10 = 0 then 0 else repeated end duplicate_events,
    case when metric_id % 10 = 0 then n else 0 end dead_letter_events,
    case when metric_id % 10 = 0 then n else 0 end error_count,
    metric_id % 3 retry_count, metric_id % 3 failed_batch_count,
    n * 0.001::double + (metric_id % 7) * 0.01::double processing_duration_seconds,
    case when metric_id % 10 <> 0 then src end latest_source_event_timestamp,
    case when metric_id % 10 <> 0 then metric_timestamp end latest_ingestion_timestamp
from (
    select id // 100 metric_id, max(ingested_at) metric_timestamp, count(*) n,
        count(*) filter (where id % 500 = 1) repeated,
        max(coalesce(vehicle_timestamp, feed_timestamp)) src
    from v_positions group by 1)
"""

VIEWS["v_dead_letters"] = """
select event_id dead_letter_id, 'evt-' || event_id original_event_id, 'vehicle_positions' topic,
    event_id % 3 as "partition", event_id // 3 kafka_offset, ts + interval 3 seconds processed_at,
    case event_id % 5 when 0 then 'JSONDecodeError' when 1 then 'UnicodeDecodeError'
        when 2 then 'TypeError' else 'ValueError' end error_type,
    case event_id % 5 when 0 then 'Expecting value' when 1 then 'invalid start byte'
        when 2 then 'Kafka message value must decode to a JSON object'
        when 3 then 'Missing or invalid required event fields: vehicle_id'
        else 'ingested_at must include a timezone' end error_reason,
    cast(user_id as varchar) vehicle_id, cast(user_id as varchar) trip_id
from events where event_type = 'error'
"""

VIEWS["v_watermarks"] = """
select 'vehicle_positions' topic, event_id % 3 as "partition", min(event_id // 3) low,
    max(event_id // 3) + 1 high
from events group by 2
"""

VIEWS["v_ledger"] = """
select id // 100 ingestion_id, max(ingested_at) ingestion_timestamp, max(source) source,
    'feed-' || (id // 100) || '.pb' file_name, count(*) record_count
from v_positions group by id // 100
"""

VIEWS["v_staged"] = """
select id observation_id, * exclude (id),
    coalesce(vehicle_timestamp, feed_timestamp, ingested_at) event_timestamp
from v_positions
"""

VIEWS["v_schedule"] = """
select trip_id, stop_id scheduled_stop_id, cast(stop_sequence as bigint) stop_sequence,
    arrival_time, departure_time, a scheduled_arrival_seconds, d scheduled_departure_seconds,
    d - a scheduled_dwell_time_sec,
    lead(a) over (partition by trip_id order by cast(stop_sequence as bigint)) - d
        scheduled_travel_time_to_next_stop_sec
from (
    select *,
        cast(split_part(arrival_time, ':', 1) as bigint) * 3600
            + cast(split_part(arrival_time, ':', 2) as bigint) * 60
            + cast(split_part(arrival_time, ':', 3) as bigint) a,
        cast(split_part(departure_time, ':', 1) as bigint) * 3600
            + cast(split_part(departure_time, ':', 2) as bigint) * 60
            + cast(split_part(departure_time, ':', 3) as bigint) d
    from v_stop_times)
"""

VIEWS["v_eligible"] = """
select *, hour(event_timestamp) as hour, dayofweek(event_timestamp) day_of_week,
    dayofweek(event_timestamp) in (0, 6) is_weekend
from v_staged
where vehicle_id is not null and trip_id is not null and route_id is not null
    and start_date is not null and current_stop_sequence is not null
    and event_timestamp is not null
"""

VIEWS["v_matched"] = """
select *, round((epoch_us(event_timestamp) - epoch_us(scheduled_arrival_timestamp)) / 1e6)::bigint
        current_delay_sec
from (
    select o.*, s.scheduled_stop_id, s.arrival_time scheduled_arrival_time,
        s.departure_time scheduled_departure_time, s.scheduled_arrival_seconds,
        s.scheduled_departure_seconds, s.scheduled_dwell_time_sec,
        s.scheduled_travel_time_to_next_stop_sec, o.stop_id = s.scheduled_stop_id
            observed_stop_matches_schedule,
        timezone('UTC', timezone('America/New_York', strptime(o.start_date, '%Y%m%d')))
            + to_seconds(s.scheduled_arrival_seconds) scheduled_arrival_timestamp
    from v_eligible o
    join v_schedule s on o.trip_id = s.trip_id and o.current_stop_sequence = s.stop_sequence)
"""

VIEWS["v_answers"] = """
select vehicle_id, trip_id, current_stop_sequence - 4 asked_at, event_timestamp at_ts,
    min(observation_id) answer_id, arg_min(current_delay_sec, observation_id) answer_delay
from v_matched group by all
"""

VIEWS["v_targets"] = """
select q.observation_id, a.answer_id target_observation_id, a.at_ts target_event_timestamp,
    a.answer_delay target_delay_4_stops_sec
from v_matched q
asof join v_answers a on q.vehicle_id = a.vehicle_id and q.trip_id = a.trip_id
    and q.current_stop_sequence = a.asked_at and q.event_timestamp < a.at_ts
"""

VIEWS["v_features"] = """
select m.observation_id, event_id, ingested_at, feed_timestamp, vehicle_timestamp,
    event_timestamp, entity_id, vehicle_id, vehicle_label, trip_id, route_id, direction_id,
    start_time, start_date, stop_id observed_stop_id, scheduled_stop_id,
    observed_stop_matches_schedule, current_stop_sequence, current_status, latitude, longitude,
    bearing, speed, occupancy_status, scheduled_arrival_time, scheduled_departure_time,
    scheduled_arrival_timestamp, scheduled_arrival_seconds, scheduled_departure_seconds,
    scheduled_dwell_time_sec, scheduled_travel_time_to_next_stop_sec, hour, day_of_week,
    is_weekend, current_delay_sec,
    lag(current_delay_sec) over (partition by vehicle_id, trip_id order by event_timestamp, m.observation_id)
        previous_observed_delay_sec,
    round(avg(current_delay_sec) over (partition by route_id order by event_timestamp, m.observation_id
        rows between unbounded preceding and 1 preceding), 6) historical_route_delay_sec,
    round(avg(current_delay_sec) over (partition by scheduled_stop_id order by event_timestamp, m.observation_id
        rows between unbounded preceding and 1 preceding), 6) historical_stop_delay_sec,
    target_observation_id, target_event_timestamp, target_delay_4_stops_sec,
    target_delay_4_stops_sec is not null has_target_delay_4_stops,
    'vehicle_trip_stop_sequence_plus_4' target_generation_method
from v_matched m left join v_targets t on m.observation_id = t.observation_id
"""

VIEWS["v_training"] = """
select * exclude (entity_id, event_timestamp, has_target_delay_4_stops),
    event_timestamp prediction_timestamp
from v_features where has_target_delay_4_stops
"""

# The same over the older half of the observations, as an earlier run saw them.
VIEWS["v_half_matched"] = """
select * from v_matched where observation_id <= (select max(id) // 2 from v_positions)
"""
for _name in ("answers", "targets", "features", "training"):
    VIEWS[f"v_half_{_name}"] = re.sub(r"\bv_(matched|answers|targets|features)\b", r"v_half_\1", VIEWS[f"v_{_name}"])

# Observations that arrived up to six hours late, and what each could know of its route and stop.
VIEWS["v_late"] = """
select * replace (ingested_at + to_hours(observation_id % 7) as ingested_at) from v_matched
"""
VIEWS["v_available"] = """
select observation_id, r.delay historical_route_delay_sec, s.delay historical_stop_delay_sec
from v_late m, lateral (
    select round(avg(current_delay_sec), 6) delay from v_late o
    where o.route_id = m.route_id and o.ingested_at <= m.ingested_at and (o.event_timestamp < m.event_timestamp
        or o.event_timestamp = m.event_timestamp and o.observation_id < m.observation_id)) r, lateral (
    select round(avg(current_delay_sec), 6) delay from v_late o
    where o.scheduled_stop_id = m.scheduled_stop_id and o.ingested_at <= m.ingested_at
        and (o.event_timestamp < m.event_timestamp
        or o.event_timestamp = m.event_timestamp and o.observation_id < m.observation_id)) s
"""

VIEWS["v_recent"] = """
select *, coalesce(vehicle_timestamp, feed_timestamp, ingested_at) event_timestamp
from v_positions
"""

VIEWS["v_latest"] = """
select * exclude (place) from (
    select *, row_number() over (partition by vehicle_key order by event_timestamp desc, id desc) place
    from (
        select *, coalesce(nullif(vehicle_id, ''), nullif(entity_id, ''), cast(id as varchar)) vehicle_key
        from v_recent, v_now where event_timestamp >= now_ts - interval 12 hours))
where place = 1
"""

VIEWS["v_vehicles"] = """
select l.event_timestamp, l.vehicle_id, l.vehicle_label, l.entity_id, l.trip_id, t.trip_headsign,
    l.route_id, r.route_short_name, r.route_long_name, l.stop_id, s.stop_name, l.current_status,
    l.ingested_at, l.latitude, l.longitude
from v_latest l left join v_routes r on r.route_id = l.route_id
left join v_trips t on t.trip_id = l.trip_id left join v_stops s on s.stop_id = l.stop_id
"""


def _informative(*columns: str) -> str:
    """SQL for the first informative text of ``columns``, else "Unknown"."""
    parts = [
        f"case when trim({c}) <> '' and lower(trim({c})) not in ('none', 'nan', 'unavailable')"
        f" then trim({c}) end"
        for c in columns
    ]
    return f"coalesce({', '.join(parts)}, 'Unknown')"


def _local_text(column: str) -> str:
    local = f"timezone('America/New_York', timezone('UTC', {column}))"
    zone = f"case when date_diff('minute', {column}, {local}) = -240 then 'EDT' else 'EST' end"
    return (
        f"case when {column} is null then 'Unknown' else"
        f" strftime({local}, '%b %d, %I:%M:%S %p ') || {zone} end"
    )


ROUTE_LABEL = f"""case when {_informative('route_short_name')} <> 'Unknown'
        and {_informative('route_long_name')} <> 'Unknown' then
            case when lower(trim(route_short_name)) = lower(trim(route_long_name))
                then trim(route_short_name)
                else trim(route_short_name) || ' - ' || trim(route_long_name) end
        else {_informative('route_short_name', 'route_long_name', 'route_id')} end"""

STATUS_LABEL = f"""case {_informative('current_status')} when 'Unknown' then 'Unknown'
        when 'IN_TRANSIT_TO' then 'In transit' when 'INCOMING_AT' then 'Approaching stop'
        when 'STOPPED_AT' then 'Stopped' else
        array_to_string(list_transform(string_split(replace(trim(current_status), '_', ' '), ' '),
            lambda w: upper(w[1]) || lower(w[2:])), ' ') end"""

def route_color(column: str) -> str:
    """SQL for the marker colour as "r,g,b,a"; the checksum is a bitwise CRC-32."""
    key = _informative(column)
    crc = (
        f"xor(list_reduce(list_transform(string_split({key}, ''), lambda ch: ascii(ch)::bigint),"
        " lambda crc, byte: list_reduce([xor(crc, byte)] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],"
        " lambda x, unused: xor(x >> 1, 3988292384::bigint * (x & 1))), 4294967295::bigint),"
        " 4294967295::bigint)"
    )
    def color(rgb: tuple[int, ...]) -> str:
        return "'" + ",".join(map(str, (*rgb, KNOWN_ALPHA))) + "'"

    palette = f"[{', '.join(map(color, ROUTE_PALETTE))}]"
    family = {name: color(rgb) for name, rgb in FAMILY_COLORS.items()}
    upper = f"upper({key})"
    return f"""case when {key} = 'Unknown' then '{",".join(map(str, UNKNOWN_COLOR))}'
        when {upper} like 'RED%' or {upper} like 'MATTAPAN%' then {family["RED"]}
        when {upper} like 'ORANGE%' then {family["ORANGE"]}
        when {upper} like 'BLUE%' then {family["BLUE"]}
        when {upper} like 'GREEN%' then {family["GREEN"]}
        when {upper} like 'SL%' then {family["SILVER"]}
        when {upper} like 'CR-%' then {family["COMMUTER_RAIL"]}
        when {upper} like '%FERRY%' or {upper} like 'BOAT%' then {family["FERRY"]}
        when regexp_matches({upper}, '^[0-9]') then {family["BUS"]}
        else ({palette})[{crc} % 8 + 1] end"""


VIEWS["v_map"] = f"""
select latitude, longitude, {ROUTE_LABEL} route, {_informative('trip_headsign')} destination,
    {_informative('vehicle_label', 'vehicle_id', 'entity_id')} vehicle,
    {_informative('vehicle_id')} vehicle_id, {_informative('vehicle_label')} vehicle_label,
    {STATUS_LABEL} status, {_local_text('event_timestamp')} last_update,
    {_local_text('ingested_at')} ingested_at, {route_color('route_id')} marker_color
from v_vehicles where latitude between -90 and 90 and longitude between -180 and 180
"""

informative, local_text = _informative, _local_text


def with_views(sql: str) -> str:
    """``sql`` behind the definitions of the views it needs, directly or through others."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"\bv_[a-z_]+\b", text):
            if name not in needed:
                add(VIEWS[name])
                needed.append(name)

    add(sql)
    if not needed:
        return sql
    # Inlined rather than materialised, so that only the columns in use are computed.
    heads = ",\n".join(f"{name} as not materialized ({VIEWS[name]})" for name in dict.fromkeys(needed))
    own = sql.strip().removeprefix("with ")
    return f"with {heads}\n{sql}" if own == sql.strip() else f"with {heads},\n{own}"
