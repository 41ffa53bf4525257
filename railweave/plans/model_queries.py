"""Queries over the warehouse models: staging, features, training mart and their checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import (
    day_of_week,
    delay_seconds,
    gtfs_seconds,
    is_weekend,
    service_timestamp,
)
from railweave.operators import features as feat
from railweave.operators import incremental, profile, quality, staging
from railweave.operators.availability import available_delay
from railweave.operators.scan import Measure, exclusive_scan
from railweave.plans.delay_training import build_features
from railweave.plans.registry import query
from railweave.session import materialize, shared_dir
from railweave.sinks.bucketed import append_bucketed, read_bucketed
from railweave.sources.shaped import Tables

# Small enough that the sliced form of the scans, down to hot slices, runs on the bundled tables.
SLICED = 40
# Rows of the larger table in a bucket.
BUCKET_ROWS = 500_000


def _staged(t: Tables) -> DataFrame:
    return staging.stg_positions(t.positions)


def _schedule(t: Tables) -> DataFrame:
    return staging.stg_stop_times(t.stop_times)


def _current(t: Tables) -> DataFrame:
    return feat.current_features(_staged(t), _schedule(t))


def _features(t: Tables) -> DataFrame:
    return build_features(t.positions, t.stop_times)


def _training(t: Tables) -> DataFrame:
    return feat.training_projection(_features(t)).drop("training_row_created_at")


def _written_features(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Training mart and features as tables, for checks that read both several times."""
    features = materialize(_features(t), "features")
    return feat.training_projection(features).drop("training_row_created_at"), features


def _sliced_scan(t: Tables, scan, name: str) -> DataFrame:
    current = _current(t)
    return current.select("row_id", "observation_id").join(
        scan(current), "row_id"
    ).select("observation_id", name)


query("stg_routes", "select * from v_routes")(lambda t: staging.stg_routes(t.routes))
query("stg_trips", "select * from v_trips")(lambda t: staging.stg_trips(t.trips))
query("dim_route", "select * from v_routes")(
    lambda t: staging.dim_route(staging.stg_routes(t.routes))
)

STOPS_SQL = """
select stop_id, stop_code, stop_name, cast(stop_lat as double) stop_latitude,
    cast(stop_lon as double) stop_longitude, location_type
from v_stops
"""
query("stg_stops", STOPS_SQL)(lambda t: staging.stg_stops(t.stops))
query("dim_stop", STOPS_SQL)(lambda t: staging.dim_stop(staging.stg_stops(t.stops)))

query(
    "stg_stop_times",
    "select trip_id, arrival_time, departure_time, stop_id,"
    " cast(stop_sequence as bigint) stop_sequence from v_stop_times",
)(_schedule)

query("stg_positions", "select * from v_staged")(_staged)


def _scheduled_stops(t: Tables) -> DataFrame:
    return staging.trip_stop_times(_schedule(t), staging.stg_trips(t.trips))


query(
    "trip_stop_times",
    "select st.trip_id, route_id, stop_id, cast(stop_sequence as bigint) stop_sequence,"
    " arrival_time, departure_time from v_stop_times st join v_trips tr on st.trip_id = tr.trip_id",
)(_scheduled_stops)

query(
    "fct_stop_arrival",
    "select st.trip_id, route_id, stop_id, cast(stop_sequence as bigint) stop_sequence,"
    " arrival_time scheduled_arrival_time, departure_time scheduled_departure_time"
    " from v_stop_times st join v_trips tr on st.trip_id = tr.trip_id",
)(lambda t: staging.fct_stop_arrival(_scheduled_stops(t)))


@query(
    "gtfs_clock",
    """select trip_id, stop_sequence, scheduled_arrival_seconds arrival_seconds,
        scheduled_departure_seconds departure_seconds from v_schedule""",
)
def gtfs_clock(t: Tables) -> DataFrame:
    return _schedule(t).select(
        "trip_id",
        "stop_sequence",
        gtfs_seconds(F.col("arrival_time")).alias("arrival_seconds"),
        gtfs_seconds(F.col("departure_time")).alias("departure_seconds"),
    )


@query(
    "service_days",
    """select id, timezone('UTC', timezone('America/New_York', make_timestamp(
            cast(start_date[1:4] as bigint), cast(start_date[5:6] as bigint),
            cast(start_date[7:8] as bigint), 0, 0, 0))) + to_seconds(id % 110000) due,
        round(epoch_us(ingested_at - (timezone('UTC', timezone('America/New_York',
            strptime(start_date, '%Y%m%d'))) + to_seconds(id % 110000))) / 1e6)::bigint late
    from v_positions""",
)
def service_days(t: Tables) -> DataFrame:
    due = service_timestamp(F.col("start_date"), F.col("id") % 110_000)
    return t.positions.select("id", "ingested_at", due.alias("due")).select(
        "id", "due", delay_seconds(F.col("ingested_at"), F.col("due")).alias("late")
    )


@query(
    "calendar_features",
    """select observation_id, hour(event_timestamp) as hour, dayofweek(event_timestamp) day_of_week,
        dayofweek(event_timestamp) in (0, 6) is_weekend from v_staged""",
)
def calendar_features(t: Tables) -> DataFrame:
    ts = F.col("event_timestamp")
    return _staged(t).select(
        "observation_id",
        F.hour(ts).alias("hour"),
        day_of_week(ts).alias("day_of_week"),
        is_weekend(ts).alias("is_weekend"),
    )


query("schedule_features", "select * from v_schedule")(lambda t: feat.schedule_features(_schedule(t)))
query("schedule_features_sliced", "select * from v_schedule")(
    lambda t: feat.schedule_features(_schedule(t), hot_rows=2)
)
query("eligible_observations", "select * from v_eligible")(
    lambda t: feat.eligible_observations(_staged(t))
)


@query("observations_with_schedule", "select * from v_matched")
def observations_with_schedule(t: Tables) -> DataFrame:
    return feat.observations_with_schedule(
        feat.eligible_observations(_staged(t)), feat.schedule_features(_schedule(t))
    )


@query("observations_with_bucketed_schedule", "select * from v_matched")
def observations_with_bucketed_schedule(t: Tables) -> DataFrame:
    """The same from tables in buckets of (trip, sequence): observations arrive in two parts, nothing is shuffled for the join."""
    sides = []
    rows = max(t.raw("lineitem").count(), t.raw("events").count())
    buckets = max(8, -(-rows // BUCKET_ROWS))
    eligible = feat.eligible_observations(_staged(t))
    halves = [eligible.filter(F.col("observation_id") % 2 == i) for i in (0, 1)]
    for parts, sequence in ((halves, "current_stop_sequence"), ([feat.schedule_features(_schedule(t))], "stop_sequence")):
        path = f"{shared_dir(t.spark)}/railweave/bucketed-{uuid.uuid4().hex}"
        for part in parts:
            append_bucketed(part, path, ["trip_id", sequence], buckets=buckets)
        sides.append(read_bucketed(t.spark, path, parts[0].schema, ["trip_id", sequence], buckets=buckets))
    return feat.observations_with_schedule(*sides)


# The four scans, forced into slices so that the large-data form is what the check sees.
query("previous_delay", "select observation_id, previous_observed_delay_sec from v_features")(
    lambda t: _sliced_scan(
        t, lambda c: feat.previous_delay(c, hot_rows=3), "previous_observed_delay_sec"
    )
)
query("historical_route_delay", "select observation_id, historical_route_delay_sec from v_features")(
    lambda t: _sliced_scan(
        t,
        lambda c: feat.historical_delay(
            c, "route_id", "historical_route_delay_sec", hot_rows=SLICED
        ),
        "historical_route_delay_sec",
    )
)
query("historical_stop_delay", "select observation_id, historical_stop_delay_sec from v_features")(
    lambda t: _sliced_scan(
        t,
        lambda c: feat.historical_delay(
            c, "scheduled_stop_id", "historical_stop_delay_sec", hot_rows=2
        ),
        "historical_stop_delay_sec",
    )
)


def _late(t: Tables) -> DataFrame:
    """Matched observations of which some arrived hours after their event."""
    hours = F.make_dt_interval(hours=F.col("observation_id") % 7)
    return _current(t).withColumn("ingested_at", F.col("ingested_at") + hours)


@query("available_route_delay", "select observation_id, historical_route_delay_sec from v_available")
def available_route_delay(t: Tables) -> DataFrame:
    """History that had arrived, with every ordered scan cut into slices."""
    late = _late(t)
    found = available_delay(late, "route_id", "historical_route_delay_sec", hot_rows=SLICED)
    return late.select("row_id", "observation_id").join(found, "row_id", "left").drop("row_id")


@query("delay_features_available", "select * from v_available")
def delay_features_available(t: Tables) -> DataFrame:
    return feat.delay_features(_late(t), availability="ingested_at").select(
        "observation_id", "historical_route_delay_sec", "historical_stop_delay_sec"
    )


@query("first_future_target", "select * from v_targets")
def first_future_target(t: Tables) -> DataFrame:
    current = _current(t)
    found = feat.first_future_target(current, hot_rows=2)
    return current.select("row_id", "observation_id").join(found, "row_id").drop("row_id")


@query(
    "future_candidates",
    """select q.observation_id, count(*) candidates from v_matched q
    join v_matched a on q.vehicle_id = a.vehicle_id and q.trip_id = a.trip_id
        and a.current_stop_sequence = q.current_stop_sequence + 4
        and a.event_timestamp > q.event_timestamp
    group by q.observation_id""",
)
def future_candidates(t: Tables) -> DataFrame:
    return feat.future_candidate_counts(_current(t))


@query(
    "features_left_targets",
    "select observation_id, target_observation_id, has_target_delay_4_stops from v_features",
)
def features_left_targets(t: Tables) -> DataFrame:
    return _features(t).select(
        "observation_id", "target_observation_id", "has_target_delay_4_stops"
    )


query("delay_features", "select * from v_features")(_features)
query(
    "delay_features_sliced", "select * from v_features"
)(lambda t: build_features(t.positions, t.stop_times, hot_rows=SLICED))
query("has_target", "select * from v_features where has_target_delay_4_stops")(
    lambda t: _features(t).filter("has_target_delay_4_stops")
)
query("training_projection", "select * from v_training")(_training)
query("ml_delay_training", "select * from v_training")(_training)


@query(
    "training_profile",
    """select 'training_rows' metric, cast(count(*) as varchar) "value" from v_training
    union all select 'distinct_vehicles', cast(count(distinct vehicle_id) as varchar) from v_training
    union all select 'distinct_trips', cast(count(distinct trip_id) as varchar) from v_training
    union all select 'routes', cast(count(distinct route_id) as varchar) from v_training
    union all select 'time_coverage', strftime(min(prediction_timestamp), '%Y-%m-%d %H:%M:%S')
        || ' to ' || strftime(max(prediction_timestamp), '%Y-%m-%d %H:%M:%S') from v_training
    union all select 'eligible_feature_rows', cast(count(*) as varchar) from v_features
    union all select 'valid_4_stop_target_pct', printf('%.2f',
        round(100.0 * avg(has_target_delay_4_stops::int), 2)) from v_features
    union all select 'target_delay_min_p50_avg_p95_max', concat_ws(', ',
        min(target_delay_4_stops_sec)::varchar,
        round_even(quantile_cont(target_delay_4_stops_sec::double, 0.5), 0)::bigint::varchar,
        printf('%.2f', round(avg(target_delay_4_stops_sec), 2)),
        round_even(quantile_cont(target_delay_4_stops_sec::double, 0.95), 0)::bigint::varchar,
        max(target_delay_4_stops_sec)::varchar) from v_training""",
)
def training_profile(t: Tables) -> DataFrame:
    training, features = _written_features(t)
    report = profile.training_profile(
        training.withColumn("prediction_timestamp", F.date_trunc("second", "prediction_timestamp")),
        features,
    )
    return report


@query(
    "null_percentages",
    " union all ".join(
        f"select '{name}' feature, round(100.0 * avg(({name} is null)::int), 2) missing_pct"
        " from v_training"
        for name in profile.PROFILED_FEATURES
    ),
)
def null_percentages(t: Tables) -> DataFrame:
    return profile.null_percentages(_written_features(t)[0])


# Data quality


STAGING_NOT_NULL = {
    "positions": ["observation_id", "event_timestamp", "vehicle_id", "trip_id", "route_id"],
    "stop_times": ["trip_id", "stop_id"],
    "routes": ["route_id", "route_type", "route_short_name"],
}


def _not_null_sql(table: str, view: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select 'not_null_{table}_{c}' as \"check\","
        f" count(*) filter (where {c} is null) violations from {view}"
        for c in columns
    )


@query(
    "not_null_violations",
    " union all ".join(
        _not_null_sql(table, view, STAGING_NOT_NULL[table])
        for table, view in (
            ("positions", "v_staged"), ("stop_times", "v_stop_times"), ("routes", "v_routes"),
        )
    ),
)
def not_null_violations(t: Tables) -> DataFrame:
    tables = {"positions": _staged(t), "stop_times": _schedule(t), "routes": t.routes}
    reports = [
        quality.not_null_report(name, df, STAGING_NOT_NULL[name]) for name, df in tables.items()
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


query(
    "unique_violations",
    'select event_id as "value", count(*) copies from v_staged where event_id is not null'
    " group by 1 having count(*) > 1",
)(lambda t: quality.unique_violations(_staged(t), "event_id"))
query(
    "duplicate_event_ids",
    "select event_id from v_staged where event_id is not null group by 1 having count(*) > 1",
)(lambda t: quality.duplicate_event_ids(_staged(t)))
query(
    "duplicate_schedule_rows",
    "select l_orderkey, l_linenumber::bigint l_linenumber, count(*) copies from lineitem group by 1, 2 having count(*) > 1",
)(
    lambda t: quality.unique_violations(
        t.raw("lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("key")), "key"
    ).select("value.l_orderkey", "value.l_linenumber", "copies")
)
query(
    "relationship_violations",
    """select route_id as "value", count(*) child_rows from v_staged where route_id is not null
        and route_id not in (select route_id from v_routes) group by 1""",
)(lambda t: quality.relationship_violations(_staged(t), "route_id", t.routes, "route_id"))


@query(
    "missing_in_staging",
    """select id observation_id from v_positions p where not exists (
        select 1 from v_eligible e where e.observation_id = p.id)""",
)
def missing_in_staging(t: Tables) -> DataFrame:
    return quality.missing_in_staging(t.positions, feat.eligible_observations(_staged(t)))


@query(
    "null_safe_mismatch",
    """select observation_id from v_staged
    where feed_timestamp is distinct from coalesce(vehicle_timestamp, feed_timestamp, ingested_at)""",
)
def null_safe_mismatch(t: Tables) -> DataFrame:
    """The precedence check applied to a table that took the feed's clock as event time."""
    wrong = _staged(t).withColumn("event_timestamp", F.col("feed_timestamp"))
    return quality.event_time_mismatch(wrong)


query(
    "delay_bounds",
    """select * from v_training where current_delay_sec not between -86400 and 86400
        or target_delay_4_stops_sec not between -86400 and 86400""",
)(lambda t: quality.unreasonable_delays(_training(t)))
query(
    "target_after_prediction",
    """select * replace (prediction_timestamp + interval 6 hours as prediction_timestamp) from v_training
    where target_event_timestamp <= prediction_timestamp + interval 6 hours""",
)(
    # Six hours late, so that the result is not empty.
    lambda t: quality.target_not_after_prediction(
        _training(t).withColumn("prediction_timestamp", F.expr("prediction_timestamp + interval 6 hours"))
    )
)


@query(
    "label_sequence_check",
    """select t.observation_id, t.current_stop_sequence, f.current_stop_sequence label_sequence
    from v_training t join v_features f on t.target_observation_id = f.observation_id
    where f.current_stop_sequence <> t.current_stop_sequence + 3""",
)
def label_sequence_check(t: Tables) -> DataFrame:
    """Checked against a wrong distance as well, so that the result is not empty."""
    training, features = _written_features(t)
    return quality.label_sequence_mismatch(training, features, stops_ahead=3).select(
        "observation_id", "current_stop_sequence", "label_sequence"
    )


TRAINING_NOT_NULL = [
    "observation_id", "prediction_timestamp", "vehicle_id", "trip_id", "route_id",
    "scheduled_stop_id", "current_stop_sequence", "current_delay_sec", "target_observation_id",
    "target_event_timestamp", "target_delay_4_stops_sec",
]


@query(
    "dq_report",
    """select 'unique_event_id' as "check", count(*) violations from (
        select 1 from v_staged where event_id is not null group by event_id having count(*) > 1)
    union all select 'unique_observation_id', count(*) from (
        select 1 from v_features group by observation_id having count(*) > 1)
    union all select 'training_trip_known', count(*) from (
        select distinct trip_id from v_training where trip_id not in (select trip_id from v_trips))
    union all select 'training_route_known', count(*) from (
        select distinct route_id from v_training where route_id not in (select route_id from v_routes))
    union all select 'training_stop_known', count(*) from (
        select distinct scheduled_stop_id from v_training
        where scheduled_stop_id not in (select stop_id from v_stops))
    union all select 'reasonable_delays', count(*) from v_training
        where current_delay_sec not between -86400 and 86400
        or target_delay_4_stops_sec not between -86400 and 86400
    union all select 'target_after_prediction', count(*) from v_training
        where target_event_timestamp <= prediction_timestamp
    union all select 'label_sequence', count(*) from v_training t
        join v_features f on t.target_observation_id = f.observation_id
        where f.current_stop_sequence <> t.current_stop_sequence + 4
    union all select 'event_time_precedence', count(*) from v_staged
        where event_timestamp is distinct from coalesce(vehicle_timestamp, feed_timestamp, ingested_at)
    union all select 'staged_completely', count(*) from v_positions
        where id not in (select observation_id from v_staged)
    union all """ + _not_null_sql("training", "v_training", TRAINING_NOT_NULL),
)
def dq_report(t: Tables) -> DataFrame:
    training, features = _written_features(t)
    staged = _staged(t)

    def known(column: str, parent: DataFrame, parent_column: str) -> DataFrame:
        return quality.relationship_violations(training, column, parent, parent_column)

    report = quality.dq_report(
        {
            "unique_event_id": quality.duplicate_event_ids(staged),
            "unique_observation_id": quality.unique_violations(features, "observation_id"),
            "training_trip_known": known("trip_id", t.trips, "trip_id"),
            "training_route_known": known("route_id", t.routes, "route_id"),
            "training_stop_known": known("scheduled_stop_id", t.stops, "stop_id"),
            "label_sequence": quality.label_sequence_mismatch(training, features),
            "staged_completely": quality.missing_in_staging(t.positions, staged),
        }
    )
    rows = {
        "reasonable_delays": quality.has_unreasonable_delay(),
        "target_after_prediction": quality.has_early_target(),
        **{f"not_null_training_{c}": F.col(c).isNull() for c in TRAINING_NOT_NULL},
    }
    return report.unionByName(quality.row_report(training, rows)).unionByName(
        quality.row_report(staged, {"event_time_precedence": quality.has_other_event_time()})
    )


# Incremental tables


def _half(t: Tables) -> DataFrame:
    """The first half of the observations by id: what an earlier run had seen."""
    middle = t.positions.agg((F.max("id") / 2).cast("long").alias("id")).first().id
    return t.positions.filter(F.col("id") <= middle)


@query("high_water_mark", "select coalesce(max(observation_id), 0) mark from v_staged")
def high_water_mark(t: Tables) -> DataFrame:
    return _staged(t).agg(F.coalesce(F.max("observation_id"), F.lit(0)).alias("mark"))


@query(
    "incremental_append",
    "select * from v_staged where observation_id > (select max(id) // 2 from v_positions)",
)
def incremental_append(t: Tables) -> DataFrame:
    return incremental.new_observations(t.positions, staging.stg_positions(_half(t)))


# The scan on its own, against the plain window it stands for.


@query(
    "running_totals",
    """select id, sum(speed) over w speed_before, count(speed) over w rows_before
    from (select *, epoch_us(ingested_at) at_us from v_positions)
    window w as (partition by source order by at_us, id rows between unbounded preceding and 1 preceding)""",
)
def running_totals(t: Tables) -> DataFrame:
    """One key holds every row: only the sliced form can run this as more than one task."""
    rows = t.positions.select(
        "id", "source", F.unix_micros("ingested_at").alias("at"),
        F.col("speed").cast("decimal(18,2)").alias("speed"),
        F.col("speed").isNotNull().cast("long").alias("known"),
    )
    scanned = exclusive_scan(
        rows, ["source"], "at",
        [Measure("speed_before", "sum", "speed"), Measure("rows_before", "sum", "known")],
        tiebreak="id", hot_rows=8,
    )
    return scanned.select("id", "speed_before", F.coalesce("rows_before", F.lit(0)).alias("rows_before"))
