"""Delay features and the four-stops-ahead label for vehicle observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import (
    day_of_week,
    delay_seconds,
    gtfs_seconds,
    is_weekend,
    service_timestamp,
)
from railweave.operators.availability import available_delay
from railweave.operators.carried import Carried, with_carried
from railweave.operators.scan import (
    DAY_MICROS,
    HOT_ROWS,
    HOUR_MICROS,
    Measure,
    exclusive_scan,
    large_keys,
)
from railweave.session import materialize

STOPS_AHEAD = 4
LABEL_METHOD = "vehicle_trip_stop_sequence_plus_4"
REQUIRED = [
    "vehicle_id", "trip_id", "route_id", "start_date", "current_stop_sequence", "event_timestamp",
]
# Larger than any stop sequence of a real trip, so a trip is normally one slice.
SEQUENCE_SLICE = 4096
LAST_TIEBREAK = (1 << 63) - 1


def schedule_features(
    staged_stop_times: DataFrame, hot_rows: int | None = HOT_ROWS, sliced: bool | None = None
) -> DataFrame:
    """Schedule clock as seconds, dwell at the stop and travel time to the trip's next stop."""
    arrival = gtfs_seconds(F.col("arrival_time"))
    departure = gtfs_seconds(F.col("departure_time"))
    # Read by the checks and passes of the scan, and by the rows that stay out of it.
    stops = materialize(
        staged_stop_times.select("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"), "stops"
    )

    def timed(rows: DataFrame, travel: Column) -> DataFrame:
        return rows.select(
            "trip_id",
            F.col("stop_id").alias("scheduled_stop_id"),
            "stop_sequence",
            "arrival_time",
            "departure_time",
            arrival.alias("scheduled_arrival_seconds"),
            departure.alias("scheduled_departure_seconds"),
            (departure - arrival).alias("scheduled_dwell_time_sec"),
            travel.cast("int").alias("scheduled_travel_time_to_next_stop_sec"),
        )

    # Rows without a trip or sequence can never match an observation but stay in the result.
    placed = stops.filter(F.col("trip_id").isNotNull() & F.col("stop_sequence").isNotNull())
    loose = stops.filter(F.col("trip_id").isNull() | F.col("stop_sequence").isNull())
    # What follows from a row alone is added after the scan, so that it is not moved with it.
    scanned = exclusive_scan(
        placed.select(
            "*",
            # The next stop is the last one seen when the trip is walked from its end.
            (-F.col("stop_sequence").cast("long")).alias("from_end"),
            F.struct(arrival.alias("arrival")).alias("arrival_here"),
        ),
        ["trip_id"],
        "from_end",
        [Measure("next_stop", "last", "arrival_here")],
        slice_width=SEQUENCE_SLICE,
        hot_rows=hot_rows,
        sliced=sliced,
    )
    return timed(scanned, F.col("next_stop.arrival") - departure).unionByName(timed(loose, F.lit(None)))


def eligible_observations(staged_positions: DataFrame) -> DataFrame:
    """Observations that carry everything a delay needs, with calendar features."""
    ts = F.col("event_timestamp")
    return staged_positions.dropna(subset=REQUIRED).select(
        "*",
        F.hour(ts).alias("hour"),
        day_of_week(ts).alias("day_of_week"),
        is_weekend(ts).alias("is_weekend"),
    )


def observations_with_schedule(observations: DataFrame, schedule: DataFrame) -> DataFrame:
    """Observations at the scheduled stop they report, with the delay in seconds.

    The join strategy is left to AQE: a small schedule is broadcast after its size is known, and
    a trip that holds a large share of the observations is split by the skew-join rule.
    """
    scheduled = schedule.withColumnsRenamed(
        {"stop_sequence": "current_stop_sequence",
         "arrival_time": "scheduled_arrival_time",
         "departure_time": "scheduled_departure_time"}
    )
    due = service_timestamp(F.col("start_date"), F.col("scheduled_arrival_seconds"))
    return (
        observations.join(scheduled, ["trip_id", "current_stop_sequence"])
        .withColumn("scheduled_arrival_timestamp", due)
        .withColumns(
            {
                "observed_stop_matches_schedule": F.col("stop_id") == F.col("scheduled_stop_id"),
                "current_delay_sec": delay_seconds(
                    F.col("event_timestamp"), F.col("scheduled_arrival_timestamp")
                ),
            }
        )
    )


def _clock(df: DataFrame) -> DataFrame:
    return df.withColumn("at", F.unix_micros("event_timestamp"))


def previous_delay(
    current: DataFrame, hot_rows: int = HOT_ROWS, sliced: bool | None = None, carried: Carried | None = None
):
    """Delay at the same vehicle and trip's previous observation, per ``row_id``.

    ``carried`` stands for the observations before those of ``current``.
    """
    rows = _clock(current).select(
        "row_id", "vehicle_id", "trip_id", "at", "observation_id",
        F.struct("current_delay_sec").alias("delay"),
    )
    scanned = exclusive_scan(
        rows, ["vehicle_id", "trip_id"], "at", [Measure("previous", "last", "delay")],
        tiebreak="observation_id", slice_width=7 * DAY_MICROS,
        hot_rows=hot_rows, sliced=sliced,
    )
    delay = F.col("previous.current_delay_sec")
    if carried is not None:
        scanned = with_carried(scanned, carried, "vehicle")
        earlier = F.col("carried_last.current_delay_sec").cast("int")
        delay = F.when(F.col("previous").isNotNull(), delay).otherwise(earlier)
    return scanned.select("row_id", delay.alias("previous_observed_delay_sec"))


def historical_delay(
    current: DataFrame, key: str, name: str, slice_width: int = HOUR_MICROS,
    hot_rows: int = HOT_ROWS, sliced: bool | None = None, carried: Carried | None = None,
):
    """Mean delay over all earlier observations with the same ``key``, per ``row_id``.

    ``carried`` stands for the observations before those of ``current``.
    """
    rows = _clock(current).select(
        "row_id", "at", "observation_id",
        F.col(key).isNotNull().alias("has_key"),
        F.coalesce(F.col(key), F.lit("")).alias("key"),
        F.col("current_delay_sec").cast("long").alias("delay"),
        F.col("current_delay_sec").isNotNull().cast("long").alias("known"),
    )
    scanned = exclusive_scan(
        rows, ["has_key", "key"], "at",
        [Measure("delay_sum", "sum", "delay"), Measure("delay_count", "sum", "known")],
        tiebreak="observation_id", slice_width=slice_width,
        hot_rows=hot_rows, sliced=sliced,
    )
    total, count = F.col("delay_sum"), F.col("delay_count")
    if carried is not None:
        named = scanned.withColumn(key, F.when(F.col("has_key"), F.col("key")))
        scanned = with_carried(named, carried, "route" if key == "route_id" else "stop")
        total, count = (
            F.coalesce(here, F.lit(0)) + F.coalesce(F.col(before), F.lit(0))
            for here, before in ((total, "carried_sum"), (count, "carried_count"))
        )
    return scanned.select("row_id", F.try_divide(total, count).alias(name))


def _target_keys(same_service_day: bool) -> list[str]:
    return ["vehicle_id", "trip_id", *(["start_date"] if same_service_day else []), "sequence"]


def _questions_and_answers(current: DataFrame, stops_ahead: int, same_service_day: bool) -> DataFrame:
    """Every observation twice, newest first: as a question and as an answer."""
    keys = _target_keys(same_service_day)
    base = _clock(current).withColumn("back", -F.col("at"))
    here = F.col("current_stop_sequence").cast("long")
    answer = F.struct(
        F.col("observation_id").alias("target_observation_id"),
        F.col("event_timestamp").alias("target_event_timestamp"),
        F.col("current_delay_sec").alias("target_delay_4_stops_sec"),
    )
    questions = base.withColumn("sequence", here + stops_ahead).select(
        "row_id", "observation_id", *keys, "back", F.col("row_id").alias("place"),
        F.lit(0).cast("long").alias("is_answer"),
    )
    answers = base.withColumn("sequence", here).select(
        *keys, "back", (F.lit(LAST_TIEBREAK) - F.col("observation_id")).alias("place"),
        F.lit(1).cast("long").alias("is_answer"), answer.alias("answer"),
    )
    return questions.unionByName(answers, allowMissingColumns=True)


def first_future_target(
    current: DataFrame, stops_ahead: int = STOPS_AHEAD, same_service_day: bool = False,
    hot_rows: int = HOT_ROWS, sliced: bool | None = None,
):
    """First later observation of the vehicle and trip at stop sequence + ``stops_ahead``.

    Every observation enters one ordered scan twice, as a question at the sequence it looks for
    and as an answer at the sequence it reports. Walking back in time, the last answer seen is
    the earliest later one, so the work is linear where joining all later pairs is quadratic in
    the polls per stop. Only strictly later answers count: at one instant questions are placed
    before answers, and answers by descending id.
    """
    scanned = exclusive_scan(
        _questions_and_answers(current, stops_ahead, same_service_day),
        _target_keys(same_service_day), "back", [Measure("target", "last", "answer")],
        tiebreak="place", slice_width=30 * DAY_MICROS,
        hot_rows=hot_rows, sliced=sliced,
    )
    return scanned.filter(
        F.col("row_id").isNotNull() & F.col("target").isNotNull()
    ).select("row_id", "target.*")


def future_candidate_counts(
    current: DataFrame, stops_ahead: int = STOPS_AHEAD, same_service_day: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """How many later observations could serve as label, per observation that has any."""
    scanned = exclusive_scan(
        _questions_and_answers(current, stops_ahead, same_service_day),
        _target_keys(same_service_day), "back", [Measure("candidates", "sum", "is_answer")],
        tiebreak="place", slice_width=30 * DAY_MICROS, hot_rows=hot_rows,
    )
    return (
        scanned.filter(F.col("row_id").isNotNull() & (F.col("candidates") > 0))
        .groupBy("observation_id")
        .agg(F.sum("candidates").alias("candidates"))
    )


def current_features(staged_positions: DataFrame, staged_stop_times: DataFrame) -> DataFrame:
    """Schedule-matched observations as a written table with a stable ``row_id``.

    It is written because four scans and the final join read it. ``row_id`` also keeps apart the
    copies of an observation that a repeated (trip, sequence) in the schedule would make.
    """
    return matched_features(staged_positions, schedule_features(staged_stop_times))


def matched_features(staged_positions: DataFrame, schedule: DataFrame) -> DataFrame:
    """``current_features`` with the result of ``schedule_features``."""
    matched = observations_with_schedule(eligible_observations(staged_positions), schedule)
    return materialize(
        matched.withColumn("row_id", F.monotonically_increasing_id()), "current-features"
    )


def delay_features(
    current: DataFrame, hot_rows: int = HOT_ROWS, same_service_day: bool = False,
    carried: Carried | None = None, availability: str | None = None,
) -> DataFrame:
    """All features and the label, one row per schedule-matched observation.

    ``current`` is the table of ``current_features``. Each scan moves only its own few columns
    and the wide rows are shuffled once, for the final join on ``row_id``. With ``carried``, ``current`` holds the
    observations from its start on, and the totals stand for all earlier ones. With ``availability``, such as
    ``ingested_at``, the historical means leave out what had not arrived when the observation itself did.
    """
    if carried is not None and availability is not None:
        raise ValueError("Totals of old observations do not say when each of them arrived")
    keys = {"vehicle": ["vehicle_id", "trip_id"], "route": ["route_id"], "stop": ["scheduled_stop_id"]}
    # The label scan takes every row twice, hence half the limit. A small table needs no check.
    limit = max(hot_rows // 2, 1)
    large = set() if current.count() <= limit else large_keys(current, keys, limit)

    def options(key: str) -> dict:
        return {"hot_rows": hot_rows, "sliced": key in large}

    def history(key: str, name: str, scan: str, **more) -> DataFrame:
        if availability is not None:
            return available_delay(current, key, name, availability=availability, **more, **options(scan))
        return historical_delay(current, key, name, carried=carried, **more, **options(scan))

    route = history("route_id", "historical_route_delay_sec", "route")
    stop = history(
        "scheduled_stop_id", "historical_stop_delay_sec", "stop", slice_width=DAY_MICROS
    )
    targets = first_future_target(
        current, same_service_day=same_service_day, **options("vehicle")
    )
    joined = current.join(previous_delay(current, carried=carried, **options("vehicle")), "row_id", "left")
    for found in (route, stop, targets):
        joined = joined.join(found, "row_id", "left")
    return joined.select(
        "observation_id", "event_id", "ingested_at", "feed_timestamp", "vehicle_timestamp",
        "event_timestamp", "entity_id", "vehicle_id", "vehicle_label", "trip_id", "route_id",
        "direction_id", "start_time", "start_date",
        F.col("stop_id").alias("observed_stop_id"),
        "scheduled_stop_id", "observed_stop_matches_schedule", "current_stop_sequence",
        "current_status", "latitude", "longitude", "bearing", "speed", "occupancy_status",
        "scheduled_arrival_time", "scheduled_departure_time", "scheduled_arrival_timestamp",
        "scheduled_arrival_seconds", "scheduled_departure_seconds", "scheduled_dwell_time_sec",
        "scheduled_travel_time_to_next_stop_sec", "hour", "day_of_week", "is_weekend",
        "current_delay_sec", "previous_observed_delay_sec", "historical_route_delay_sec",
        "historical_stop_delay_sec", "target_observation_id", "target_event_timestamp",
        "target_delay_4_stops_sec",
        F.col("target_delay_4_stops_sec").isNotNull().alias("has_target_delay_4_stops"),
        F.lit(LABEL_METHOD).alias("target_generation_method"),
    )


def training_projection(features: DataFrame) -> DataFrame:
    """Labelled rows in the column layout of the training mart."""
    dropped = ("entity_id", "has_target_delay_4_stops", "event_timestamp")
    kept = [c for c in features.columns if c not in dropped]
    kept.insert(kept.index("vehicle_timestamp") + 1, "prediction_timestamp")
    return (
        features.filter("has_target_delay_4_stops")
        .withColumn("prediction_timestamp", F.col("event_timestamp"))
        .select(*kept, F.current_timestamp().alias("training_row_created_at"))
    )
