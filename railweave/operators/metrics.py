"""Throughput, latency, data-quality and freshness numbers of the event pipeline."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import elapsed_seconds, source_time
from railweave.operators.percentiles import distributions

RATE_WINDOW_MINUTES = 5
LATENCY_WINDOW_MINUTES = 5
MAX_LATENCY_SECONDS = 86_400
METRICS_RETENTION_DAYS = 30
STALE_SECONDS = 60.0
PROGRESS_MAX_AGE_SECONDS = 300
STATIC_TABLES = ("routes", "stops", "trips", "stop_times", "calendar", "calendar_dates")

# The texts rejected messages are counted by.
MISSING_FIELDS_PREFIX = "Missing or invalid required event fields:"
SCHEMA_ERROR_TYPES = ("JSONDecodeError", "UnicodeDecodeError", "TypeError")
VALIDATION_ERROR_TYPE = "ValueError"


Moment = datetime | Column


def before(now: Moment, **span: int) -> Column:
    """The moment ``span`` (days, minutes, ... as for timedelta) before ``now``, which may be a scalar query."""
    return F.lit(now) - F.lit(timedelta(**span))


def within(df: DataFrame, column: str, start: Moment, end: Moment) -> DataFrame:
    """Rows in a time range, both ends included."""
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def _check_window(*minutes: int) -> None:
    if any(m < 1 for m in minutes):
        raise ValueError("Metrics windows must be at least one minute")


def _retained(df: DataFrame, column: str, now: Moment, days: int) -> DataFrame:
    return within(df, column, before(now, days=days), now)


def minute_rates(metrics: DataFrame) -> DataFrame:
    """Events persisted per minute by valid batches; works on a stream with a watermark too."""
    return (
        metrics.filter("metric_kind = 'valid_batch'")
        .groupBy(F.window("metric_timestamp", "1 minute").alias("w"))
        .agg(F.sum("events_persisted").alias("events"))
        .select(F.col("w.start").alias("minute"), "events")
    )


def peak_minute_rate(metrics: DataFrame) -> DataFrame:
    return minute_rates(metrics).agg(
        F.coalesce(F.max("events"), F.lit(0)).alias("peak_events_per_minute")
    )


def trailing_rate(metrics: DataFrame, now: Moment, minutes: int = RATE_WINDOW_MINUTES) -> DataFrame:
    """Events persisted per minute over the trailing window, all kinds of metric rows."""
    _check_window(minutes)
    recent = within(metrics, "metric_timestamp", before(now, minutes=minutes), now)
    return recent.agg(
        F.coalesce(F.sum("events_persisted") / F.lit(float(minutes)), F.lit(0.0)).alias(
            "events_per_minute"
        )
    )


def sliding_rates(metrics: DataFrame, minutes: int = RATE_WINDOW_MINUTES) -> DataFrame:
    """Trailing rate for every minute, as a stream or a batch."""
    return (
        metrics.groupBy(F.window("metric_timestamp", f"{minutes} minutes", "1 minute").alias("w"))
        .agg((F.sum("events_persisted") / F.lit(float(minutes))).alias("events_per_minute"))
        .select(F.col("w.end").alias("window_end"), "events_per_minute")
    )


def success_rate(succeeded: Column, failed: Column) -> Column:
    """Share of attempts that succeeded; NULL without attempts."""
    return F.try_divide(succeeded, succeeded + failed)


def throughput_totals(
    metrics: DataFrame, now: Moment, rate_minutes: int = RATE_WINDOW_MINUTES,
    retention_days: int = METRICS_RETENTION_DAYS,
) -> DataFrame:
    """Totals over the retained metric rows, with current and peak rate, as one row.

    Rows are first summed per minute and kind. That small result gives every total and the peak,
    so the metric rows are read once.
    """
    _check_window(rate_minutes)
    counters = {
        "events_received_total": "events_received",
        "events_persisted_total": "events_persisted",
        "batches_failed_total": "failed_batch_count",
        "events_dead_lettered_total": "dead_letter_events",
        "duplicate_records_total": "duplicate_events",
        "retry_count_total": "retry_count",
    }
    valid = F.col("metric_kind") == "valid_batch"
    in_rate = F.col("metric_timestamp").between(before(now, minutes=rate_minutes), F.lit(now))
    per_minute = (
        _retained(metrics, "metric_timestamp", now, retention_days)
        .groupBy(F.date_trunc("minute", "metric_timestamp").alias("minute"))
        .agg(
            *(F.sum(source).alias(name) for name, source in counters.items()),
            F.count_if(valid).alias("batches_processed_total"),
            F.sum(F.when(valid, F.col("events_persisted"))).alias("minute_events"),
            F.sum(F.when(in_rate, F.col("events_persisted"))).alias("recent_events"),
        )
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return per_minute.agg(
        *(total(name).alias(name) for name in (*counters, "batches_processed_total")),
        (total("recent_events") / F.lit(float(rate_minutes))).alias("current_events_per_minute"),
        F.coalesce(F.max("minute_events"), F.lit(0)).cast("double").alias("peak_events_per_minute"),
    )


def valid_latency(now: Moment, max_seconds: int = MAX_LATENCY_SECONDS) -> dict[str, Column]:
    """Ingestion latency and event age in seconds; NULL when missing, negative or too large."""
    ingested, feed, source = F.col("ingested_at"), F.col("feed_timestamp"), source_time()
    limit = F.make_dt_interval(secs=F.lit(max_seconds))
    reference = F.lit(now)
    return {
        "ingestion_latency": F.when(
            feed.between(ingested - limit, ingested), elapsed_seconds(ingested, feed)
        ),
        "event_age": F.when(
            source.between(reference - limit, reference), elapsed_seconds(reference, source)
        ),
    }


def latency_distribution(
    positions: DataFrame, now: Moment, window_minutes: int = LATENCY_WINDOW_MINUTES, approx: bool = False
) -> DataFrame:
    """Count, mean, percentiles and maximum of both latencies over the whole window, as one row.

    Percentiles are exact, from counts per microsecond value, however many rows the window holds. With ``approx`` they come
    from quantile sketches of the window's minutes, which ``sketches.latency_from_sketches`` takes from a stored table as well.
    """
    _check_window(window_minutes)
    if approx:
        from railweave.operators.sketches import latency_from_sketches, minute_sketches

        first = F.date_trunc("minute", before(now, minutes=window_minutes))
        recent = within(positions, "ingested_at", first, now)
        return latency_from_sketches(minute_sketches(recent), now, window_minutes)
    recent = within(positions, "ingested_at", before(now, minutes=window_minutes), now)
    latencies = valid_latency(now)
    micros = recent.select(
        *(F.round(expr * 1_000_000).cast("long").alias(name) for name, expr in latencies.items())
    )

    every = distributions(micros, list(latencies), {f"p{p}": p / 100 for p in (50, 95, 99)})
    return every.select(
        *(
            (F.col(c) if c.endswith("_count") else F.col(c) / 1_000_000).alias(c)
            for c in every.columns if not c.endswith("_min")
        )
    )


def is_missing_identifier() -> Column:
    return F.col("error_reason").startswith(MISSING_FIELDS_PREFIX)


def is_schema_failure() -> Column:
    return F.col("error_type").isin(*SCHEMA_ERROR_TYPES)


def quality_counts(
    dead_letters: DataFrame, now: Moment, retention_days: int = METRICS_RETENTION_DAYS
) -> DataFrame:
    """Rejected messages in total and by reason."""
    return _retained(dead_letters, "processed_at", now, retention_days).agg(
        F.count("*").alias("invalid_records"),
        F.count_if(is_missing_identifier()).alias("missing_identifiers"),
        F.count_if(F.col("error_type") == VALIDATION_ERROR_TYPE).alias("rejected_by_validation"),
        F.count_if(is_schema_failure()).alias("schema_failures"),
    )


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames, each joined on as a scalar subquery."""
    for number, other in enumerate(others):
        name = f"_row{number}"
        row = other.select(F.struct(*other.columns)).scalar()
        first = first.withColumn(name, row).select("*", f"{name}.*").drop(name)
    return first


def latest_valid_batch(metrics: DataFrame) -> DataFrame:
    """Size and duration of the newest valid batch; NULLs when there is none."""
    row = F.max_by(
        F.struct("batch_size", "processing_duration_seconds"),
        F.struct("metric_timestamp", "metric_id"),
    )
    return metrics.filter("metric_kind = 'valid_batch'").agg(row.alias("row")).select(
        F.col("row.batch_size").alias("recent_batch_size"),
        F.col("row.processing_duration_seconds").alias("recent_processing_duration_seconds"),
    )


def health_summary(metrics: DataFrame, dead_letters: DataFrame) -> DataFrame:
    """All-time totals, the newest batch and the dead-letter count, as one row."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    valid = F.col("metric_kind") == "valid_batch"
    newest = F.max_by(
        F.struct("batch_size", "processing_duration_seconds"),
        F.when(valid, F.struct("metric_timestamp", "metric_id")),
    )
    totals = metrics.agg(
        F.max("latest_source_event_timestamp").alias("latest_source_event_timestamp"),
        F.max("latest_ingestion_timestamp").alias("latest_ingestion_timestamp"),
        total("events_received"),
        total("events_persisted"),
        total("duplicate_events"),
        total("error_count"),
        newest.alias("newest"),
    ).select(
        "*",
        F.col("newest.batch_size").alias("recent_batch_size"),
        F.col("newest.processing_duration_seconds").alias("recent_processing_duration_seconds"),
    ).drop("newest")
    letters = dead_letters.agg(F.count("*").alias("dead_letter_events"))
    return side_by_side(totals, letters)


def latest_batch_times(records: DataFrame, by: list[str]) -> DataFrame:
    """Newest source time (NULL when none was sent) and ingestion time per batch."""
    return records.groupBy(*by).agg(
        F.max(source_time()).alias("latest_source_event_timestamp"),
        F.max("ingested_at").alias("latest_ingestion_timestamp"),
    )


def next_offsets(messages: DataFrame) -> DataFrame:
    """Offset to continue from, per topic and partition."""
    return (
        messages.groupBy("topic", "partition")
        .agg((F.max("offset") + 1).alias("next_offset"))
        .orderBy("topic", "partition")
    )


def consumer_lag(committed: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Messages left to read per partition.

    Without a usable commit reading starts at the low watermark; it never starts below it.
    """
    known = F.when(F.col("committed") >= 0, F.col("committed"))
    effective = F.coalesce(F.greatest(known, F.when(known.isNotNull(), F.col("low"))), F.col("low"))
    return watermarks.join(committed, ["topic", "partition"], "left").select(
        "topic",
        "partition",
        known.alias("consumer_offset"),
        F.col("high").alias("high_water_offset"),
        F.greatest(F.col("high") - effective, F.lit(0)).alias("lag"),
    )


def total_lag(lag: DataFrame) -> DataFrame:
    return lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))


def with_freshness(df: DataFrame, latest: str, now: Moment, stale_seconds: float = STALE_SECONDS):
    """Adds age in seconds (never negative) and HEALTHY, STALE or UNKNOWN."""
    # greatest() skips NULL, so an unknown age must be kept NULL explicitly.
    age = F.when(
        F.col(latest).isNotNull(),
        F.greatest(elapsed_seconds(F.lit(now), F.col(latest)), F.lit(0.0)),
    )
    status = F.when(age.isNull(), "UNKNOWN").when(age <= stale_seconds, "HEALTHY").otherwise("STALE")
    return df.withColumns({"freshness_seconds": age, "freshness_status": status})


def latest_progress(ledger: DataFrame, metrics: DataFrame, source: str) -> DataFrame:
    """Newest successful work of the feed producer and of the event consumer."""
    producer = ledger.filter(F.col("source") == source).agg(
        F.max_by("ingestion_timestamp", "ingestion_id").alias("latest")
    )
    consumer = metrics.agg(F.max("metric_timestamp").alias("latest"))
    return producer.select(F.lit("producer").alias("component"), "latest").unionByName(
        consumer.select(F.lit("consumer").alias("component"), "latest")
    )


def with_progress_health(df: DataFrame, latest: str, now: Moment,
                         max_age: float = PROGRESS_MAX_AGE_SECONDS) -> DataFrame:
    """Healthy while the age is between zero and ``max_age``; unknown or future is unhealthy."""
    age = elapsed_seconds(F.lit(now), F.col(latest))
    return df.withColumns(
        {"age_seconds": age, "healthy": F.coalesce(age.between(0, max_age), F.lit(False))}
    )


def batch_metric(batches: DataFrame) -> DataFrame:
    """Metric counters from ``batch_size``, ``persisted``, ``dead_letters``, ``errors``, ``duration``."""
    duplicates = F.greatest(
        F.col("batch_size") - F.col("persisted") - F.col("dead_letters"), F.lit(0)
    )
    return batches.withColumns(
        {
            "events_received": F.col("batch_size"),
            "events_persisted": F.col("persisted"),
            "duplicate_events": duplicates,
            "dead_letter_events": F.col("dead_letters"),
            "error_count": F.col("errors"),
            "processing_duration_seconds": F.greatest(F.col("duration"), F.lit(0.0)),
        }
    ).drop("persisted", "dead_letters", "errors", "duration")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table, in one pass over each."""
    named = [table.select(F.lit(name).alias("table")) for name, table in tables.items()]
    rows = reduce(DataFrame.unionByName, named)
    return rows.agg(*(F.count_if(F.col("table") == name).alias(name) for name in tables))


def static_counts(load_history: DataFrame | None, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per static table: the newest load manifest's counts, else counted, else NULL."""
    if load_history is not None and not load_history.isEmpty():
        newest = load_history.agg(F.max_by("row_counts", "load_id").alias("counts"))
        return newest.select(
            *(F.try_element_at("counts", F.lit(name)).alias(name) for name in STATIC_TABLES),
            F.lit("load_manifest").alias("static_count_source"),
        )
    known = {name: tables[name] for name in STATIC_TABLES if name in tables}
    useful = reduce(Column.__or__, (F.col(name) > 0 for name in known))
    return table_counts(known).select(
        *(F.when(useful, F.col(name) if name in known else F.lit(None)).cast("long").alias(name)
          for name in STATIC_TABLES),
        F.when(useful, "table_count").otherwise("unavailable").alias("static_count_source"),
    )


def production_snapshot(
    positions: DataFrame, metrics: DataFrame, dead_letters: DataFrame, lag: DataFrame,
    load_history: DataFrame | None, tables: dict[str, DataFrame], now: Moment,
    rate_minutes: int = RATE_WINDOW_MINUTES, latency_minutes: int = LATENCY_WINDOW_MINUTES,
) -> DataFrame:
    """Everything an operator looks at, as one row."""
    throughput = throughput_totals(metrics, now, rate_minutes).withColumn(
        "success_rate",
        success_rate(F.col("batches_processed_total"), F.col("batches_failed_total")),
    )
    newest = positions.agg(F.max_by("ingested_at", "id").alias("latest_persisted_event_timestamp"))
    health = with_freshness(
        metrics.agg(F.max("latest_source_event_timestamp").alias("latest_source_event_timestamp")),
        "latest_source_event_timestamp",
        now,
    )
    snapshot = side_by_side(
        throughput,
        latency_distribution(positions, now, latency_minutes),
        quality_counts(dead_letters, now),
        static_counts(load_history, tables),
        newest,
        health,
        total_lag(lag),
    )
    return snapshot.select(
        F.lit(now).alias("generated_at"),
        F.lit(rate_minutes).alias("rate_window_minutes"),
        F.lit(latency_minutes).alias("latency_window_minutes"),
        "*",
    )


def snapshot_json(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        F.to_json(F.struct(*sorted(snapshot.columns)), {"ignoreNullFields": "false"}).alias("value")
    )
