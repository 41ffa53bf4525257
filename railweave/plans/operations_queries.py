"""Queries over metrics, dead letters, offsets and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import source_time
from railweave.operators import metrics, retention, sketches
from railweave.operators.serving import newest_by_id
from railweave.plans.registry import query
from railweave.plans.serving_queries import now_of
from railweave.session import materialize
from railweave.sources.shaped import Tables

# The bundled events are minutes apart, so the windows span more than the live defaults.
RATE_MINUTES = 1440
LATENCY_MINUTES = 3 * 1440
RETENTION_DAYS = 20


query("event_count", "select count(*) events_ingested from v_positions")(
    lambda t: t.positions.agg(F.count("*").alias("events_ingested"))
)
query("dead_letter_count", "select count(*) dead_letter_records from v_dead_letters")(
    lambda t: t.dead_letters.agg(F.count("*").alias("dead_letter_records"))
)
query(
    "retained_window",
    "select * from v_metrics, v_now"
    " where metric_timestamp between now_ts - interval 20 days and now_ts",
)(
    lambda t: metrics.within(
        t.metrics, "metric_timestamp", metrics.before(now_of(t), days=RETENTION_DAYS), now_of(t)
    ).withColumn("now_ts", F.lit(now_of(t)))
)

THROUGHPUT_SQL = """
select sum(events_received)::bigint events_received_total, sum(events_persisted)::bigint events_persisted_total,
    sum(failed_batch_count)::bigint batches_failed_total, sum(dead_letter_events)::bigint events_dead_lettered_total,
    sum(duplicate_events)::bigint duplicate_records_total, sum(retry_count)::bigint retry_count_total,
    count(*) filter (where metric_kind = 'valid_batch') batches_processed_total,
    round(coalesce(sum(events_persisted) filter (where metric_timestamp >= now_ts - interval 1440 minutes), 0)
        / 1440.0::double, 6) current_events_per_minute,
    (select max(events)::double from (
        select sum(events_persisted)::bigint events from v_metrics, v_now
        where metric_kind = 'valid_batch'
            and metric_timestamp between now_ts - interval 20 days and now_ts
        group by date_trunc('minute', metric_timestamp))) peak_events_per_minute
from v_metrics, v_now
where metric_timestamp between now_ts - interval 20 days and now_ts
"""
query("throughput_totals", THROUGHPUT_SQL)(
    lambda t: metrics.throughput_totals(t.metrics, now_of(t), RATE_MINUTES, RETENTION_DAYS)
)
query(
    "peak_minute_rate",
    """select max(events)::bigint peak_events_per_minute from (
        select sum(events_persisted)::bigint events from v_metrics where metric_kind = 'valid_batch'
        group by date_trunc('minute', metric_timestamp))""",
)(lambda t: metrics.peak_minute_rate(t.metrics))
query(
    "minute_tumbling",
    """select date_trunc('minute', metric_timestamp) as minute, sum(events_persisted)::bigint events
    from v_metrics where metric_kind = 'valid_batch' group by 1""",
)(lambda t: metrics.minute_rates(t.metrics))
query(
    "trailing_rate",
    """select round(coalesce(sum(events_persisted), 0) / 1440.0::double, 6) events_per_minute
    from v_metrics, v_now
    where metric_timestamp between now_ts - interval 1440 minutes and now_ts""",
)(lambda t: metrics.trailing_rate(t.metrics, now_of(t), RATE_MINUTES))
query(
    "sliding_rates",
    """select w window_end, round(sum(events_persisted) / 5.0::double, 6) events_per_minute
    from (select *, unnest(generate_series(
        date_trunc('minute', metric_timestamp) + interval 1 minute,
        date_trunc('minute', metric_timestamp) + interval 5 minutes, interval 1 minute)) w
        from v_metrics)
    group by w""",
)(lambda t: metrics.sliding_rates(t.metrics))

LATENCY_SQL = """
select count(l) ingestion_latency_count, round(avg(l), 6) ingestion_latency_avg,
    round(quantile_cont(l, 0.5), 6) ingestion_latency_p50,
    round(quantile_cont(l, 0.95), 6) ingestion_latency_p95,
    round(quantile_cont(l, 0.99), 6) ingestion_latency_p99, round(max(l), 6) ingestion_latency_max,
    count(a) event_age_count, round(avg(a), 6) event_age_avg, round(quantile_cont(a, 0.5), 6) event_age_p50,
    round(quantile_cont(a, 0.95), 6) event_age_p95, round(quantile_cont(a, 0.99), 6) event_age_p99,
    round(max(a), 6) event_age_max
from (
    select case when feed_timestamp <= ingested_at and feed_timestamp >= ingested_at - interval 86400 seconds
            then epoch_us(ingested_at - feed_timestamp) / 1e6 end l,
        case when src <= now_ts and src >= now_ts - interval 86400 seconds
            then (epoch_us(now_ts) - epoch_us(src)) / 1e6 end a
    from (select *, coalesce(vehicle_timestamp, feed_timestamp) src from v_positions), v_now
    where ingested_at between now_ts - interval 4320 minutes and now_ts)
"""
query("latency_distribution", LATENCY_SQL)(
    lambda t: metrics.latency_distribution(t.positions, now_of(t), LATENCY_MINUTES)
)


SKETCHED_SQL = """
select count(l) ingestion_latency_count, round(avg(l), 6) ingestion_latency_avg, round(max(l), 6) ingestion_latency_max,
    true event_age_count_close, true ingestion_latency_p50_close, true ingestion_latency_p95_close,
    true ingestion_latency_p99_close, true event_age_p50_close, true event_age_p95_close, true event_age_p99_close
from (
    select case when feed_timestamp <= ingested_at and feed_timestamp >= ingested_at - interval 86400 seconds
            then epoch_us(ingested_at - feed_timestamp) / 1e6 end l
    from v_positions, v_now
    where ingested_at between date_trunc('minute', now_ts - interval 4320 minutes) and now_ts)
"""


@query("latency_sketches", SKETCHED_SQL)
def latency_sketches(t: Tables) -> DataFrame:
    """The distribution from a stored table of minutes, with each percentile's rank held against all values of the window."""
    now = now_of(t)
    minutes = materialize(sketches.minute_sketches(t.positions), "minutes")
    found = sketches.latency_from_sketches(minutes, now, LATENCY_MINUTES)
    first = F.date_trunc("minute", metrics.before(now, minutes=LATENCY_MINUTES))
    values = metrics.within(t.positions, "ingested_at", first, now).select(
        *(expr.alias(name) for name, expr in metrics.valid_latency(now).items())
    )
    exact = values.crossJoin(F.broadcast(found))
    closeness = []
    for kind in ("ingestion_latency", "event_age"):
        size = F.count(kind)
        for name, p in sketches.POINTS.items():
            at = F.col(f"{kind}_{name}")
            # The sketch's value lies between the values of the ranks around p; stored seconds are doubles.
            below = F.count_if(F.col(kind) < at - 1e-6) / size
            upto = F.count_if(F.col(kind) <= at + 1e-6) / size
            error = sketches.RANK_ERROR + 1 / size
            closeness.append(((below <= p + error) & (upto >= p - error)).alias(f"{kind}_{name}_close"))
    ages = F.abs(F.max("event_age_count") - F.count("event_age")) <= 1 + sketches.RANK_ERROR * F.count("*")
    return exact.agg(
        *(F.max(c).alias(c) for c in ("ingestion_latency_count", "ingestion_latency_avg", "ingestion_latency_max")),
        ages.alias("event_age_count_close"),
        *closeness,
    )


@query(
    "valid_latency",
    """select id, round(case when feed_timestamp <= ingested_at
            and feed_timestamp >= ingested_at - interval 86400 seconds
            then epoch_us(ingested_at - feed_timestamp) / 1e6 end, 6) ingestion_latency,
        round(case when coalesce(vehicle_timestamp, feed_timestamp) between
            now_ts - interval 86400 seconds and now_ts
            then (epoch_us(now_ts) - epoch_us(coalesce(vehicle_timestamp, feed_timestamp))) / 1e6 end, 6)
            event_age
    from v_positions, v_now""",
)
def valid_latency(t: Tables) -> DataFrame:
    values = metrics.valid_latency(now_of(t))
    return t.positions.select("id", *(expr.alias(name) for name, expr in values.items()))


QUALITY_SQL = """
select count(*) invalid_records,
    count(*) filter (where error_reason like 'Missing or invalid required event fields:%') missing_identifiers,
    count(*) filter (where error_type = 'ValueError') rejected_by_validation,
    count(*) filter (where error_type in ('JSONDecodeError', 'UnicodeDecodeError', 'TypeError')) schema_failures
from v_dead_letters, v_now
where processed_at between now_ts - interval {days} days and now_ts
"""
query("quality_counts", QUALITY_SQL.format(days=20))(
    lambda t: metrics.quality_counts(t.dead_letters, now_of(t), RETENTION_DAYS)
)
query(
    "missing_id_errors",
    "select dead_letter_id, error_type, error_reason from v_dead_letters"
    " where error_reason like 'Missing or invalid required event fields:%'"
    " or error_type in ('JSONDecodeError', 'UnicodeDecodeError', 'TypeError')",
)(
    lambda t: t.dead_letters.filter(
        metrics.is_missing_identifier() | metrics.is_schema_failure()
    ).select("dead_letter_id", "error_type", "error_reason")
)
query(
    "health_summary",
    """select max(latest_source_event_timestamp) latest_source_event_timestamp,
        max(latest_ingestion_timestamp) latest_ingestion_timestamp,
        sum(events_received)::bigint events_received, sum(events_persisted)::bigint events_persisted,
        sum(duplicate_events)::bigint duplicate_events, sum(error_count)::bigint error_count,
        arg_max(batch_size, (metric_timestamp, metric_id)) filter (where metric_kind = 'valid_batch')
            recent_batch_size,
        round(arg_max(processing_duration_seconds, (metric_timestamp, metric_id))
            filter (where metric_kind = 'valid_batch'), 6) recent_processing_duration_seconds,
        (select count(*) from v_dead_letters) dead_letter_events
    from v_metrics""",
)(lambda t: metrics.health_summary(t.metrics, t.dead_letters))
query(
    "latest_valid_batch",
    """select batch_size recent_batch_size,
        round(processing_duration_seconds, 6) recent_processing_duration_seconds
    from v_metrics where metric_kind = 'valid_batch'
    order by metric_timestamp desc, metric_id desc limit 1""",
)(lambda t: metrics.latest_valid_batch(t.metrics))


@query(
    "success_rate",
    """select date_trunc('day', metric_timestamp) as day, ok, failed,
        case when ok + failed > 0 then round(ok / (ok + failed)::double, 6) end success_rate
    from (select date_trunc('day', metric_timestamp) metric_timestamp,
            count(*) filter (where metric_kind = 'valid_batch') ok, sum(failed_batch_count)::bigint failed
        from v_metrics group by 1)""",
)
def success_rate(t: Tables) -> DataFrame:
    daily = t.metrics.groupBy(F.date_trunc("day", "metric_timestamp").alias("day")).agg(
        F.count_if(F.col("metric_kind") == "valid_batch").alias("ok"),
        F.sum("failed_batch_count").alias("failed"),
    )
    return daily.withColumn("success_rate", metrics.success_rate(F.col("ok"), F.col("failed")))


query(
    "latest_source_time",
    """select id // 100 batch, max(coalesce(vehicle_timestamp, feed_timestamp)) latest_source_event_timestamp,
        max(ingested_at) latest_ingestion_timestamp from v_positions group by 1""",
)(
    lambda t: metrics.latest_batch_times(
        t.positions.withColumn("batch", F.expr("id div 100")), ["batch"]
    )
)
query(
    "next_offsets",
    'select topic, "partition", max("offset") + 1 next_offset from v_messages group by 1, 2',
)(lambda t: metrics.next_offsets(t.messages))

LAG_SQL = """
select topic, "partition", case when committed >= 0 then committed end consumer_offset,
    high high_water_offset,
    greatest(high - case when committed >= 0 then greatest(committed, low) else low end, 0) as lag
from (select *, case "partition" when 0 then null when 1 then high - 5 else high + 5 end committed
    from v_watermarks)
"""
query("consumer_lag", LAG_SQL)(
    lambda t: metrics.consumer_lag(t.committed_offsets, t.watermark_offsets)
)
query("total_lag", f"select sum(lag)::bigint total_lag from ({LAG_SQL})")(
    lambda t: metrics.total_lag(metrics.consumer_lag(t.committed_offsets, t.watermark_offsets))
)


@query(
    "freshness_status",
    """select metric_id, case when latest_source_event_timestamp is not null then
            round(greatest((epoch_us(now_ts - interval 2 days)
                - epoch_us(latest_source_event_timestamp)) / 1e6, 0), 6) end freshness_seconds,
        case when latest_source_event_timestamp is null then 'UNKNOWN'
            when greatest((epoch_us(now_ts - interval 2 days)
                - epoch_us(latest_source_event_timestamp)) / 1e6, 0) <= 86400 then 'HEALTHY'
            else 'STALE' end freshness_status
    from (select metric_id, latest_source_event_timestamp from v_metrics), v_now""",
)
def freshness_status(t: Tables) -> DataFrame:
    """Judged two days before the newest event, so that every status and the clamp occur."""
    return metrics.with_freshness(
        t.metrics.select("metric_id", "latest_source_event_timestamp"),
        "latest_source_event_timestamp", metrics.before(now_of(t), days=2), 86_400.0,
    ).select("metric_id", "freshness_seconds", "freshness_status")


@query(
    "progress_probe",
    """select metric_id, round((epoch_us(now_ts - interval 2 days) - epoch_us(latest_ingestion_timestamp))
            / 1e6, 6) age_seconds,
        coalesce((epoch_us(now_ts - interval 2 days) - epoch_us(latest_ingestion_timestamp)) / 1e6
            between 0 and 86400, false) healthy
    from (select metric_id, latest_ingestion_timestamp from v_metrics), v_now""",
)
def progress_probe(t: Tables) -> DataFrame:
    return metrics.with_progress_health(
        t.metrics.select("metric_id", "latest_ingestion_timestamp"),
        "latest_ingestion_timestamp", metrics.before(now_of(t), days=2), 86_400,
    ).select("metric_id", "age_seconds", "healthy")


query(
    "latest_progress",
    """select 'producer' component, arg_max(ingestion_timestamp, ingestion_id) latest from v_ledger
        where source = 'events'
    union all select 'consumer', max(metric_timestamp) from v_metrics""",
)(lambda t: metrics.latest_progress(t.ledger, t.metrics, "events"))


@query(
    "batch_metric",
    """select id // 100 batch, count(*) batch_size, count(*) events_received,
        count(distinct event_id) events_persisted, count(*) filter (where current_status is null)
            dead_letter_events,
        count(*) filter (where current_status is null) error_count,
        greatest(count(*) - count(distinct event_id) - count(*) filter (where current_status is null), 0)
            duplicate_events,
        greatest(round(count(*) / 100.0::double - 0.5, 6), 0) processing_duration_seconds
    from v_positions group by 1""",
)
def batch_metric(t: Tables) -> DataFrame:
    rejected = F.count_if(F.col("current_status").isNull())
    batches = t.positions.groupBy(F.expr("id div 100").alias("batch")).agg(
        F.count("*").alias("batch_size"),
        F.countDistinct("event_id").alias("persisted"),
        rejected.alias("dead_letters"),
        rejected.alias("errors"),
        (F.count("*") / F.lit(100.0) - F.lit(0.5)).alias("duration"),
    )
    return metrics.batch_metric(batches)


query(
    "static_counts",
    """select (select count(*) from v_routes) routes, (select count(*) from v_stops) stops,
        (select count(*) from v_trips) trips, (select count(*) from v_stop_times) stop_times,
        null::bigint calendar, null::bigint calendar_dates, 'table_count' static_count_source""",
)(lambda t: metrics.static_counts(None, _static(t)))


def _static(t: Tables) -> dict[str, DataFrame]:
    return {"routes": t.routes, "stops": t.stops, "trips": t.trips, "stop_times": t.stop_times}


SNAPSHOT_SQL = f"""
select now_ts generated_at, 1440::bigint rate_window_minutes, 4320::bigint latency_window_minutes, th.*,
    round(batches_processed_total / (batches_processed_total + batches_failed_total)::double, 6) success_rate,
    la.*, qu.*,
    (select count(*) from v_routes) routes, (select count(*) from v_stops) stops,
    (select count(*) from v_trips) trips, (select count(*) from v_stop_times) stop_times,
    null::bigint calendar, null::bigint calendar_dates, 'table_count' static_count_source,
    (select arg_max(ingested_at, id) from v_positions) latest_persisted_event_timestamp,
    fr.src latest_source_event_timestamp,
    round(greatest((epoch_us(now_ts) - epoch_us(fr.src)) / 1e6, 0), 6) freshness_seconds,
    case when (epoch_us(now_ts) - epoch_us(fr.src)) / 1e6 <= 60 then 'HEALTHY' else 'STALE' end freshness_status,
    (select sum(lag)::bigint from ({LAG_SQL})) total_lag
from v_now, ({THROUGHPUT_SQL.replace('20 days', '30 days')}) th, ({LATENCY_SQL}) la,
    ({QUALITY_SQL.format(days=30)}) qu,
    (select max(latest_source_event_timestamp) src from v_metrics) fr
"""


@query("production_snapshot", SNAPSHOT_SQL)
def production_snapshot(t: Tables) -> DataFrame:
    return metrics.production_snapshot(
        t.positions, t.metrics, t.dead_letters,
        metrics.consumer_lag(t.committed_offsets, t.watermark_offsets),
        None, _static(t), now_of(t), RATE_MINUTES, LATENCY_MINUTES,
    )


# Retention


@query(
    "expired_rows",
    "select id, ingested_at from v_positions, v_now where ingested_at < now_ts - interval 14 days",
)
def expired_rows(t: Tables) -> DataFrame:
    return retention.expired(
        t.positions, "ingested_at", now_of(t), retention.POSITION_DAYS
    ).select("id", "ingested_at")


query(
    "expired_count",
    "select count(*) eligible from v_positions, v_now where ingested_at < now_ts - interval 14 days",
)(
    lambda t: retention.expired_count(
        t.positions, "ingested_at", now_of(t), retention.POSITION_DAYS
    )
)
query(
    "retention_batch",
    "select id, ingested_at from v_positions, v_now where ingested_at < now_ts - interval 14 days"
    " order by ingested_at, id limit 1000",
)(
    lambda t: retention.oldest_batch(
        t.positions, "ingested_at", "id", now_of(t), retention.POSITION_DAYS, 1000
    ).select("id", "ingested_at")
)


def _oldest_expired(t: Tables) -> DataFrame:
    return retention.oldest_batch(
        t.positions, "ingested_at", "id", now_of(t), retention.POSITION_DAYS, 1000
    )


query(
    "delete_semi",
    """with gone as (select id from v_positions, v_now where ingested_at < now_ts - interval 14 days
        order by ingested_at, id limit 1000)
    select id, id in (select id from gone) deleted from v_positions""",
)(
    lambda t: retention.without_selected(t.positions, _oldest_expired(t), "id")
    .select("id", F.lit(False).alias("deleted"))
    .unionByName(
        retention.only_selected(t.positions, _oldest_expired(t), "id").select(
            "id", F.lit(True).alias("deleted")
        )
    )
)
query(
    "newest_source_times",
    "select id, coalesce(vehicle_timestamp, feed_timestamp) source_time from v_positions"
    " order by id desc limit 25000",
)(
    lambda t: newest_by_id(
        t.positions.select("id", source_time().alias("source_time")), 25_000
    )
)
