"""Column expressions for schedule clocks, service days and event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AGENCY_ZONE = "America/New_York"


def gtfs_seconds(clock: Column) -> Column:
    """Seconds since the service-day start of an ``HH:MM:SS`` text that may pass 24 hours."""
    hours, minutes, seconds = (
        F.split_part(clock, F.lit(":"), F.lit(n)).cast("int") for n in (1, 2, 3)
    )
    return hours * 3600 + minutes * 60 + seconds


def service_timestamp(start_date: Column, seconds: Column, zone: str = AGENCY_ZONE) -> Column:
    """Instant reached ``seconds`` of elapsed time after local midnight of a ``yyyyMMdd`` day."""
    midnight = F.make_timestamp(
        F.substring(start_date, 1, 4).cast("int"),
        F.substring(start_date, 5, 2).cast("int"),
        F.substring(start_date, 7, 2).cast("int"),
        F.lit(0),
        F.lit(0),
        F.lit(0),
        F.lit(zone),
    )
    return midnight + F.make_dt_interval(secs=seconds)


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Fractional seconds from ``earlier`` to ``later``."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def delay_seconds(observed: Column, scheduled: Column) -> Column:
    """Whole seconds behind schedule; halves round away from zero."""
    return F.round(elapsed_seconds(observed, scheduled)).cast("int")


def event_time(
    vehicle: Column | str = "vehicle_timestamp",
    feed: Column | str = "feed_timestamp",
    ingested: Column | str = "ingested_at",
) -> Column:
    """Event time used by staging and serving: the vehicle's, else the feed's, else ingestion."""
    return F.coalesce(*(F.col(c) if isinstance(c, str) else c for c in (vehicle, feed, ingested)))


def source_time() -> Column:
    """Event time as the source reported it; NULL when neither clock was sent."""
    return F.coalesce(F.col("vehicle_timestamp"), F.col("feed_timestamp"))


def day_of_week(ts: Column) -> Column:
    """Weekday with Sunday as 0."""
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    return day_of_week(ts).isin(0, 6)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with offset; the fraction is left out when it is zero."""
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )
