"""Latency percentiles from mergeable sketches, one row of them per minute.

``minute_sketches`` reduces observations to a row for each minute of ingestion: counts, sums, extremes, and two quantile sketches of bounded
size. Stored rows of any minutes merge, so the distribution over a window reads its minutes and never the observations again.

Ingestion latency does not depend on when it is asked for. Event age does: age is ``now`` minus the source time, so source times
are sketched, and the ages within the limit are those between two ranks of that sketch.

Counts, means and maxima are exact, except for the event age in windows that hold source times outside the limit, where they follow from the
sketch as well. Percentiles are off by at most ``RANK_ERROR`` in rank, in nearly all cases (99 %).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import source_time
from railweave.operators.metrics import (
    LATENCY_WINDOW_MINUTES,
    MAX_LATENCY_SECONDS,
    Moment,
    before,
    valid_latency,
)

#: Size of a sketch, and what it promises for the rank of a percentile.
SKETCH_SIZE, RANK_ERROR = 800, 0.01
POINTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
#: Ranks at which source times are taken.
GRID = 2000


def minute_sketches(positions: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """One row per minute of ingestion. Works on a stream with a watermark on ``ingested_at`` too."""
    now = F.col("ingested_at")
    latency = F.round(valid_latency(now)["ingestion_latency"] * 1_000_000).cast("long")
    rows = positions.select(
        F.window("ingested_at", "1 minute").start.alias("minute"),
        latency.alias("latency"),
        F.unix_micros(source_time()).alias("source"),
    )
    return rows.groupBy("minute").agg(
        F.count("latency").alias("latency_count"),
        F.sum("latency").alias("latency_sum"),
        F.max("latency").alias("latency_max"),
        F.kll_sketch_agg_bigint("latency", size).alias("latency_sketch"),
        F.count("source").alias("source_count"),
        F.sum(F.col("source").cast("decimal(38,0)")).alias("source_sum"),
        F.min("source").alias("source_min"),
        F.max("source").alias("source_max"),
        F.kll_sketch_agg_bigint("source", size).alias("source_sketch"),
    )


def merged_minutes(sketches: DataFrame, now: Moment, window_minutes: int) -> DataFrame:
    """The whole minutes that a window touches, as one row; rows of the same minute from several runs merge too."""
    first = F.date_trunc("minute", before(now, minutes=window_minutes))
    inside = sketches.filter(F.col("minute").between(first, F.lit(now)))
    return inside.agg(
        *(F.sum(c).alias(c) for c in ("latency_count", "latency_sum", "source_count", "source_sum")),
        *(F.max(c).alias(c) for c in ("latency_max", "source_max")),
        F.min("source_min").alias("source_min"),
        *(
            F.kll_merge_agg_bigint(F.when(F.col(f"{part}_count") > 0, F.col(f"{part}_sketch"))).alias(f"{part}_sketch")
            for part in ("latency", "source")
        ),
    )


def latency_from_sketches(
    sketches: DataFrame, now: Moment, window_minutes: int = LATENCY_WINDOW_MINUTES,
    max_seconds: int = MAX_LATENCY_SECONDS,
) -> DataFrame:
    """The columns of ``latency_distribution`` for the whole minutes of the window, as one row."""
    merged = merged_minutes(sketches, now, window_minutes)
    asked = F.unix_micros(F.lit(now))
    oldest = asked - max_seconds * 1_000_000

    def seconds(micros: Column) -> Column:
        return micros.cast("double") / 1_000_000

    # A sketch takes constant ranks only, so source times are taken at evenly spaced ones and looked up among them.
    ranks = F.array(*(F.lit(i / GRID) for i in range(GRID + 1)))
    some = F.coalesce(F.col("source_count") > 0, F.lit(False))
    inside = some & (F.col("source_min") >= oldest) & (F.col("source_max") <= asked)
    grid = F.when(some, F.kll_sketch_get_quantile_bigint("source_sketch", ranks))
    gridded = merged.select("*", inside.alias("inside"), grid.alias("grid"), asked.alias("asked"), oldest.alias("oldest"))
    asked, oldest = F.col("asked"), F.col("oldest")

    def share_up_to(limit: Column) -> Column:
        return F.coalesce(F.size(F.filter("grid", lambda x: x <= limit)) / F.lit(float(GRID + 1)), F.lit(0.0))

    # Shares of source times that are too old, and that are not in the future.
    placed = gridded.withColumns(
        {
            "low": F.when(F.col("inside"), 0.0).when(some, share_up_to(oldest - 1)).otherwise(0.0),
            "high": F.when(F.col("inside"), 1.0).when(some, share_up_to(asked)).otherwise(0.0),
        }
    )
    share = F.col("high") - F.col("low")
    age_count = F.when(some, F.round(F.col("source_count") * share)).otherwise(0).cast("long")
    known = some & (age_count > 0)

    def age(p: float) -> Column:
        # The older a source time, the higher its age ranks.
        at = F.get("grid", F.round((F.col("high") - F.lit(p) * share) * GRID).cast("int"))
        return F.when(known, seconds(asked - F.least(F.greatest(at, oldest), asked)))

    ages = F.transform(F.filter("grid", lambda x: x.between(oldest, asked)), lambda x: seconds(asked - x))
    mean_of_ages = F.try_divide(F.aggregate(ages, F.lit(0.0), lambda a, x: a + x), F.size(ages))
    exact_mean = seconds(asked.cast("decimal(38,0)") - F.col("source_sum") / F.col("source_count"))
    latencies = F.coalesce(F.col("latency_count"), F.lit(0))
    return placed.select(
        latencies.cast("long").alias("ingestion_latency_count"),
        F.when(latencies > 0, seconds(F.col("latency_sum")) / F.col("latency_count")).alias("ingestion_latency_avg"),
        *(
            F.when(latencies > 0, seconds(F.kll_sketch_get_quantile_bigint("latency_sketch", F.lit(p)))).alias(f"ingestion_latency_{name}")
            for name, p in POINTS.items()
        ),
        seconds(F.col("latency_max")).alias("ingestion_latency_max"),
        age_count.alias("event_age_count"),
        F.when(F.col("inside"), exact_mean).when(known, mean_of_ages).alias("event_age_avg"),
        *(age(p).alias(f"event_age_{name}") for name, p in POINTS.items()),
        F.when(F.col("inside"), seconds(asked - F.col("source_min"))).otherwise(F.array_max(ages)).alias("event_age_max"),
    )
