"""Profile of the training mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.operators.percentiles import distributions_of
from railweave.session import materialize

PROFILED_FEATURES = [
    "previous_observed_delay_sec",
    "historical_route_delay_sec",
    "historical_stop_delay_sec",
    "scheduled_travel_time_to_next_stop_sec",
    "speed",
    "occupancy_status",
]


DISTINCT = {"distinct_vehicles": "vehicle_id", "distinct_trips": "trip_id", "routes": "route_id"}
TARGET = "target_delay_4_stops_sec"


def profile_histogram(training: DataFrame) -> DataFrame:
    """(measure, text, value, copies, first, last): how often each key and each label occurs, from one scan. Keys have a
    text, labels a value; every row enters once for each measure and is combined before the shuffle."""
    measures = F.array(
        *(
            F.struct(F.lit(name).alias("measure"), F.col(c).alias("text"), F.lit(None).cast("long").alias("value"))
            for name, c in DISTINCT.items()
        ),
        F.struct(F.lit(TARGET).alias("measure"), F.lit(None).cast("string").alias("text"), F.col(TARGET).cast("long").alias("value")),
    )
    rows = training.select(F.explode(measures).alias("m"), "prediction_timestamp").select("m.*", "prediction_timestamp")
    return rows.groupBy("measure", "text", "value").agg(
        F.count("*").alias("copies"),
        F.min("prediction_timestamp").alias("first"),
        F.max("prediction_timestamp").alias("last"),
    )


def training_profile(training: DataFrame, features: DataFrame) -> DataFrame:
    """(metric, value) rows: size, coverage, share of labelled rows and the label's spread. Each table is scanned once."""
    def text(value: Column) -> Column:
        return value.cast("string")

    histogram = materialize(profile_histogram(training), "profile")
    of_target = F.col("measure") == TARGET

    def distinct(name: str) -> Column:
        return text(F.count_if((F.col("measure") == name) & F.col("text").isNotNull())).alias(name)

    rows = histogram.agg(
        text(F.coalesce(F.sum(F.when(of_target, F.col("copies"))), F.lit(0))).alias("training_rows"),
        *(distinct(name) for name in DISTINCT),
        F.concat(text(F.min("first")), F.lit(" to "), text(F.max("last"))).alias("time_coverage"),
    )
    labels = histogram.filter(of_target & F.col("value").isNotNull()).select("measure", "value", "copies")
    spread = distributions_of(labels, [TARGET], {"p50": 0.5, "p95": 0.95}).select(
        F.concat_ws(
            ", ",
            text(F.col(f"{TARGET}_min")),
            text(F.rint(f"{TARGET}_p50").cast("long")),
            F.format_string("%.2f", F.round(f"{TARGET}_avg", 2)),
            text(F.rint(f"{TARGET}_p95").cast("long")),
            text(F.col(f"{TARGET}_max")),
        ).alias("target_delay_min_p50_avg_p95_max")
    )
    labelled = 100.0 * F.avg(F.col("has_target_delay_4_stops").cast("int"))
    population = features.agg(
        text(F.count("*")).alias("eligible_feature_rows"),
        F.format_string("%.2f", F.round(labelled, 2)).alias("valid_4_stop_target_pct"),
    )

    def as_rows(df: DataFrame) -> DataFrame:
        return df.unpivot([], df.columns, "metric", "value")

    return as_rows(rows).unionByName(as_rows(spread)).unionByName(as_rows(population))


def null_percentages(df: DataFrame, columns: list[str] = PROFILED_FEATURES) -> DataFrame:
    """(feature, missing_pct) with two decimals, in one pass."""
    shares = df.agg(
        *(F.round(100.0 * F.avg(F.col(c).isNull().cast("int")), 2).alias(c) for c in columns)
    )
    return shares.unpivot([], columns, "feature", "missing_pct")
