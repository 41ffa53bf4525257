"""Exact interpolated percentiles of an integer column without gathering the column in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.operators.scan import Measure, exclusive_scan

SLICE_VALUES = 1024


def exact_percentiles(df: DataFrame, column: str, points: dict[str, float]) -> DataFrame:
    """One row with a column per named point, interpolated as ``percentile_cont`` does.

    Rows are first reduced to one count per distinct value; the ranks then come from a sliced
    running sum over the values, and only the values at the wanted ranks are kept.
    """
    histogram = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("long").alias("value"))
        .agg(F.count("*").alias("copies"))
        .withColumn("all_rows", F.lit(1))
    )
    # Values are distinct here, so a slice holds at most SLICE_VALUES rows: no size check needed.
    ranked = exclusive_scan(
        histogram,
        ["all_rows"],
        "value",
        [Measure("earlier", "sum", "copies")],
        slice_width=SLICE_VALUES,
        hot_rows=None,
    )
    total = histogram.agg(F.sum("copies")).scalar()
    start = F.coalesce("earlier", F.lit(0))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= start) & (rank < start + F.col("copies")), F.col("value")))

    def interpolated(p: float) -> Column:
        rank = F.lit(p) * (F.col("total") - 1)
        low, high = value_at(F.floor(rank)), value_at(F.ceil(rank))
        return low + (high - low) * F.max(rank - F.floor(rank))

    return ranked.withColumn("total", total).agg(
        *(interpolated(p).alias(name) for name, p in points.items())
    )


def distributions(df: DataFrame, columns: list[str], points: dict[str, float]) -> DataFrame:
    """One row with ``<column>_count``, ``_avg``, ``_min``, ``_max`` and ``_<point>`` of every integer column, in its own unit.

    One histogram by column and value holds it all: counts, means and maxima follow from it as the percentiles do, so
    ``df`` is scanned once and its rows are combined once, however many columns there are.
    """
    measures = F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("value")) for c in columns))
    histogram = (
        df.select(F.explode(measures).alias("m")).select("m.measure", "m.value").filter("value is not null")
        .groupBy("measure", "value").agg(F.count("*").alias("copies"))
    )
    return distributions_of(histogram, columns, points)


def distributions_of(histogram: DataFrame, columns: list[str], points: dict[str, float]) -> DataFrame:
    """``distributions`` from a histogram (measure, value, copies) whose measures are ``columns``."""
    ranked = exclusive_scan(
        histogram, ["measure"], "value", [Measure("earlier", "sum", "copies")],
        slice_width=SLICE_VALUES, hot_rows=None,
    )
    exact = F.col("value").cast("decimal(38,0)") * F.col("copies").cast("decimal(38,0)")
    totals = histogram.groupBy("measure").agg(
        F.sum("copies").alias("total"), F.sum(exact).alias("sum"), F.min("value").alias("least"), F.max("value").alias("most")
    )
    start = F.coalesce("earlier", F.lit(0))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= start) & (rank < start + F.col("copies")), F.col("value")))

    def interpolated(p: float) -> Column:
        rank = F.lit(p) * (F.col("total") - 1)
        low, high = value_at(F.floor(rank)), value_at(F.ceil(rank))
        return low + (high - low) * F.max(rank - F.floor(rank))

    # A row per column, so the totals are small by construction.
    found = ranked.join(F.broadcast(totals), "measure").groupBy("measure").agg(
        F.max("total").alias("count"),
        (F.max("sum").cast("double") / F.max("total")).alias("avg"),
        F.max("least").alias("min"),
        F.max("most").alias("max"),
        *(interpolated(p).alias(name) for name, p in points.items()),
    )

    def of(column: str, what: str) -> Column:
        value = F.max(F.when(F.col("measure") == column, F.col(what)))
        return (F.coalesce(value, F.lit(0)) if what == "count" else value).alias(f"{column}_{what}")

    return found.agg(*(of(c, what) for c in columns for what in ("count", "avg", "min", *points, "max")))
