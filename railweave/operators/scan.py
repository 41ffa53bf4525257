"""Ordered running aggregates per key that do not put a whole key into one task.

A plain window such as ``avg(x) over (partition by route order by time)`` sorts every row of a
route in one task, so a few hundred routes give a few hundred tasks whatever the data size and
one hot route stalls the job. ``exclusive_scan`` cuts each key's rows into slices of the ordering
column, runs the window inside the slices, and adds what the earlier slices contribute from a
small per-slice table. Sums and "last value" combine exactly across slices, so the result equals
the plain window's.

A slice that still holds more than ``hot_rows`` rows is cut further, each level into at most
``FANOUT`` parts down to a single position, then into blocks of the tiebreak column.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
FANOUT = 4096
TIE_BLOCK = 1 << 20

HOUR_MICROS = 3_600_000_000
DAY_MICROS = 24 * HOUR_MICROS


@dataclass(frozen=True)
class Measure:
    """``kind`` is "sum" (numeric column) or "last" (struct column; a NULL struct is skipped)."""

    name: str
    kind: str
    column: str


def _start(value: Column, width: int) -> Column:
    return value - F.pmod(value, F.lit(width))


def _total(m: Measure, order: Column) -> Column:
    """Measure over a whole slice; needs no sort, so it is combined before the shuffle."""
    value = F.col(m.column)
    if m.kind == "sum":
        return F.sum(value)
    return F.max_by(value, F.when(value.isNotNull(), order))


def _before(m: Measure, column: str, window) -> Column:
    value = F.col(column)
    return (F.sum(value) if m.kind == "sum" else F.last(value, ignorenulls=True)).over(window)


def _combine(m: Measure, earlier: Column, later: Column) -> Column:
    if m.kind == "sum":
        return F.coalesce(earlier + later, earlier, later)
    return F.coalesce(later, earlier)


def _carry(totals: DataFrame, keys: list[str], levels: list[str], measures) -> DataFrame:
    """Adds ``_carry_<name>`` per slice: the measure over all earlier slices of the key."""
    head, rest = levels[0], levels[1:]
    window = (
        Window.partitionBy(*keys).orderBy(head).rowsBetween(Window.unboundedPreceding, -1)
    )
    if not rest:
        return totals.select(
            "*", *(_before(m, f"_total_{m.name}", window).alias(f"_carry_{m.name}") for m in measures)
        )
    order = F.struct(*rest)
    coarse = totals.groupBy(*keys, head).agg(
        *(_total(Measure(m.name, m.kind, f"_total_{m.name}"), order).alias(f"_sum_{m.name}")
          for m in measures)
    )
    coarse = coarse.select(
        *keys,
        head,
        *(_before(m, f"_sum_{m.name}", window).alias(f"_outer_{m.name}") for m in measures),
    )
    inner = _carry(totals, [*keys, head], rest, measures).join(coarse, [*keys, head])
    return inner.withColumns(
        {
            f"_carry_{m.name}": _combine(m, F.col(f"_outer_{m.name}"), F.col(f"_carry_{m.name}"))
            for m in measures
        }
    ).drop(*(f"_outer_{m.name}" for m in measures))


def large_keys(df: DataFrame, keys: dict[str, list[str]], limit: int) -> set[str]:
    """Names of the key sets of which some value holds more than ``limit`` rows, in one job."""
    found = [
        df.groupBy(*columns).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit)
        .select(F.lit(name).alias("name")).limit(1)
        for name, columns in keys.items()
    ]
    return {row.name for row in reduce(DataFrame.unionByName, found).collect()}


def _cut_hot_slices(
    rows: DataFrame,
    keys: list[str],
    position: str,
    tiebreak: str | None,
    width: int,
    hot_rows: int | None,
) -> tuple[DataFrame, list[str]]:
    if hot_rows is None:
        return rows, ["_slice"]
    sizes = rows.groupBy(*keys, "_slice").agg(F.count("*").alias("_rows"))
    hot = sizes.filter(F.col("_rows") > hot_rows).select(*keys, "_slice", F.lit(True).alias("_hot"))
    if hot.isEmpty():
        return rows, ["_slice"]
    # No hint: with hot slices this few AQE broadcasts them, and stays correct if it cannot.
    rows = rows.join(hot, [*keys, "_slice"], "left")
    levels, columns = ["_slice"], {}
    while width > 1:
        width = max(width // FANOUT, 1)
        name = f"_slice{len(levels)}"
        columns[name] = F.when(F.col("_hot"), _start(F.col(position), width)).otherwise(0)
        levels.append(name)
    if tiebreak:
        columns["_block"] = F.when(F.col("_hot"), _start(F.col(tiebreak), TIE_BLOCK)).otherwise(0)
        levels.append("_block")
    return rows.withColumns(columns).drop("_hot"), levels


def exclusive_scan(
    rows: DataFrame,
    keys: list[str],
    position: str,
    measures: list[Measure],
    *,
    tiebreak: str | None = None,
    slice_width: int = HOUR_MICROS,
    hot_rows: int | None = HOT_ROWS,
    sliced: bool | None = None,
) -> DataFrame:
    """Adds one column per measure, computed over the rows of the same key that come earlier.

    ``position`` (BIGINT) orders the rows; ``tiebreak`` (BIGINT) orders rows at one position and
    must make them distinct. ``keys`` must not be NULL. ``rows`` is read more than once and
    should be a table or cheap to recompute. While no key holds more than ``hot_rows`` rows, one
    plain window does it; a caller that knows whether slices are needed passes ``sliced`` and
    saves that check. ``hot_rows=None`` always slices and skips both checks, for callers whose
    ``slice_width`` alone bounds a slice.
    """
    order_by = [position] + ([tiebreak] if tiebreak else [])
    if sliced is None:
        sliced = hot_rows is None or bool(large_keys(rows, {"rows": keys}, hot_rows))
    if not sliced:
        window = (
            Window.partitionBy(*keys).orderBy(*order_by)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return rows.select("*", *(_before(m, m.column, window).alias(m.name) for m in measures))

    cut = rows.withColumn("_slice", _start(F.col(position), slice_width))
    cut, levels = _cut_hot_slices(cut, keys, position, tiebreak, slice_width, hot_rows)
    group = [*keys, *levels]
    totals = cut.groupBy(*group).agg(
        *(_total(m, F.struct(*order_by)).alias(f"_total_{m.name}") for m in measures)
    )
    carried = _carry(totals, keys, levels, measures).select(
        *group, *(f"_carry_{m.name}" for m in measures)
    )
    window = (
        Window.partitionBy(*group).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = cut.select(
        "*", *(_before(m, m.column, window).alias(f"_in_{m.name}") for m in measures)
    )
    joined = inside.join(carried, group)
    return joined.select(
        *rows.columns,
        *(_combine(m, F.col(f"_carry_{m.name}"), F.col(f"_in_{m.name}")).alias(m.name)
          for m in measures),
    )
