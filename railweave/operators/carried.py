"""Delay features of new observations from stored totals of the old ones.

The features of an observation look back over all history: the last delay of its vehicle and trip, and the mean delays of its route
and its stop. Sums, counts and "last value" combine, so history can be kept as totals: one row per scan, key and slice of event
time. A run adds the totals of the observations it has not seen (by id, so late ones are included), folds the slices that no later
run can ask for into one row per key, and computes features from the observations of the lookback alone, with what the totals
say about the time before. The result is that of a run over all history.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.operators.scan import HOUR_MICROS

#: The slice that holds everything older than any lookback.
FOLDED = -(1 << 62)
KEYS = {
    "vehicle": ["vehicle_id", "trip_id"],
    "route": ["route_id"],
    "stop": ["scheduled_stop_id"],
}
TOTALS_SCHEMA = (
    "scan string, key array<string>, slice long, delay_sum long, delay_count long,"
    " last struct<at: bigint, observation_id: bigint, current_delay_sec: bigint>, through_id long"
)


def slice_start(moment: datetime) -> datetime:
    """Where the slice of ``moment`` begins."""
    micros = round((moment.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)) / timedelta(microseconds=1))
    return datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=micros - micros % HOUR_MICROS)


def _micros(moment: datetime) -> int:
    return round((moment - datetime(1970, 1, 1, tzinfo=UTC)) / timedelta(microseconds=1))


def scan_totals(current: DataFrame) -> DataFrame:
    """Totals of schedule-matched observations. Each row enters once per scan and is combined before the shuffle,
    so a hot key moves as one row per task and slice."""
    at = F.unix_micros("event_timestamp")
    scans = F.array(
        *(
            F.struct(F.lit(scan).alias("scan"), F.array(*(F.col(c) for c in columns)).alias("key"))
            for scan, columns in KEYS.items()
        )
    )
    delay = F.col("current_delay_sec").cast("long")
    rows = current.select(
        F.explode(scans).alias("s"),
        (at - F.pmod(at, F.lit(HOUR_MICROS))).alias("slice"),
        delay.alias("delay"),
        F.struct(at.alias("at"), "observation_id", delay.alias("current_delay_sec")).alias("last"),
    ).select("s.scan", "s.key", "slice", "delay", "last")
    return rows.groupBy("scan", "key", "slice").agg(
        F.sum("delay").alias("delay_sum"),
        F.count("delay").alias("delay_count"),
        F.max_by("last", F.struct("last.at", "last.observation_id")).alias("last"),
        F.max("last.observation_id").alias("through_id"),
    )


def merged_totals(totals: DataFrame, folded_before: datetime | None = None) -> DataFrame:
    """Totals of overlapping parts as one; slices before ``folded_before`` become one row per key."""
    if folded_before is not None:
        old = F.col("slice") < _micros(slice_start(folded_before))
        totals = totals.withColumn("slice", F.when(old, F.lit(FOLDED)).otherwise(F.col("slice")))
    return totals.groupBy("scan", "key", "slice").agg(
        F.sum("delay_sum").alias("delay_sum"),
        F.sum("delay_count").alias("delay_count"),
        F.max_by("last", F.struct("last.at", "last.observation_id")).alias("last"),
        F.max("through_id").alias("through_id"),
    )


@dataclass(frozen=True)
class Carried:
    """What all observations before ``start``, the beginning of a slice, amount to for each key."""

    totals: DataFrame
    start: datetime

    def of(self, scan: str) -> DataFrame:
        """The scan's key columns with carried_sum, carried_count and carried_last."""
        before = self.totals.filter((F.col("scan") == scan) & (F.col("slice") < _micros(self.start)))
        carried = before.groupBy("key").agg(
            F.sum("delay_sum").alias("carried_sum"),
            F.sum("delay_count").alias("carried_count"),
            F.max_by("last", F.struct("last.at", "last.observation_id")).alias("carried_last"),
        )
        keys = [F.get("key", F.lit(i)).alias(c) for i, c in enumerate(KEYS[scan])]
        return carried.select(*keys, "carried_sum", "carried_count", "carried_last")


def with_carried(rows: DataFrame, carried: Carried, scan: str) -> DataFrame:
    """``rows`` with what is carried for their key; NULL keys match each other."""
    renamed = carried.of(scan).withColumnsRenamed({c: f"own_{c}" for c in KEYS[scan]})
    matches = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in KEYS[scan]))
    return rows.join(renamed, matches, "left").drop(*(f"own_{c}" for c in KEYS[scan]))
