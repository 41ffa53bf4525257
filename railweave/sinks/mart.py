"""The stored forms of the incremental tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from railweave.operators.carried import TOTALS_SCHEMA, Carried, merged_totals, scan_totals, slice_start
from railweave.operators.features import (
    delay_features,
    matched_features,
    schedule_features,
    training_projection,
)
from railweave.operators.incremental import LOOKBACK_HOURS, delete_insert, new_observations
from railweave.operators.scan import HOT_ROWS
from railweave.operators.staging import stg_positions, stg_stop_times
from railweave.session import materialize
from railweave.sinks.published import (
    Entry,
    current_version,
    publish,
    read_entries,
    write_folder,
    write_parts,
)

TRAINING, TOTALS = "ml_delay_training", "delay_totals"
# Where the folded part of the totals ends while nothing is folded.
EVER = "0001-01-01"
KEY, TIME = "observation_id", "prediction_timestamp"


def append_staging(spark: SparkSession, positions: DataFrame, path: str) -> int:
    """Append the staged form of positions the table does not hold yet; returns how many."""
    schema = stg_positions(positions.limit(0)).schema
    try:
        staged = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        staged = None
    written = Observation()
    fresh = new_observations(positions, staged).observe(written, F.count(F.lit(1)).alias("rows"))
    fresh.write.mode("append").parquet(path)
    return written.get["rows"]


def _lookback_start(spark: SparkSession, entries: list[Entry], hours: int) -> datetime | None:
    """``hours`` before the newest prediction of the mart; None while it is empty."""
    filled = [e for e in entries if e.table_name == TRAINING and e.row_count]
    if not filled:
        return None
    # The newest prediction lies in the newest date, so only that one is read for it.
    newest_part = max(e.part for e in filled)
    newest = read_entries(spark, [e for e in filled if e.part == newest_part])
    return newest.agg(F.max(TIME)).first()[0] - timedelta(hours=hours)


def _publish_training(
    spark: SparkSession, recent: DataFrame, root: str, entries: list[Entry], more: list[Entry]
) -> int:
    """Put recomputed rows in their place and publish them with ``more``, which replaces what has its table's name.

    The mart is divided by prediction date. Only dates of recomputed rows, and older ones that
    hold a recomputed key, are read whole and written again; the rest is carried over by name.
    """
    parts = [e for e in entries if e.table_name == TRAINING]
    dated = materialize(recent.withColumn("_date", F.to_date(TIME)), "training")

    touched = {row[0].isoformat() for row in dated.select("_date").distinct().collect()}
    others = [e for e in parts if e.part not in touched]
    elsewhere = read_entries(spark, others)
    if elsewhere is not None:
        moved = elsewhere.join(dated.select(KEY), KEY, "left_semi").select("_date").distinct()
        touched |= {row[0].isoformat() for row in moved.collect()}

    old = read_entries(spark, [e for e in parts if e.part in touched])
    merged = dated if old is None else delete_insert(old, dated, KEY)
    renewed = {e.table_name for e in more}
    kept = [
        e for e in entries
        if e.table_name not in renewed and (e.table_name != TRAINING or e.part not in touched)
    ]
    publish(spark, root, kept + write_parts(merged, root, TRAINING, "_date") + more)
    return dated.count()


def refresh_training(
    spark: SparkSession, training: DataFrame, root: str, hours: int = LOOKBACK_HOURS
) -> int:
    """Bring the published training mart up to date from rows computed over all history; returns
    the rows recomputed. ``extend_training`` does without the history."""
    _, entries = current_version(spark, root)
    start = _lookback_start(spark, entries, hours)
    recent = training if start is None else training.filter(F.col(TIME) >= F.lit(start))
    return _publish_training(spark, recent, root, entries, [])


def extend_training(
    spark: SparkSession, staged: DataFrame, stop_times: DataFrame, root: str,
    hours: int = LOOKBACK_HOURS, hot_rows: int = HOT_ROWS,
) -> int:
    """Bring the published training mart up to date from the staged observations; returns the rows recomputed.

    Of ``staged`` a run reads the observations with ids it has not seen, for their totals, and those of the
    lookback, for their features. All older ones are represented by the totals that lie beside the
    mart and are published with it. Only a lookback that begins before the folded totals end reads
    all history once more. Delays of old observations stay as the schedule of their run gave them.
    """
    _, entries = current_version(spark, root)
    stored = [e for e in entries if e.table_name == TOTALS]
    start = _lookback_start(spark, entries, hours)
    begin = None if start is None else slice_start(start)
    if begin is not None and any(e.part > begin.isoformat() for e in stored):
        begin = None
    known = read_entries(spark, stored, TOTALS_SCHEMA)
    seen = None if known is None else known.agg(F.max("through_id")).first()[0]
    everything = F.lit(True)
    fresh = everything if seen is None else F.col("observation_id") > seen
    looked_back = everything if begin is None else F.col("event_timestamp") >= F.lit(begin)
    # The schedule is joined once: to all that the totals or the features need.
    current = matched_features(staged.filter(fresh | looked_back), schedule_features(stg_stop_times(stop_times)))
    totals = scan_totals(current.filter(fresh))
    if known is not None:
        totals = merged_totals(known.unionByName(totals), begin)
    folder = write_folder(totals, root, TOTALS)
    ends = max([e.part for e in stored] + [EVER if begin is None else begin.isoformat()])
    folder = replace(folder, part=ends)

    carried = None
    if begin is not None:
        carried = Carried(read_entries(spark, [folder], TOTALS_SCHEMA), begin)
    features = delay_features(current.filter(looked_back), hot_rows, carried=carried)
    recent = training_projection(features)
    if start is not None:
        recent = recent.filter(F.col(TIME) >= F.lit(start))
    return _publish_training(spark, recent, root, entries, [folder])
