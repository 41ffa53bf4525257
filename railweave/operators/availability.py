"""Sums over rows that are earlier in one order and not later in another, per key.

What a prediction may know of history is what happened before it *and* had arrived by then: two orders, so no single running sum
gives it. Rows are numbered by the first order, and every pair of numbers is told apart at one binary digit, the highest in
which they differ. At each digit the rows of a key fall into blocks with equal higher digits; a row with a one there takes from its own
block the rows with a zero that come no later in the second order, which is a running sum by the second order. Over all digits every earlier row is taken
exactly once, so n rows cost n times their digits, without pairs.

The digits above ``LEAF_DIGITS`` are ordered scans, which cut hot keys into slices. Below that a block is small; whole blocks are
dealt out over tasks and summed in numpy.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.operators.scan import HOT_ROWS, HOUR_MICROS, Measure, exclusive_scan
from railweave.session import materialize

# Executors need not have the package: the functions they run travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF_DIGITS = 13
#: Added to the second order's tiebreak of rows that take, so that they come after rows with an equal value.
_LATER = 1 << 62


def leaf_sums(group: np.ndarray, number: np.ndarray, arrived: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Per row the sums of ``values`` over rows of its group with a smaller ``number`` that arrived no later."""
    sums = [np.zeros(len(number), dtype=np.int64) for _ in values]
    for digit in range(int(number.max(initial=0)).bit_length()):
        taking = (number >> digit) & 1
        block = number >> (digit + 1)
        order = np.lexsort((taking, arrived, block, group))
        own_group, own_block, takes = group[order], block[order], taking[order] == 1
        begins = np.concatenate([[True], (np.diff(own_group) != 0) | (np.diff(own_block) != 0)])
        first = np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
        for total, value in zip(sums, values):
            given = np.where(takes, 0, value[order])
            running = np.cumsum(given)
            before_block = running[first] - given[first]
            total[order[takes]] += (running - before_block)[takes]
    return sums


def _leaf(frame: pd.DataFrame) -> pd.DataFrame:
    # Rows without a delay give nothing; blocks of one key with different higher digits are different groups.
    group = pd.MultiIndex.from_frame(frame[["has_key", "key", "leaf"]]).factorize()[0]
    number = frame.number.to_numpy() & ((1 << LEAF_DIGITS) - 1)
    delay, known = frame.delay.fillna(0).to_numpy(dtype=np.int64), frame.known.to_numpy()
    total, count = leaf_sums(group, number, frame.arrived.to_numpy(), [delay, known])
    return pd.DataFrame({"row_id": frame.row_id, "delay_sum": total, "delay_count": count})


def available_delay(
    current: DataFrame, key: str, name: str, slice_width: int = HOUR_MICROS,
    hot_rows: int = HOT_ROWS, sliced: bool | None = None, availability: str = "ingested_at",
) -> DataFrame:
    """Mean delay over observations with the same ``key`` that are earlier by event time and had arrived when the row itself
    arrived, per ``row_id``. Rows that never arrived, with NULL there, neither give nor take."""
    at = F.unix_micros("event_timestamp")
    rows = current.filter(F.col(availability).isNotNull()).select(
        "row_id", "observation_id", at.alias("at"), F.unix_micros(availability).alias("arrived"),
        F.col(key).isNotNull().alias("has_key"),
        F.coalesce(F.col(key), F.lit("")).alias("key"),
        F.col("current_delay_sec").cast("long").alias("delay"),
        F.col("current_delay_sec").isNotNull().cast("long").alias("known"),
        F.lit(1).cast("long").alias("one"),
    )
    numbered = exclusive_scan(
        rows, ["has_key", "key"], "at", [Measure("earlier", "sum", "one")],
        tiebreak="observation_id", slice_width=slice_width, hot_rows=hot_rows, sliced=sliced,
    )
    number = F.coalesce("earlier", F.lit(0)).alias("number")
    numbered = materialize(
        numbered.select("row_id", "has_key", "key", number, "arrived", "delay", "known"), "numbered"
    )
    size = numbered.agg(F.max("number").alias("last"), F.count("*").alias("rows")).first()

    block = 1 << LEAF_DIGITS
    leaf = F.shiftright("number", LEAF_DIGITS)
    task = F.pmod(F.xxhash64("has_key", "key", "leaf"), F.lit(1 + size.rows // block))
    parts = [
        numbered.withColumn("leaf", leaf).groupBy(task.alias("task"))
        .applyInPandas(_leaf, "row_id long, delay_sum long, delay_count long")
    ]
    digits = range(LEAF_DIGITS, (size.last or 0).bit_length())
    if len(digits):
        last = numbered.groupBy("has_key", "key").agg(F.max("number").alias("last")).filter(F.col("last") >= block)
        wide = numbered.join(last, ["has_key", "key"])
        digit, taking = F.col("digit"), F.col("takes") == 1
        # A row that gives is of use if its block goes on to the numbers that take.
        spread = wide.select(
            "*", F.explode(F.sequence(F.lit(digits[0]), F.lit(digits[-1]))).alias("digit")
        ).select(
            "row_id", "has_key", "key", "digit", "number", "arrived", "delay", "known", "last",
            F.expr("shiftright(number, digit + 1)").alias("block"),
            F.expr("shiftright(number, digit) & 1L").alias("takes"),
        )
        useful = taking | (F.expr("shiftleft(shiftright(number, digit) | 1L, digit)") <= F.col("last"))
        given = spread.filter(useful).select(
            "row_id", "has_key", "key", digit, "block", "takes", "arrived",
            F.when(taking, F.col("number") + _LATER).otherwise(F.col("number")).alias("place"),
            F.when(~taking, F.col("delay")).alias("delay"),
            F.when(~taking, F.col("known")).otherwise(0).alias("known"),
        )
        scanned = exclusive_scan(
            given, ["has_key", "key", "digit", "block"], "arrived",
            [Measure("delay_sum", "sum", "delay"), Measure("delay_count", "sum", "known")],
            tiebreak="place", slice_width=slice_width, hot_rows=hot_rows, sliced=sliced,
        )
        parts.append(scanned.filter("takes = 1").select("row_id", "delay_sum", "delay_count"))
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    sums = every.groupBy("row_id").agg(F.sum("delay_sum").alias("total"), F.sum("delay_count").alias("count"))
    return sums.select("row_id", F.try_divide("total", "count").alias(name))
