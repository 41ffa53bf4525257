"""Idempotent inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys of a micro-batch that may be broadcast to the table scan.
BROADCAST_KEYS = 200_000


def _without_null(keys: list[str]) -> Column:
    return reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))


def first_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key, for rows whose key has no NULL."""
    row = F.struct(*batch.columns)
    # A minimum is combined before the shuffle, so many copies of one key stay cheap.
    return (
        batch.filter(_without_null(keys))
        .groupBy(*keys)
        .agg(F.min_by(row, F.struct(*order)).alias("_row"))
        .select("_row.*")
    )


def insert_new(
    target: DataFrame | None, batch: DataFrame, keys: list[str], order: list[str],
    shared: list[str] | None = None, batch_rows: int | None = None,
) -> DataFrame:
    """Rows of ``batch`` whose key is new, once each; a key with a NULL equals no other.

    The target may be any size. A batch known to be small (``batch_rows``) sends its keys to
    where the target is read, so the target is neither shuffled nor read beyond its key columns.
    ``shared`` names columns that two rows with one key always share, such as the date an event
    id was derived from: when the target is partitioned by them, other partitions are skipped.
    """
    fresh = first_per_key(batch, keys, order)
    if target is not None:
        fresh = fresh.join(_present(target, batch, keys, shared or [], batch_rows), keys, "left_anti")
    return fresh.unionByName(batch.filter(~_without_null(keys)))


def _present(
    target: DataFrame, batch: DataFrame, keys: list[str], shared: list[str], batch_rows: int | None
) -> DataFrame:
    """Keys of the target that may occur in the batch."""
    columns = [*keys, *shared]
    present = target.select(*columns)
    if batch_rows is not None and batch_rows <= BROADCAST_KEYS:
        wanted = batch.filter(_without_null(keys)).select(*columns).distinct()
        same = [present[c] == wanted[c] for c in keys]
        same += [present[c].eqNullSafe(wanted[c]) for c in shared]
        present = present.join(F.broadcast(wanted), reduce(Column.__and__, same), "left_semi")
    return present.select(*keys)
