"""Activation of a schedule feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railweave.sinks.published import Entry, current_version, publish, read_entries, write_folder
from railweave.sources.static_feed import CALENDAR_TABLES, InvalidFeed, check_feed_tables


def aligned(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """``new`` with every column ``old`` had: columns are added but never lost."""
    if old is None:
        return new
    missing = [c for c in old.columns if c not in new.columns]
    added = [c for c in new.columns if c not in old.columns]
    widened = new.withColumns({c: F.lit(None).cast("string") for c in missing})
    return widened.select(*old.columns, *added)


def activate_snapshot(
    spark: SparkSession, tables: dict[str, DataFrame], root: str,
    checksum: str | None = None, archive_path: str | None = None,
) -> dict[str, int]:
    """Replace all feed tables together and return their row counts.

    Everything is written and checked before the manifest names it. A feed that is incomplete,
    malformed or empty raises and leaves the active tables as they were.
    """
    check_feed_tables(tables)
    active = {entry.table_name: entry for entry in current_version(spark, root)[1]}

    def previous(name: str) -> DataFrame | None:
        return read_entries(spark, [active[name]]) if name in active else None

    entries: list[Entry] = []
    for name, table in tables.items():
        entry = write_folder(aligned(table, previous(name)), root, name)
        if not entry.row_count and name not in CALENDAR_TABLES:
            raise InvalidFeed(f"Empty required GTFS table: {name}")
        entries.append(entry)
    counts = {entry.table_name: entry.row_count for entry in entries}
    for name in CALENDAR_TABLES:
        if name in active and name not in tables:
            entries.append(write_folder(previous(name).limit(0), root, name))
    publish(spark, root, entries, checksum, archive_path)
    return counts


def load_manifest(tables: dict[str, DataFrame], checksum: str, archive_path: str) -> DataFrame:
    """The ledger row of a feed: checksum, archive path and row counts per table."""
    one_row = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    counts = one_row[0]
    for other in one_row[1:]:
        counts = counts.unionByName(other)
    return counts.agg(
        F.map_from_entries(F.collect_list(F.struct("table_name", "row_count"))).alias("row_counts")
    ).select(
        F.lit(checksum).alias("checksum_sha256"), F.lit(archive_path).alias("archive_path"),
        "row_counts",
    )
