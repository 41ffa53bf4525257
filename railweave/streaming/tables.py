"""The three tables a stream writes, and their upkeep.

Rows lie in folders by date and then by batch; positions are first divided by whether their id was made
from the record itself. A batch looks only into the folders that can hold its ids, so the work per batch
follows the dates it touches and not the number of batches so far. ``compact`` joins the batches
of a date into one folder, ``expire`` removes what outlived its retention. A joined folder of the
batches below n is named ``~(n - 1)``, a negative number, so that it stands beside the batches it
holds until they are dropped. One writer per root is assumed; upkeep runs in it, between batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railweave.operators.retention import METRIC_DAYS, POSITION_DAYS, expired, kept
from railweave.schemas import DEAD_LETTER_SCHEMA, METRIC_SCHEMA, POSITION_SCHEMA
from railweave.session import delete_folder, file_system, subfolders
from railweave.sinks.archive import ArchiveMismatch, archive_jsonl
from railweave.sinks.published import NO_PART

# Ids of one batch start at batch_id * BATCH_IDS, so a later batch always has higher ids and
# assigning them needs no look at the stored table.
BATCH_IDS = 1 << 32

POSITIONS, DEAD_LETTERS, METRICS = "positions", "dead_letters", "metrics"
SCHEMAS = {POSITIONS: POSITION_SCHEMA, DEAD_LETTERS: DEAD_LETTER_SCHEMA, METRICS: METRIC_SCHEMA}
BATCH = T.StructField("batch_id", T.LongType())
DAY = T.StructField("day", T.DateType())
# Whether the event id is the one that its record gives, and the date of the feed time that is in it.
NAMED, FEED_DATE = T.StructField("named", T.BooleanType()), T.StructField("feed_date", T.DateType())
PARTS = {POSITIONS: [NAMED, FEED_DATE, BATCH], DEAD_LETTERS: [DAY, BATCH], METRICS: [DAY, BATCH]}
IDS = {POSITIONS: "id", DEAD_LETTERS: "dead_letter_id", METRICS: "metric_id"}
TIMES = {POSITIONS: "ingested_at", DEAD_LETTERS: "processed_at", METRICS: "metric_timestamp"}


@dataclass(frozen=True)
class StreamTables:
    """Folders of the tables below ``root``."""

    root: str

    def folder(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _reader(self, spark: SparkSession, table: str):
        stored = T.StructType([*SCHEMAS[table].fields, *PARTS[table]])
        return spark.read.schema(stored).option("basePath", self.folder(table))

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        """All stored rows with their partition columns; None before the first batch."""
        try:
            return self._reader(spark, table).parquet(self.folder(table))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def read_folders(self, spark: SparkSession, table: str, folders: list[str]) -> DataFrame | None:
        """Rows of some folders, given relative to the table; those that do not exist are left out."""
        system, make = file_system(spark, self.root)
        paths = [f"{self.folder(table)}/{name}" for name in folders]
        there = [path for path in paths if system.exists(make(path))]
        return self._reader(spark, table).parquet(*there) if there else None

    def lookup(self, spark: SparkSession, dates: set[date | None], everywhere: bool) -> DataFrame | None:
        """Stored positions that can share an id with positions of the given feed dates.

        An id made from its record names its feed time, so it lies under that date or among the ids
        made otherwise. With ``everywhere`` there are ids made otherwise to look up, which may lie
        anywhere.
        """
        if everywhere:
            return self.read(spark, POSITIONS)
        days = [NO_PART if day is None else day.isoformat() for day in dates]
        folders = [f"{NAMED.name}=true/{FEED_DATE.name}={day}" for day in sorted(days)]
        return self.read_folders(spark, POSITIONS, [*folders, f"{NAMED.name}=false"])

    def _parents(self, spark: SparkSession, table: str) -> list[str]:
        """Folders that hold the batches of one date, relative to the table."""
        parents = [""]
        for part in PARTS[table][:-1]:
            parents = [
                f"{parent}{name}/"
                for parent in parents
                for name in subfolders(spark, f"{self.folder(table)}/{parent}")
                if name.startswith(f"{part.name}=")
            ]
        return parents

    def _batch_folders(self, spark: SparkSession, table: str, batch_id: int) -> list[str]:
        """A batch's folders, which are asked for by name: no date's batches are listed."""
        system, make = file_system(spark, self.root)
        names = [f"{parent}{BATCH.name}={batch_id}" for parent in self._parents(spark, table)]
        return [name for name in names if system.exists(make(f"{self.folder(table)}/{name}"))]

    @contextmanager
    def staged(self, rows: DataFrame, batch_id: int) -> Iterator[DataFrame]:
        """Rows of a batch in work, written once beside the tables: every reader takes only the columns it needs.

        The folder goes with the batch; what a failed attempt left is replaced by the next one.
        """
        spark, path = rows.sparkSession, f"{self.root.rstrip('/')}/_staged-{batch_id}"
        rows.write.mode("overwrite").parquet(path)
        try:
            yield spark.read.schema(rows.schema).parquet(path)
        finally:
            delete_folder(spark, path)

    def write_batch(self, rows: DataFrame, table: str, batch_id: int) -> int:
        """Write the rows of one batch in place of what an earlier attempt of it left; returns how many."""
        spark, names = rows.sparkSession, [part.name for part in PARTS[table]]
        for folder in self._batch_folders(spark, table, batch_id):
            delete_folder(spark, f"{self.folder(table)}/{folder}")
        of_batch = rows.withColumn(BATCH.name, F.lit(batch_id).cast("long"))
        # Few files per date, and several for a date too large for one task. The write counts what it writes.
        written = Observation()
        counted = of_batch.hint("rebalance", *names).observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("append").partitionBy(*names).parquet(self.folder(table))
        return written.get["rows"]

    def newest_positions(self, spark: SparkSession, rows: int) -> DataFrame | None:
        """The batches that hold at least the newest ``rows`` positions (all, if there are fewer).

        The metric rows say how many positions each batch added, so the batches are chosen from
        that small table and older folders are skipped by partition.
        """
        stored, metrics = self.read(spark, POSITIONS), self.read(spark, METRICS)
        if stored is None or metrics is None:
            return stored
        # Every batch listed adds a row or more, so this many are enough.
        batch = F.expr("metric_id div 2").alias("batch")
        added = metrics.filter("events_persisted > 0").select(batch, "events_persisted")
        last = added.orderBy(F.col("batch").desc()).limit(rows)
        newer = Window.orderBy(F.col("batch").desc()).rowsBetween(Window.unboundedPreceding, -1)
        needed = last.withColumn("newer", F.coalesce(F.sum("events_persisted").over(newer), F.lit(0)))
        first = needed.filter(F.col("newer") < rows).agg(F.min("batch")).first()[0]
        if first is None:
            return stored
        # A joined folder reaches up to the batch in its name; the ids tell its batches apart.
        reach = F.when(F.col(BATCH.name) < 0, F.bitwise_not(BATCH.name)).otherwise(F.col(BATCH.name))
        return stored.filter((reach >= first) & (F.col("id") > first * BATCH_IDS))

    # Upkeep

    def compact(self, spark: SparkSession, table: str, before: int, least: int = 2) -> int:
        """Join the batches below ``before`` of every date that has ``least`` or more of them.

        ``before`` must not pass the newest batch, which a restart may write again. Returns the
        number of folders that were joined.
        """
        folders = {}
        for parent in self._parents(spark, table):
            batches = self._batches(spark, table, parent, before)
            if len(batches) >= least:
                folders[parent] = batches
        return self._join(spark, table, folders, before)

    def _batches(self, spark: SparkSession, table: str, parent: str, before: int) -> list[int]:
        numbers = (int(n.split("=")[1]) for n in subfolders(spark, f"{self.folder(table)}/{parent}") if "=" in n)
        return sorted(n for n in numbers if n < before)

    def expire(
        self, spark: SparkSession, table: str, now: datetime, days: int, archive: str | None, before: int
    ) -> int:
        """Archive and remove rows of batches below ``before`` that are older than ``days``; returns how many.

        Rows go only after the archive was read back. Rows without a time are kept.
        """
        stored = self.read(spark, table)
        if stored is None:
            return 0
        column = TIMES[table]
        old = expired(stored.filter(F.col(BATCH.name) < before), column, now, days).dropDuplicates([IDS[table]])
        divided = [part.name for part in PARTS[table][:-1]]
        # One row per date with something to remove.
        reached = old.groupBy(*divided).agg(F.count("*").alias("n")).collect()
        removed = sum(row.n for row in reached)
        if not removed:
            return 0
        if archive is not None:
            _, found, _ = archive_jsonl(old.select(*SCHEMAS[table].names), f"{archive}/{table}")
            if found != removed:
                raise ArchiveMismatch(f"{table}: archived {found} rows of {removed}")
        parents = (self._parent(table, row[:-1]) for row in reached)
        folders = {parent: self._batches(spark, table, parent, before) for parent in parents}
        self._join(spark, table, folders, before, lambda rows: kept(rows, column, now, days))
        return removed

    def _join(self, spark: SparkSession, table: str, folders: dict[str, list[int]], before: int, choose=None) -> int:
        """Write the chosen rows of the given batches once more, in one folder per date, then drop the batches.

        Until the last batch is dropped rows can lie in both places, never in none. A run after a
        failure finds them there and takes each once.
        """
        paths = [f"{parent}{BATCH.name}={n}" for parent, batches in folders.items() for n in batches]
        if not paths:
            return 0
        rows = self.read_folders(spark, table, paths)
        rows = rows if choose is None else choose(rows)
        names = [part.name for part in PARTS[table]]
        # A date of which nothing is chosen gets no folder.
        filled = {self._parent(table, row) for row in rows.select(*names[:-1]).distinct().collect()}
        joined = ~(before - 1)
        one = rows.dropDuplicates([IDS[table]]).withColumn(BATCH.name, F.lit(joined).cast("long"))
        write = one.hint("rebalance", *names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write.partitionBy(*names).parquet(self.folder(table))
        for parent, batches in folders.items():
            for batch in batches:
                if batch != joined or parent not in filled:
                    delete_folder(spark, f"{self.folder(table)}/{parent}{BATCH.name}={batch}")
        return len(paths)

    def _parent(self, table: str, values: Sequence) -> str:
        """The folder of one date, relative to the table."""
        texts = (NO_PART if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in values)
        return "".join(f"{part.name}={text}/" for part, text in zip(PARTS[table][:-1], texts))


def stream_retention(
    spark: SparkSession, tables: StreamTables, archive: str, now: datetime, before: int
) -> dict[str, int]:
    """One clean-up of what a stream wrote, up to the batches below ``before``; metrics are removed without an archive."""
    days = {POSITIONS: POSITION_DAYS, DEAD_LETTERS: METRIC_DAYS, METRICS: METRIC_DAYS}
    removed = {}
    for table, limit in days.items():
        target = None if table == METRICS else archive
        removed[table] = tables.expire(spark, table, now, limit, target, before)
    return {"positions_deleted": removed[POSITIONS], "metrics_deleted": removed[METRICS]}
