"""Schedule feeds as CSV tables."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables of a schedule feed.
REQUIRED_TABLES = ("agency", "routes", "stops", "trips", "stop_times")
CALENDAR_TABLES = ("calendar", "calendar_dates")
FEED_TABLES = REQUIRED_TABLES + CALENDAR_TABLES
# Tables with free text, whose quoted fields may hold line breaks. Such a file is read by one task, so
# the table of stop times, which is the large one, is not among them.
FREE_TEXT_TABLES = ("agency", "routes", "stops", "trips")
# Stands for an unquoted empty field, which is NULL; a quoted one is an empty text.
_ABSENT = "\u0000"


class InvalidFeed(ValueError):
    """The feed must not be activated."""


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first line, as written (the CSV reader would rename repeated ones)."""
    line = spark.read.text(path).limit(1).first()
    names = next(csv.reader([line.value.lstrip("\ufeff").rstrip("\r")]), []) if line else []
    if not names or len(set(names)) != len(names) or any(not name for name in names):
        raise InvalidFeed(f"Invalid CSV header: {path}")
    return names


def read_gtfs_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One table with every column as text; malformed lines and part files with another header raise on read.

    An empty field is NULL, a quoted empty field an empty text.
    """
    if name not in FEED_TABLES:
        raise InvalidFeed(f"Unsupported GTFS table: {name}")
    path = f"{directory.rstrip('/')}/{name}.txt"
    columns = header_columns(spark, path)
    schema = ", ".join(f"`{column}` STRING" for column in columns)
    return spark.read.schema(schema).csv(
        path, header=True, enforceSchema=False, escape='"', mode="FAILFAST", nullValue=_ABSENT,
        multiLine=name in FREE_TEXT_TABLES,
    )


def read_feed(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Every known table that the extracted feed folder holds; other files are ignored."""
    tables = {}
    for name in FEED_TABLES:
        try:
            tables[name] = read_gtfs_table(spark, directory, name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return tables


def check_feed_tables(names) -> None:
    unsupported = sorted(set(names) - set(FEED_TABLES))
    if unsupported:
        raise InvalidFeed(f"Unsupported GTFS table: {', '.join(unsupported)}")
    if not set(REQUIRED_TABLES) <= set(names):
        raise InvalidFeed("GTFS feed is missing required tables")
    if not set(CALENDAR_TABLES) & set(names):
        raise InvalidFeed("GTFS feed needs calendar or calendar_dates")


def validate_feed(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, check_name, ok): presence of every table, and rows in the required ones."""
    spark = next(iter(tables.values())).sparkSession
    calendar = any(name in tables for name in CALENDAR_TABLES)
    presence = [(name, "present", name in tables) for name in REQUIRED_TABLES]
    presence.append(("calendar", "calendar_or_dates_present", calendar))
    presence += [(name, "supported", False) for name in tables if name not in FEED_TABLES]
    report = spark.createDataFrame(presence, "table_name STRING, check_name STRING, ok BOOLEAN")
    for name in REQUIRED_TABLES:
        if name in tables:
            filled = tables[name].agg((F.count("*") > 0).alias("ok")).select(
                F.lit(name).alias("table_name"), F.lit("not_empty").alias("check_name"), "ok"
            )
            report = report.unionByName(filled)
    return report
