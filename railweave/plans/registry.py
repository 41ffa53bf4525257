"""Registration of the queries over the bundled tables, each with its SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railweave.plans.duckdb_views import with_views
from railweave.sources.shaped import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _plain(field: T.StructField) -> Column:
    """A column in the type both engines share: wide integers, six decimals, zoneless UTC times."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.TimestampType):
        column = column.cast("timestamp_ntz")
    elif isinstance(kind, T.IntegralType):
        column = column.cast("bigint")
    elif isinstance(kind, T.FractionalType):
        column = F.round(column.cast("double"), 6)
    elif isinstance(kind, T.ArrayType):
        column = F.array_join(F.transform(column, lambda x: x.cast("string")), ",")
    return column.alias(field.name)


def comparable(df: DataFrame) -> DataFrame:
    return df.select(*map(_plain, df.schema.fields))


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name``; ``sql`` is its equivalent for DuckDB."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return comparable(build(Tables(spark, data_dir)))

        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = with_views(sql.strip())
        return build

    return register
