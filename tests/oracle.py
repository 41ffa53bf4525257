"""Compare every registered query with its SQL on DuckDB.

Run as a script: ``python tests/oracle.py [data_dir] [query ...]``.
"""

from __future__ import annotations

import datetime
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def open_duckdb(data_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{data_dir}/{table}.parquet')"
        )
    return connection


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.6f}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, datetime.date):
        return datetime.datetime(value.year, value.month, value.day)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(canonical(item) for item in value)
    return value if isinstance(value, str) else float(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(canonical(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def duckdb_rows(connection, sql: str):
    cursor = connection.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def difference(spark_result, duckdb_result) -> str | None:
    """What differs, or None."""
    (columns, rows), (sql_columns, sql_rows) = spark_result, duckdb_result
    if columns != sql_columns:
        return f"columns {columns} against {sql_columns}"
    if len(rows) != len(sql_rows):
        extra = [r for r in rows if r not in set(sql_rows)][:2]
        lost = [r for r in sql_rows if r not in set(rows)][:2]
        return f"{len(rows)} rows against {len(sql_rows)}; only Spark {extra}; only SQL {lost}"
    for left, right in zip(rows, sql_rows):
        if left != right:
            odd = [(c, a, b) for c, a, b in zip(columns, left, right) if a != b]
            return f"values {odd[:4]}"
    return None


def main() -> int:
    from railweave.session import build_session

    import __spark_entry__ as entry

    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-"),
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, checks, failed = open_duckdb(data_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            result = spark_rows(run(spark, data_dir))
            spark_seconds = time.time() - started
            problem = None
            if name in checks:
                problem = difference(result, duckdb_rows(connection, checks[name]))
            note = "ok" if name in checks else "rows only"
        except Exception as error:  # noqa: BLE001
            spark_seconds, note, result = time.time() - started, "", ([], [])
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {len(result[1]):7d} {spark_seconds:6.2f}s {problem or note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
