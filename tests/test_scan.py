"""The sliced scan against a plain loop, with slices and hot slices forced."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from railweave.operators.percentiles import distributions, exact_percentiles
from railweave.operators.scan import Measure, exclusive_scan

MEASURES = [Measure("total", "sum", "value"), Measure("previous", "last", "boxed")]


def expected(rows):
    """{id: (sum before, last before)} by walking each key in order."""
    result, state = {}, {}
    for id_, key, at, value in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        total, last = state.get(key, (None, None))
        result[id_] = (total, last)
        if value is not None:
            total = (total or 0) + value
            last = value
        state[key] = (total, last)
    return result


def scanned(spark, rows, **options):
    df = spark.createDataFrame(rows, "id BIGINT, key STRING, at BIGINT, value BIGINT")
    df = df.withColumn("boxed", F.when(F.col("value").isNotNull(), F.struct("value")))
    found = exclusive_scan(df, ["key"], "at", MEASURES, tiebreak="id", **options).collect()
    assert len(found) == len(rows)
    return {r.id: (r.total, r.previous.value if r.previous else None) for r in found}


def sample(seed, rows=400, span=50_000):
    """A third of the rows share one key, and a fifth of those one position."""
    rng = random.Random(seed)
    out = []
    for id_ in range(rows):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(20)}"
        at = 7_777 if key == "hot" and rng.random() < 0.2 else rng.randrange(-span, span)
        out.append((id_, key, at, None if rng.random() < 0.15 else rng.randrange(-9, 10)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "options",
    [
        {"sliced": False},
        {"hot_rows": 1_000_000},
        {"hot_rows": 1_000_000, "sliced": True, "slice_width": 9_000},
        {"hot_rows": 60, "slice_width": 10_000},
        {"hot_rows": 1, "slice_width": 20_000},
        {"hot_rows": 2, "slice_width": 10_000_000},
        {"hot_rows": None, "slice_width": 500},
    ],
)
def test_scan_equals_ordered_walk(spark, seed, options):
    rows = sample(seed)
    assert scanned(spark, rows, **options) == expected(rows)


def test_blocks_split_a_single_hot_position(spark):
    block = 1 << 20
    rows = [(i * (block // 3), "k", 5, i) for i in range(12)] + [(7, "k", 4, 100)]
    assert scanned(spark, rows, hot_rows=2, slice_width=10) == expected(rows)


def test_hot_keys_are_not_gathered_in_one_group(spark):
    rows = spark.range(2_000).selectExpr("id", "'k' key", "id at", "id div 1 value")
    scan = exclusive_scan(
        rows, ["key"], "at", [Measure("n", "sum", "value")], tiebreak="id", hot_rows=100,
        slice_width=64,
    )
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "value#" in line]
    assert windows and all("_slice" in line for line in windows)
    assert scan.filter("coalesce(n, 0) <> id * (id - 1) div 2").isEmpty()


def test_empty_input(spark):
    assert scanned(spark, [], hot_rows=1) == {}


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_percentiles_equal_numpy(spark, size):
    rng = np.random.default_rng(size)
    values = rng.integers(-90_000, 90_000, size).tolist()
    values += values[: size // 3] * 2
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v INT")
    row = exact_percentiles(df, "v", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}).first()
    for name, q in {"p50": 50, "p95": 95, "p0": 0, "p100": 100}.items():
        assert row[name] == pytest.approx(np.percentile(values, q), abs=1e-6)


def test_percentiles_of_nothing_are_null(spark):
    row = exact_percentiles(spark.createDataFrame([], "v INT"), "v", {"p50": 0.5}).first()
    assert row.p50 is None


def test_distributions_of_several_columns_share_one_scan(spark):
    rows = [(i, None if i % 5 == 0 else i * i % 97, None) for i in range(200)]
    df = spark.createDataFrame(rows, "a INT, b INT, c INT")
    found = distributions(df, ["a", "b", "c"], {"p50": 0.5, "p95": 0.95})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    row = found.first()
    for name, values in (("a", [r[0] for r in rows]), ("b", [r[1] for r in rows if r[1] is not None])):
        assert row[f"{name}_count"] == len(values) and row[f"{name}_max"] == max(values)
        assert row[f"{name}_avg"] == pytest.approx(sum(values) / len(values))
        for p in (50, 95):
            assert row[f"{name}_p{p}"] == pytest.approx(float(np.percentile(values, p)))
    assert row.c_count == 0 and row.c_p50 is None and row.c_max is None
    assert "Generate explode" in plan
