"""History that had arrived: sums over two orders."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from railweave.operators import availability
from railweave.operators.availability import available_delay, leaf_sums

START = datetime(2024, 1, 1)
SCHEMA = (
    "row_id long, observation_id long, route_id string, event_timestamp timestamp, ingested_at timestamp,"
    " current_delay_sec int"
)


def brute(rows):
    out = {}
    for row_id, oid, route, at, arrived, _ in rows:
        if arrived is None:
            continue
        known = [
            d for _, o, r, t, a, d in rows
            if r == route and a is not None and a <= arrived and (t, o) < (at, oid) and d is not None
        ]
        out[row_id] = sum(known) / len(known) if known else None
    return out


def observations(seed, n, routes):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(minutes=draw.randrange(n // 2))
        arrived = None if draw.random() < 0.05 else at + timedelta(minutes=draw.choice([0, 1, 1, 7, 300]))
        delay = None if draw.random() < 0.1 else draw.randrange(-600, 600)
        rows.append((i, i * 3 % (n * 2), draw.choice(routes), at, arrived, delay))
    return rows


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.row_id: r.m for r in available_delay(df, "route_id", "m", **options).collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k]) if a[k] is not None else b[k] is None


def test_leaf_sums_equal_all_pairs():
    draw = np.random.default_rng(2)
    group, number = np.repeat([0, 1, 2], 50), np.concatenate([draw.permutation(60)[:50] for _ in range(3)])
    arrived, value = draw.integers(0, 20, 150), draw.integers(-9, 9, 150)
    sums, ones = leaf_sums(group, number, arrived, [value, np.ones(150, dtype=np.int64)])
    for i in range(150):
        before = (group == group[i]) & (number < number[i]) & (arrived <= arrived[i])
        assert sums[i] == value[before].sum() and ones[i] == before.sum()
    assert [len(x) for x in leaf_sums(group[:0], number[:0], arrived[:0], [value[:0]])] == [0]


def test_equals_all_pairs(spark):
    rows = observations(1, 300, ["1", "2", None, ""])
    same(found(spark, rows), brute(rows))


@pytest.mark.parametrize("digits", [0, 2, 4])
def test_hot_route_over_scans(spark, monkeypatch, digits):
    monkeypatch.setattr(availability, "LEAF_DIGITS", digits)
    rows = observations(2, 200, ["1", "1", "1", "2"])
    same(found(spark, rows, hot_rows=10, sliced=True), brute(rows))
    same(found(spark, rows), brute(rows))


def test_what_came_late_is_left_out(spark):
    late = START + timedelta(hours=5)
    rows = [
        (1, 1, "1", START, late, 100),
        (2, 2, "1", START + timedelta(hours=1), START + timedelta(hours=1), 40),
        (3, 3, "1", START + timedelta(hours=2), START + timedelta(hours=2), 0),
        (4, 4, "1", START + timedelta(hours=6), late, 0),
    ]
    assert found(spark, rows) == {1: None, 2: None, 3: 40, 4: pytest.approx(140 / 3)}
    assert found(spark, []) == {}
