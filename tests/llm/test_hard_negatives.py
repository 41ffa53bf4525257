from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from railweave.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id_ long, score_ string, bars_ int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows], SCHEMA)


def brute(rows, step, k=5):
    """Rows by plain loops; of a repeated id the least (label, vector) stays."""
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(256 * x) for x in v):
            continue
        usable[i] = min(usable.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in usable.items()}
    out = set()
    for a, (label, v) in whole.items():
        if a % step:
            continue
        others = [(sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in whole.items() if i != a and len(w) == len(v)]
        for score, p, _ in sorted((o for o in others if o[2] == label), key=lambda o: (-o[0], o[1]))[:k]:
            fits = [o for o in others if o[2] != label and 80 * score <= 100 * o[0] <= 100 * score]
            for rank, (s, n, _) in enumerate(sorted(fits, key=lambda o: (-o[0], o[1]))[:k], 1):
                out.add((a, p, rank, n, score, s))
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vectors(seed, n, dim=6, labels=4, grain=3):
    draw = random.Random(seed)
    return [(i, [draw.randint(-grain, grain) / 4 + 0.3 for _ in range(dim)], draw.randrange(labels)) for i in range(n)]


def test_equals_plain_loops_with_many_ties(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 64)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 8)
    rows = vectors(1, 400) + [(1000 + i, [0.5] * 6, i % 2) for i in range(60)]
    found = result(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0))
    assert found and found == brute(rows, 10)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.1], 2), (3, None, 1), (4, [], 1), (5, [1.0, None], 1), (6, [nan, 1.0], 2),
        (7, [inf, 1.0], 2), (8, [1e306, 1.0], 2), (9, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (10, [1.0, 0.0], 2), (10, [1.0, 0.0], 2),
        (11, [1.0, 0.0, 1.0], 2), (12, [0.95, 0.0], 3), (12, [0.9, 0.0], 3), (13, [0.0, 0.0], 2), (14, [-1.0, 0.0], 1),
    ]
    found = result(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 1 == 0))
    assert found == brute(rows, 1)
    assert hard_negatives.mine(table(spark, []), F.lit(True)).collect() == []
    assert hard_negatives.mine(table(spark, rows), F.lit(None).cast("boolean")).collect() == []


def test_scores_past_doubles_are_exact(spark):
    rows = [(i, [2.0**20 + i, 3.0 - i, 2.0**20 - 7 * i], i % 2) for i in range(40)]
    found = result(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0))
    assert found and found == brute(rows, 10)
    big = hard_negatives.scores(np.array([[2.0**60, 1.0]]), np.array([[2.0**60, 3.0]]))
    assert big[0, 0] == (1 << 120) + 3


def test_stream_holds_the_windows_of_one_anchor():
    rows = [(1, 7, 100, False), (1, 3, 100, True), (1, 4, 90, True), (1, 9, 90, False), (1, 5, 80, True), (1, 6, 72, True), (1, 8, 71, True),
            (2, 1, 50, True), (2, 7, 40, False), (2, 9, 40, True)]
    assert list(hard_negatives.windows(iter(rows), 2, 80, 100)) == [
        (1, 7, 1, 3, 100, 100), (1, 7, 2, 4, 100, 90), (1, 9, 1, 5, 90, 80), (1, 9, 2, 6, 90, 72), (2, 7, 1, 9, 40, 40)
    ]


def test_secondary_sort_in_the_plan(spark):
    df = hard_negatives.mine(table(spark, vectors(2, 50)), F.col("vec_id") % 10 == 0)
    plan = df._jdf.queryExecution().toString()
    assert "RepartitionByExpression [anchor_id" in plan and "CartesianProduct" not in plan
