from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from railweave.llm import ann

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>, label int, id_ long, vector_ string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)


def brute(rows, queries, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.setdefault(i, []).append(np.array(v, dtype=np.float64))
    found = {}
    for q in queries:
        best = {}
        for a in usable.get(q, []):
            for i, others in usable.items():
                for b in others:
                    if i != q and len(a) == len(b):
                        score = float(a @ b / np.sqrt((a @ a) * (b @ b)))
                        best[i] = max(best.get(i, -2.0), score)
        if best:
            found[q] = sorted(((-round(s, 9), i) for i, s in best.items()))[:k]
    return found


def result(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, -round(r.score, 9), r.vec_id))
    for rows in out.values():
        assert sorted(r for r, _, _ in rows) == list(range(1, len(rows) + 1))
    return {q: [(s, i) for _, s, i in sorted(rows)] for q, rows in out.items()}


def test_hadamard_is_orthonormal():
    x = ann.hadamard(np.eye(16))
    assert np.allclose(x @ x.T, np.eye(16))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [-1.0, 0.0, 0.0]), (4, None), (5, []),
        (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]), (9, [inf, 1.0, 0.0]), (10, [0.0, 1.0, 0.0]),
        (11, [1.0, 0.0]), (12, [0.0, 3.0]), (None, [1.0, 0.0, 0.0]), (13, [1.0, 1.0, 1.0]), (13, [1.0, 1.0, 1.0]),
    ]
    found = result(ann.nearest_neighbours(table(spark, rows), F.col("vec_id") % 1 == 0))
    assert found == brute(rows, [i for i, _ in rows if i is not None])


def test_many_equal_vectors_give_the_smallest_ids(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    draw = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 else draw.normal(size=4).tolist()) for i in range(300)]
    rows = [(i, np.array(v, dtype=np.float32).tolist()) for i, v in rows]
    found = result(ann.nearest_neighbours(table(spark, rows), F.col("vec_id") % 50 == 0, probes=4))
    assert found == brute(rows, range(0, 300, 50))


def test_empty_table(spark):
    assert ann.nearest_neighbours(table(spark, []), F.lit(True)).collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="bundled data not present")
def test_recall_on_the_bundled_vectors(spark):
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = result(ann.nearest_neighbours(vectors, F.col("vec_id") % 50 == 0))
    exact = brute(rows, [i for i, _ in rows if i % 50 == 0])
    hits = sum(len({i for _, i in found[q]} & {i for _, i in best}) for q, best in exact.items())
    assert hits >= 0.95 * sum(map(len, exact.values()))


def test_ties_beyond_the_places_go_to_the_smaller_ids(spark):
    rows = [(i, [2.0**i, 2.0 ** (i + 1), -(2.0**i)]) for i in range(31)] + [(40 + i, [1.0, -1.0, float(i)]) for i in range(40)]
    found = result(ann.nearest_neighbours(table(spark, rows), F.col("vec_id") == 0))
    assert [i for _, i in found[0]] == [1, 2, 3, 4, 5]
