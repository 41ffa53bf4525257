from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, awkward, empty, near_groups, shingles

from railweave.llm import near_dedup
from railweave.llm.components import components
from railweave.llm.shingles import MinHash, Shingles


def texts(n=260, groups=12, seed=5):
    """Groups of copies with more and more changed words, around the threshold, and short and lone texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randint(0, 400)}"
    bases = [[word() for _ in range(draw.choice([8, 30, 120]))] for _ in range(groups)]
    rows = []
    for i in range(n):
        base = list(bases[0] if i % 3 == 0 else draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 4, 8])):
            base[draw.randrange(len(base))] = word()
        rows.append((i, " ".join(base)))
    return rows


def found_groups(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: r.component_id for r in rows}


def test_shingle_sets_equal_python_sets():
    draw = random.Random(0)
    sample = ["".join(draw.choice("abAB \t\n\xa0éÉ") for _ in range(draw.randint(0, 60))) for _ in range(500)] + [None, ""]
    for text, hashes in zip(sample, Shingles().sets(pa.array(sample))):
        assert len(hashes) == len(shingles(text)) and (np.diff(hashes.astype(object)) > 0).all()


def test_minhash_estimates_similarity():
    a, b = np.arange(1000, dtype=np.uint64) ** 3, np.arange(200, 1200, dtype=np.uint64) ** 3
    minhash = MinHash(2000)
    assert abs((minhash.of(a) == minhash.of(b)).mean() - 800 / 1200) < 0.05


def test_similar_equals_set_algebra():
    draw = np.random.default_rng(0)
    sets = [np.unique(draw.integers(0, 40, size=draw.integers(1, 40)).astype(np.uint64)) for _ in range(60)]
    found = {tuple(x) for x in near_dedup.similar(sets, 25, 60, width=7).tolist()}
    assert found == {
        (i, j)
        for i in range(25)
        for j in range(i + 1, 60)
        if 100 * len(set(sets[i]) & set(sets[j])) >= 60 * len(set(sets[i]) | set(sets[j]))
    }


@pytest.mark.parametrize("small, block, pairs", [(256, 512, 4_000_000), (4, 8, 4_000_000), (4, 8, 4)])
def test_equals_all_pairs(spark, monkeypatch, small, block, pairs):
    """With small bounds the tree is branched to its depth and clusters are dealt out."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "PAIRS", pairs)
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_groups(near_dedup.near_duplicates(docs)) == near_groups(rows)


def test_awkward_and_empty_tables(spark):
    rows = near_dedup.near_duplicates(awkward(spark)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles) for r in rows) == sorted((i or 0, len(shingles(t))) for i, t, _, _ in AWKWARD)
    groups = near_groups([(i, t) for i, t, _, _ in AWKWARD if i is not None])
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == groups
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    kept = near_dedup.drop_near_copies(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == sorted(i for i, g in groups.items() if i == g)
    assert near_dedup.near_duplicates(empty(spark)).collect() == []
    assert near_dedup.drop_near_copies(empty(spark)).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(120, 139), (200, 200)]
    found = {r.u: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)}
