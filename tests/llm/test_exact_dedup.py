from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from helpers import AWKWARD, ascii_lower, awkward, empty

import corpus_pipeline
from railweave.llm import exact_dedup


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_awkward_table_equals_grouping(spark, keep):
    groups = defaultdict(list)
    for i, t, _, _ in AWKWARD:
        groups[ascii_lower(t)].append(i)
    best = {t: {"largest": max, "smallest": min}[keep]([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    expected = sorted(
        str((i, best[ascii_lower(t)], len(groups[ascii_lower(t)]), i == best[ascii_lower(t)], hashlib.sha256(ascii_lower(t).encode()).hexdigest()))
        for i, t, _, _ in AWKWARD
    )
    found = exact_dedup.dedup_report(awkward(spark), keep=keep).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in found) == expected
    kept = exact_dedup.drop_exact_copies(awkward(spark), keep=keep)
    assert kept.columns == awkward(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in found if r.kept)


@pytest.mark.parametrize("levels, fan", [(0, 1), (1, 1), (5, 2), (6, 6), (7, 3)])
def test_any_tree_gives_the_same_groups(spark, levels, fan):
    entries = spark.range(3000).selectExpr(
        "id as id_", "if(id % 3 = 0, 'hot', cast(id % 211 as string)) as digest_", "1 as length_", "2L as second_"
    )
    found = {r.digest_: (r.keep_id_, r.group_size_) for r in exact_dedup.merge_runs(entries, levels=levels, fan_bits=fan).collect()}
    expected = defaultdict(list)
    for i in range(3000):
        expected["hot" if i % 3 == 0 else str(i % 211)].append(i)
    assert found == {d: (max(ids), len(ids)) for d, ids in expected.items()}


def test_runs_are_sorted_and_merged_in_order(spark):
    entries = spark.range(100).selectExpr("id as id_", "cast(id % 9 as string) as digest_", "1 as length_", "2L as second_")
    plan = exact_dedup.merge_runs(entries)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortAggregate") == 6 and "HashAggregate" not in plan
    physical = exact_dedup.merge_runs(entries)._jdf.queryExecution().executedPlan().toString()
    # Three rounds: each sorts before its exchange and after it.
    assert physical.count("Exchange hashpartitioning") == 3 and physical.count("Sort [") == 6


def test_entries_that_differ_behind_one_digest_stay_apart(spark):
    entries = spark.createDataFrame([(1, "d", 4, 9), (2, "d", 5, 9), (3, "d", 4, 8), (4, "d", 4, 9)], "id_ long, digest_ string, length_ int, second_ long")
    found = sorted((r.keep_id_, r.group_size_) for r in exact_dedup.merge_runs(entries).collect())
    assert found == [(2, 1), (3, 1), (4, 2)]


def test_the_pipeline_keeps_one_row_per_text(spark):
    rows = (
        [(1, "Twice the same", "a")] * 3 + [(2, "twice THE same", "a")] * 2 + [(None, "twice the same", "b")] * 2
        + [(None, "only without ids", "a")] * 40 + [(3, "once", "a"), (3, "once more", "a"), (None, "alone", "b")]
        + [(4, None, "a"), (4, "", "a"), (None, None, "a")]
    )
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    kept = sorted((r.doc_id or 0, ascii_lower(r.text)) for r in corpus_pipeline.drop_exact_copies(spark, docs, "").collect())
    assert kept == [(0, "alone"), (0, "only without ids"), (2, "twice the same"), (3, "once"), (3, "once more"), (4, "")]


def test_empty_table(spark):
    assert exact_dedup.dedup_report(empty(spark)).collect() == []
    assert exact_dedup.drop_exact_copies(empty(spark)).collect() == []
