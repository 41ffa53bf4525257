from __future__ import annotations

import pytest
from helpers import AWKWARD, awkward, empty, words

from railweave.llm import mixing


def reshared(sizes: dict, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing the excess until none is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, total = {}, set(names), share * sum(sizes.values())
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1000, None: 3}, {"a": 0, "b": 0}, {"x": 7}, {f"s{i}": 1 + i * i % 97 for i in range(40)}])
def test_targets_are_reshared(spark, sizes):
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source_ string, source_size_ long")
    found = {r.source_: r.target_ for r in mixing.source_targets(table).collect()}
    assert found == pytest.approx(reshared(sizes), abs=1e-5)


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), f"s{i % 3 if i % 2 else 0}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(docs, slices=16)
    first = {r.id_: (r.size_, r.source_, r.target_, r.taken_) for r in plan.collect()}
    assert first == {r.id_: (r.size_, r.source_, r.target_, r.taken_) for r in mixing.plan_mix(docs.repartition(5), slices=512).collect()}
    for source in {v[1] for v in first.values()}:
        own = [v for v in first.values() if v[1] == source]
        assert abs(sum(v[3] for v in own) - own[0][2]) <= 1
        epochs = own[0][2] // sum(v[0] for v in own)
        assert all(v[3] in (epochs * v[0], (epochs + 1) * v[0]) and v[3] <= 2 * v[0] for v in own)
    # The rows of the mixed corpus.
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.groupBy("doc_id").count().collect().__len__() == sum(v[3] > 0 for v in first.values())
    assert mixed.count() == sum(v[3] // v[0] for v in first.values())


def test_better_documents_are_taken_more_often(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'a b c' as text", "if(id < 2000, 'x', 'y') as source")
    quality = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 4.0, 1.0) as quality")
    rows = mixing.plan_mix(docs, quality=quality, share=0.5).where("taken_ > 0").collect()
    good = sum(r.id_ % 2 == 0 for r in rows)
    assert 0.62 < good / len(rows) < 0.8


def test_repeated_rows_and_rows_without_id_are_mixed_as_planned(spark):
    # 1,000 equal rows, 600 rows without an id that differ in text alone, 400 distinct ones: one source, of which 60 % are wanted.
    rows = (
        [(7, "the same four words", "a")] * 1000
        + [(None, f"three words t{i}", "a") for i in range(600)]
        + [(100 + i, "one of some others", "a") for i in range(400)]
    )
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for share, most in ((0.6, 1), (1.6, 2)):
        options = {"share": share, "max_epochs": most}
        plan = mixing.plan_mix(docs, **options).collect()
        wanted, planned = plan[0].target_, sum(r.taken_ for r in plan)
        mixed = mixing.mix(docs, **options).collect()
        assert abs(planned - wanted) <= 4 and sum(len(words(r.text)) for r in mixed) == planned
        for i in {r.id_ for r in plan}:
            assert sum(r.doc_id == i for r in mixed) == sum(r.taken_ // r.size_ for r in plan if r.id_ == i)
        texts = [r.text for r in mixed if r.doc_id is None]
        assert max(texts.count(t) for t in set(texts)) <= most


def test_awkward_and_empty_tables(spark):
    plan = mixing.plan_mix(awkward(spark)).collect()
    assert sorted((r.id_ or 0, r.size_) for r in plan) == sorted((i or 0, len(words(t))) for i, t, _, _ in AWKWARD)
    assert all(0 <= r.taken_ <= 2 * r.size_ and r.taken_ % max(1, r.size_) == 0 for r in plan)
    mixed = mixing.mix(awkward(spark))
    assert mixed.columns == awkward(spark).columns and mixed.where("trim(text) = ''").count() == 0
    assert mixing.plan_mix(empty(spark)).collect() == [] and mixing.mix(empty(spark)).collect() == []
