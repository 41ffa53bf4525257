"""The pipeline against plain Python, stage by stage and as a whole."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from helpers import ascii_lower, awkward, empty, near_groups, words

import corpus_pipeline
from railweave.llm import language, mixing
from railweave.llm.queries import labelled_quality

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="bundled data not present")
def test_run_equals_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.id_ for r in language.identify(language.document_evidence(docs)).collect() if r.kept_}
    best: dict = {}
    for i in kept:
        text = ascii_lower(rows[i].text)
        best[text] = max(i, best.get(text, i))
    groups = near_groups([(i, rows[i].text) for i in sorted(best.values())])
    left = {i for i, g in groups.items() if i == g}
    mixed = mixing.plan_mix(docs.where(docs.doc_id.isin(*left)), quality=labelled_quality(spark, DATA)).collect()
    times = {r.id_: r.taken_ // max(1, r.size_) for r in mixed if r.taken_}

    bins = corpus_pipeline.run(spark, DATA).collect()
    packed = Counter()
    for b in bins:
        assert b.n_words == sum(b.sizes) <= 2048 and len(b.doc_ids) == len(set(b.doc_ids))
        for i, size in zip(b.doc_ids, b.sizes):
            packed[i] += size
    assert packed == {i: n * len(words(rows[i].text)) for i, n in times.items()}


def test_stages_keep_the_columns_and_take_awkward_tables(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (awkward(spark), empty(spark)):
        some = docs.count() > 0
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, str(tmp_path))
            assert after.schema.simpleString() == docs.schema.simpleString(), name
            docs = spark.createDataFrame(after.collect(), docs.schema)
        bins = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert bool(bins) == some
