from __future__ import annotations

import random
import time

import pytest
from helpers import AWKWARD, ascii_lower, awkward, empty, words

from railweave.llm import packing
from railweave.llm.packing import best_fit


def tightest(sizes, sources, clusters, window, per_source):
    """Best fit by looking at every bin."""
    bins, chosen = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [
            (window - sum(s for s, _, _ in held), number)
            for number, held in enumerate(bins)
            if sum(s for s, _, _ in held) + size <= window
            and not any(c == cluster and c is not None for _, _, c in held)
            and sum(x == source for _, x, _ in held) < per_source
        ]
        number = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        bins[number].append((size, source, cluster))
        chosen.append(number)
    return chosen


def test_best_fit_equals_the_search_over_all_bins():
    draw = random.Random(1)
    for _ in range(200):
        n, window = draw.randint(0, 40), draw.randint(5, 60)
        sizes = sorted((draw.randint(1, window) for _ in range(n)), reverse=True)
        sources = [draw.choice("abc") for _ in range(n)]
        clusters = [draw.choice([None, 1, 2, 3, 4, 5, 6]) for _ in range(n)]
        assert best_fit(sizes, sources, clusters, window, 2) == tightest(sizes, sources, clusters, window, 2)


def check_bins(bins, texts, window, per_source, sources, clusters):
    seen = {}
    for b in bins:
        assert sum(b.sizes) == b.n_words <= window == max(window, b.n_words)
        assert words(b.text) == [w for i, s, n in zip(b.doc_ids, b.starts, b.sizes) for w in words(texts[i])[s : s + n]]
        held = [clusters[i] for i in b.doc_ids]
        assert len(held) == len(set(held))
        assert all([sources[i] for i in b.doc_ids].count(s) <= per_source for s in {sources[i] for i in b.doc_ids})
        for i, s, n in zip(b.doc_ids, b.starts, b.sizes):
            seen.setdefault(i, []).append((s, n))
    return seen


def test_every_word_is_packed_once_without_conflicts(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(f"w{draw.randint(0, 9)}" for _ in range(draw.choice([1, 5, 30, 60, 230])))) for i in range(400)]
    rows += [(1000 + i, rows[i][1].upper()) for i in range(100)]
    texts, sources = dict(rows), {i: f"s{i % 4 if i % 3 else 0}" for i, _ in rows}
    docs = spark.createDataFrame([(i, t, sources[i]) for i, t in rows], "doc_id long, text string, source string")
    bins = packing.pack(docs, window=64, shard_words=2000).collect()
    clusters = {i: ascii_lower(t) for i, t in rows}
    seen = check_bins(bins, texts, 64, packing.PER_SOURCE, sources, clusters)
    assert {i: sorted(p) for i, p in seen.items()} == {
        i: [(s, min(64, len(words(t)) - s)) for s in range(0, len(words(t)), 64)] for i, t in rows
    }
    again = packing.pack(docs.repartition(7), window=64, shard_words=2000).collect()
    assert sorted(map(str, again)) == sorted(map(str, bins))


def test_clusters_from_a_column(spark):
    docs = spark.createDataFrame([(i, f"a b {i}", "s", "one" if i < 3 else None) for i in range(6)], "doc_id long, text string, source string, cluster string")
    bins = packing.pack(docs, cluster_column="cluster", window=9, per_source=9).collect()
    assert all(sum(i < 3 for i in b.doc_ids) <= 1 for b in bins) and len(bins) == 3


def test_awkward_and_empty_tables(spark):
    bins = packing.pack(awkward(spark), window=1000).collect()
    assert sum(b.n_words for b in bins) == sum(len(words(t)) for _, t, _, _ in AWKWARD)
    twice = [b.doc_ids for b in bins if 12 in b.doc_ids]
    assert len(twice) == 2 and all(ids.count(12) == 1 for ids in twice)
    assert packing.pack(empty(spark)).collect() == []


def test_the_index_of_bins_equals_a_walk_over_all_of_them():
    for seed in range(60):
        draw = random.Random(seed)
        n, window = draw.randint(0, 200), draw.choice([5, 40, 2048])
        sizes = sorted((draw.randint(1, draw.choice([2, window])) for _ in range(n)), reverse=True)
        sources = [draw.choice(["a", "b", None, "c", "a", "a"]) for _ in range(n)]
        clusters = [draw.choice([None, 0, 0, draw.randint(1, 40)]) for _ in range(n)]
        per_source = draw.randint(1, 3)
        expected = tightest(sizes, sources, clusters, window, per_source)
        assert best_fit(sizes, sources, clusters, window, per_source) == expected


@pytest.mark.parametrize("cluster", [None, 7])
def test_a_million_words_of_one_source_or_cluster_take_linear_time(cluster):
    n = 1_000_000
    started = time.perf_counter()
    bins = best_fit([1] * n, ["a"] * (n - 1) + ["b"], [cluster] * n, 2048, 2)
    assert time.perf_counter() - started < 60
    assert max(bins) + 1 == (n if cluster else n // 2)


def test_a_document_repeated_in_a_third_of_the_rows_spreads_over_shards(spark):
    rows = [(None if i % 2 else 5, "the same words again", "a") for i in range(400)] + [(i, f"words of {i} here", "b") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bins = packing.pack(docs, shard_words=400).collect()
    assert sum(len(b.doc_ids) for b in bins) == 1200 and sum(b.n_words for b in bins) == 4 * 1200
    same = [b.bin_id >> 32 for b in bins for i in b.doc_ids if i is None or (i == 5 and "the same words again" in b.text)]
    assert max(same.count(shard) for shard in set(same)) < 100
    assert all(b.text.count("the same words again") <= 1 for b in bins)
