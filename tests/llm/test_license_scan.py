from __future__ import annotations

import random

from helpers import awkward, empty

from railweave.llm import license_scan
from railweave.llm.license_scan import CONTAINMENT, SHINGLE, TEMPLATES, bands_for, template_words


def runs(words):
    return [tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def reference(text):
    words, found = template_words(text or ""), {}
    for name, template in TEMPLATES.items():
        sought, length = set(runs(template_words(template))), len(template_words(template))
        windows = {}
        sequence = runs(words)
        for start in range(0, max(len(sequence), 1), length):
            window = set(sequence[start : start + 2 * length - SHINGLE + 1])
            share = len(window & sought) / len(sought)
            if share >= CONTAINMENT:
                windows[start] = share
        if windows:
            found[name] = (max(windows.values()), len(windows))
    return found


def documents(spark):
    draw = random.Random(3)
    filler = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        text = draw.choices(filler, k=draw.choice([0, 3, 40, 400]))
        for template in draw.sample(sorted(TEMPLATES.values()), k=draw.choice([0, 1, 2])):
            words = template.split()
            for _ in range(draw.choice([0, 0, 1, 3])):
                words[draw.randrange(len(words))] = "changed"
            at = draw.randint(0, len(text))
            text[at:at] = words
        rows.append((i, " ".join(text)))
    return rows


def test_equals_all_windows_compared(spark):
    rows = documents(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.license): (r.containment, r.windows) for r in license_scan.scan_licenses(docs).collect()}
    assert found == {(i, name): hit for i, text in rows for name, hit in reference(text).items()}
    assert len(found) > 60


def test_bands_keep_the_promise():
    for length in (5, 12, 87):
        shingles, window = length - SHINGLE + 1, 2 * length - SHINGLE + 1
        shared = -(-3 * shingles // 4)
        similarity = shared / (window + shingles - shared)
        assert (1 - similarity) ** bands_for(length) <= 1e-6


def test_awkward_and_empty_tables(spark):
    assert license_scan.scan_licenses(empty(spark)).collect() == []
    docs = awkward(spark).selectExpr("doc_id", "case when doc_id = 9 then concat(text, ' Released under the MIT License.') else text end as text", "size_", "id_")
    found = license_scan.scan_licenses(docs).collect()
    assert [(r.doc_id, r.license, r.containment) for r in found] == [(9, "mit-line", 1.0)]
