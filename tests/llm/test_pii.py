from __future__ import annotations

import hashlib
import random
import re

from helpers import AWKWARD, awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from railweave.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in match[0].split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and pii.luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                found.append((kind, *match.span()))
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(deadline=None, max_examples=1500)
@given(st.text(alphabet="0123456789.. --+@ab(\xe9", max_size=45))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1" + " " * 200_000, "1 " * 100_000):
        pii.base_spans(text)


def corpus(n=200):
    draw = random.Random(1)
    card = "4539578763621486"
    rows = []
    for i in range(n):
        kind = draw.choice(["email", "ip", "card", "phone", "none"])
        span = {
            "email": f"user{i}@mail{draw.randint(1, 9)}.example.com",
            "ip": ".".join(str(draw.randint(1, 255)) for _ in range(4)),
            "card": card if i % 2 else " ".join(card[k : k + 4] for k in range(0, 16, 4)),
            "phone": f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}",
            "none": f"version {draw.randint(10, 99)}.{draw.randint(10, 99)} of {draw.randint(1990, 2024)}",
        }[kind]
        rows.append((i, f"some words before it {span} and some words after it"))
    return rows


def test_the_field_adds_what_the_patterns_miss(spark):
    docs = corpus() + [
        (1000, "write to john at example dot com for more"),
        (1001, "he lives at the old dot on the map"),
        (1002, "the host is 10[.]20[.]30[.]40 as you know"),
        (1003, "two cards 4539578763621486 4539578763621486 here"),
        (1004, "an invoice of 2024-01-15 with 12 items"),
    ]
    rows = pii.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    by_id, texts = {r.doc_id: r for r in rows}, dict(docs)
    for r in rows:
        base = plain(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        assert r.n_added == len(list(filter(None, r.spans.split(",")))) - len(base)
    assert all(by_id[i].n_added == 0 for i in range(200))
    assert by_id[1000].spans == "email:9:32" and by_id[1001].spans == "" and by_id[1004].spans == ""
    assert by_id[1002].spans == "ip:12:29"
    assert by_id[1003].spans == "card:10:26,card:27:43"


REACHED = [
    ("write to jane.doe (at) example.com for more", "email", "jane.doe (at) example.com"),
    ("write to jane [at] example.org for more", "email", "jane [at] example.org"),
    ("write to jane at example.org for more", "email", "jane at example.org"),
    ("the host is 8[.]8[.]4[.]4 as you know", "ip", "8[.]8[.]4[.]4"),
    ("the host is 8 (.) 8 (.) 4 (.) 4 as you know", "ip", "8 (.) 8 (.) 4 (.) 4"),
    ("the host is a1b2:c3d4:e5f6:a7b8:c9d1:e2f3:a4b5:c6d7 as you know", "ip", "a1b2:c3d4:e5f6:a7b8:c9d1:e2f3:a4b5:c6d7"),
    ("the host is f:e:d:c:b:a:1:2 as you know", "ip", "f:e:d:c:b:a:1:2"),
    ("write to a.name.of.more.than.forty.letters.before.its.sign@x dot org", "email", "a.name.of.more.than.forty.letters.before.its.sign@x dot org"),
    ("write to the.department.of.records.and.of.archives at example dot org", "email", "the.department.of.records.and.of.archives at example dot org"),
    ("call +1 2 3 4 5 6 7 today", "phone", "+1 2 3 4 5 6 7"),
]


def test_every_shape_is_within_reach_of_the_field():
    for text, kind, span in REACHED:
        start = text.index(span)
        whole = [
            c for low, high in pii.regions(text) for c in pii.segments(text, low, high, pii.covered(pii.base_spans(text)))[1]
            if (c[2], c[4], c[5]) == (kind, start, start + len(span))
        ]
        assert len(whole) == 1, text


def test_spelled_and_defanged_spans_are_added(spark):
    docs = corpus() + [(2000 + i, text) for i, (text, _, _) in enumerate(REACHED)]
    rows = pii.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {r.doc_id - 2000: r.spans for r in rows if r.doc_id >= 2000}
    for i in (0, 1, 2, 3):
        text, kind, span = REACHED[i]
        assert found[i] == f"{kind}:{text.index(span)}:{text.index(span) + len(span)}"


def test_rare_kinds_among_many_documents_are_fitted(spark):
    # Most documents hold a region without data, few hold a span of a kind.
    common = spark.range(30_000).selectExpr("id as doc_id", "concat('order ', 1000 + id, ' came in at noon') as text")
    rare = [(100_000 + 7 * i, text) for i, text in corpus(24)]
    asked = [(200_000, "write to john at example dot com for more"), (200_001, "the host is 10[.]20[.]30[.]40 as you know")]
    docs = common.unionByName(spark.createDataFrame(rare + asked, "doc_id long, text string"))
    found = {r.doc_id: r.spans for r in pii.find_personal_data(docs).where("n_added > 0").collect()}
    assert found == {200_000: "email:9:32", 200_001: "ip:12:29"}


def test_windows_hold_whole_spans():
    text = "x " * 60 + "a@b.org " * 40 + "or 8.8.8.8 " + "y " * 60
    windows = pii.labelled_windows(text)
    assert {kind for kind, _, _ in windows} == {"email", "ip"}
    for _, window, listed in windows:
        assert pii.base_spans(window) == [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in listed.split(","))]


def test_decoding_equals_the_best_of_all_segmentations():
    draw = random.Random(3)
    for _ in range(200):
        n = draw.randint(1, 6)
        arcs = [
            (i, j, "card", [f"{i}-{j}-{c}"], i, j) for i in range(n) for j in range(i + 1, n + 1) for c in range(draw.randint(0, 2))
        ]
        weights = {a[3][0]: draw.uniform(-1, 2) for a in arcs}

        def best(at):
            if at == n:
                return 0.0
            return max([best(at + 1), *(weights[a[3][0]] + best(a[1]) for a in arcs if a[0] == at)])

        chosen = pii.decode(weights, n, arcs)
        assert all(a[1] <= b[0] for a, b in zip(chosen, chosen[1:]))
        assert abs(sum(weights[a[3][0]] for a in chosen) - best(0)) < 1e-9


def test_awkward_and_empty_tables(spark):
    rows = pii.find_personal_data(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    nothing = hashlib.sha256(b"").hexdigest()
    assert {r.doc_id for r in rows if r.base_sha256 != nothing} == {11}
    assert next(r for r in rows if r.doc_id == 11).spans.startswith("email:11:31,phone:35:52")
    assert pii.find_personal_data(empty(spark)).collect() == []
