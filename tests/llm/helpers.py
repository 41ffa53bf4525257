"""Awkward tables that every text operator has to take, and plain-Python references."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id_ long, size_ string, row_ string, text_ string"
BASE = "the quick brown fox jumps over a lazy dog while seven other animals look on from behind the old garden wall"
AWKWARD = [
    (1, BASE, "en", "a"),
    (2, BASE.upper(), "en", "a"),
    (3, BASE.replace("seven", "eight"), "en", "b"),
    (4, None, "en", "a"),
    (5, "", None, "b"),
    (6, " \t\n ", "en", None),
    (7, "one two three", "en", None),
    (8, "One two  three", "fr", "c"),
    (None, "a row without an id and with seven words more", "de", "c"),
    (9, "long " * 30_000 + "end", "en", "b"),
    (10, "Ünïcode ÄÖÜ und ß und mehr davon für alle", "de", "c"),
    (11, "mail me at jane.doe@example.org or +1 (555) 010-9999 today", None, None),
    (12, "same row twice in this table of documents", "en", "a"),
    (12, "same row twice in this table of documents", "en", "a"),
    (13, "one id", "en", "a"),
    (13, "with two texts", "en", "b"),
]


def awkward(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""
    rows = [(i, t, l, s, None if t is None else len(t), -1, "x", "y", "z") for i, t, l, s in AWKWARD]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def ascii_lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None) -> frozenset:
    w = words(ascii_lower(text))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


class Groups:
    """Union-find whose roots are the least members."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def near_groups(rows: list[tuple]) -> dict:
    """doc_id to the least doc_id reachable, by comparing all pairs."""
    sets, groups = [(i, shingles(t)) for i, t in rows], Groups()
    for i, _ in sets:
        groups.root(i)
    for at, (i, a) in enumerate(sets):
        for j, b in sets[:at]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                groups.join(i, j)
    return {i: groups.root(i) for i, _ in sets}
