"""Toxicity by a weighted lexicon, matched by one Aho-Corasick automaton over folded text.

Folding: compatibility forms, capitals, accents and invisible characters go; letters of other scripts that look like Latin ones, digits
and signs that stand for letters become those letters; i, l and 1 become one letter. Digits and signs count as letters only inside
or before letters, so ``idiot$$$`` keeps its end. All else becomes blanks. Entries of the lexicon are folded likewise; an entry matches where a word begins
with it, or is the whole word where the entry ends in a blank. A match inside an exception phrase does not count.

An entry counts once in each block of ``BLOCK`` characters, so that a repeated word counts by the length it fills. The evidence of a
text is the weighted sum of its matches; the score is logistic in the evidence, in the evidence for each block, and in whether there is any.

Fitting: at most ``SAMPLE`` labelled texts of each label are drawn by a hash of their ids (the stated bound). In them the beginnings
of words of ``SHORTEST`` to ``LONGEST`` letters, and whole words, are counted by block and text, aggregated before and in the shuffle. Of those with enough toxic texts and ``RATIO`` times
the rate of other texts the ``CANDIDATES`` with the most evidence reach the driver; of nested ones the one with more evidence stays, else the longer.
Weights are log rate ratios. Of the matches in the drawn texts the phrases of a match and its neighbour word are counted; one found in at least
``EXCEPTION_TEXTS`` other texts and no toxic one is an exception. The score's four coefficients are fitted on the evidence
of the drawn texts, each standing for its share of its label, so the draw does not move the prior.
``SEEDS`` and ``EXCEPTIONS`` hold without any label.

Defined results: null and empty texts have no match and the score of a text without one, which is below one half. Every row is judged by itself, repeated
ids too; a label that repeats counts as toxic if any of its rows does. Rows without an id are held out like the id of no characters. Without labels of
both kinds the default coefficients hold. Long texts are matched whole in time linear in their length. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.llm.mixing import uniform
from railweave.llm.text import bound_batches, plain_text
from railweave.session import materialize

#: Drawn texts of each label; characters of a block.
SAMPLE, BLOCK = 4000, 400
#: Letters of a word's beginning; toxic texts that hold an entry, at least; its rate in toxic blocks over that in others, at least.
SHORTEST, LONGEST, LEAST_TEXTS, RATIO = 4, 10, 8, 4.0
CANDIDATES, ENTRIES, EXCEPTION_TEXTS = 4000, 400, 5
#: Weight of an entry without labels, and the largest learned one.
SEED_WEIGHT, MOST_WEIGHT = 4.0, 8.0
#: The largest constant of a score: a text without a match stays below one half.
MOST_CONSTANT = -1.0
#: Of a score without labels: constant, any match, log evidence, log evidence for each block.
DEFAULT_SCORE = (-4.0, 1.0, 1.5, 1.0)

#: Insults known without labels (blank at the end: whole words only), and harmless phrases that hold one.
SEEDS = (
    "idiot", "moron", "stupid", "imbecile", "scum", "worthless", "pathetic", "disgusting", "loser ", "losers ", "clown ", "clowns ",
    "trash ", "bastard", "dumbass", "asshole", "retard ", "arschloch", "dummkopf", "abschaum", "connard", "imbécile", "salaud",
    "estúpid", "imbécil", "gilipollas",
)
EXCEPTIONS = (
    "trash can ", "trash bin ", "trash bag ", "trash collection ", "clown fish ", "circus clown ", "rodeo clown ", "sore loser ",
    "the idiot by dostoevsky ", "pond scum ", "soap scum ",
)

#: Characters of other scripts and signs by the Latin letters they look like.
LOOKALIKES = {
    "a": "аɑαΑА@4", "b": "ЬвВΒ8", "c": "сСϲⅽ", "d": "ԁⅾ", "e": "еЕΕєε3", "g": "ɡ69", "h": "һНΗ", "i": "іІΙιɩӏ|!1lӀ",
    "j": "јЈ", "k": "кКΚκ", "m": "мМΜⅿ", "n": "ոпΝ", "o": "оОΟοσ0օ", "p": "рРΡρ", "q": "ԛ", "s": "ѕЅ$5", "t": "тТΤτ7",
    "u": "υսц", "v": "ѵνⅴ", "w": "ԝшω", "x": "хХΧχ", "y": "уУΥγү", "z": "ΖᴢZ2",
}
_SIGNS = "@$!|"


class _Table(dict):
    """Folds a character when it is first met: for ``str.translate``."""

    def __init__(self) -> None:
        super().__init__()
        self.alike = {ord(c): letter for letter, like in LOOKALIKES.items() for c in like}

    def __missing__(self, code: int) -> str:
        folded = self.alike.get(code)
        if folded is None:
            plain = "".join(
                c for c in unicodedata.normalize("NFKD", chr(code)).lower() if not unicodedata.combining(c)
            )
            plain = unicodedata.normalize("NFKD", plain)
            folded = "".join(self.alike.get(ord(c), c) if c.isalnum() else "" if c in _INVISIBLE else " " for c in plain)
        self[code] = folded
        return folded


_INVISIBLE = "­​‌‍⁠﻿"
_TABLE = _Table()
_AS_LETTER = re.compile(rf"(?<![^\W_])[{re.escape(_SIGNS)}]+(?=[^\W\d_])|(?<=[^\W_])[{re.escape(_SIGNS)}]+(?=[^\W_])")
_SIGN = re.compile(rf"[{re.escape(_SIGNS)}]")
_NUMBER = re.compile(r"(?<![^\W_])[0-9]+(?![^\W_])")


def folded(text: str) -> str:
    """The words in lower-case Latin letters with blanks around."""
    if _SIGN.search(text):
        # A sign is a letter inside a word or before one; else it parts words.
        letters = _AS_LETTER.sub(lambda m: m[0].translate(_TABLE), text)
        text = _SIGN.sub(" ", letters)
    text = _NUMBER.sub(" ", text)
    return f" {text.translate(_TABLE)} "


def _entry(text: str) -> str:
    """An entry or phrase as it stands in folded text; a blank at its end asks for the end of a word."""
    return " " + " ".join(folded(text).split()) + " " * text.endswith(" ")


@dataclass
class Lexicon:
    """Folded entries with their weights, folded exception phrases, and the coefficients of the score."""

    weights: dict[str, float] = field(default_factory=lambda: {_entry(s): SEED_WEIGHT for s in SEEDS})
    exceptions: list[str] = field(default_factory=lambda: [_entry(e) for e in EXCEPTIONS])
    score: tuple[float, ...] = DEFAULT_SCORE

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (phrase, None))
        for entry, weight in self.weights.items():
            found.add_word(entry, (entry, weight))
        if len(found):
            found.make_automaton()
        return found


def matches(automaton: ahocorasick.Automaton, text: str) -> list[tuple[int, str, float]]:
    """(start, entry, weight) of the matches in a folded text outside exception phrases; of entries within one another
    that begin a word together the longest counts."""
    if not len(automaton):
        return []
    starts: dict[int, tuple[str, float]] = {}
    excepted: list[tuple[int, int]] = []
    for end, (entry, weight) in automaton.iter(text):
        start = end - len(entry) + 1
        if weight is None:
            excepted.append((start, end))
        elif start not in starts or len(starts[start][0]) < len(entry):
            starts[start] = (entry, weight)
    if excepted:
        # An entry that ends a phrase may lack the phrase's last blank: its start decides.
        starts = {
            s: found for s, found in starts.items() if not any(a <= s and s + len(found[0].rstrip()) - 1 <= b for a, b in excepted)
        }
    return [(s, *found) for s, found in sorted(starts.items())]


def evidence(found: list[tuple[int, str, float]], length: int) -> tuple[float, float, float]:
    """Any match, log evidence, log evidence for each block."""
    total = sum({(start // BLOCK, entry): weight for start, entry, weight in found}.values())
    return float(bool(found)), math.log1p(total), math.log1p(total / (1 + length / BLOCK))


def logistic(coefficients: tuple[float, ...], features: tuple[float, ...]) -> float:
    z = coefficients[0] + sum(c * x for c, x in zip(coefficients[1:], features))
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


# Fitting ------------------------------------------------------------------------------------------


def _beginnings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Beginnings of words and whole words: blocks and texts of each label that hold them; the empty entry counts all."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
    for frame in frames:
        for toxic, text in zip(frame.toxic_.tolist(), frame.text_):
            plain = folded(text)
            every: set[str] = set()
            blocks: Counter = Counter()
            for low in range(0, len(plain), BLOCK):
                # A word belongs to the block of its first letter.
                high = plain.find(" ", low + BLOCK) if low + BLOCK < len(plain) else len(plain)
                words = set(plain[low : high if high >= 0 else len(plain)].split())
                if low and plain[low - 1] != " ":
                    words = set(plain[plain.find(" ", low) : high].split()) if plain.find(" ", low) >= 0 else set()
                held = {f" {w[:k]}" for w in words for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}
                held |= {f" {w} " for w in words if 3 <= len(w) <= LONGEST}
                blocks.update(held)
                every |= held
            blocks[""] = 1 + len(plain) // BLOCK
            every.add("")
            for entry in every:
                row = counts[entry]
                row[toxic] += blocks[entry]
                row[2 + toxic] += 1
        if len(counts) > 500_000:
            yield _flat(counts)
            counts.clear()
    yield _flat(counts)


def _flat(counts: dict[str, list[int]]) -> pd.DataFrame:
    rows = [(entry, *row) for entry, row in counts.items()]
    return pd.DataFrame(rows, columns=["entry_", "clean_blocks_", "toxic_blocks_", "clean_texts_", "toxic_texts_"])


def _neighbours(lexicon: Lexicon):
    """Phrases of a match's word and the word before or after it, by label."""

    def neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
        for frame in frames:
            for toxic, text in zip(frame.toxic_.tolist(), frame.text_):
                plain = folded(text)
                phrases = set()
                for start, entry, _ in matches(automaton, plain):
                    end = plain.find(" ", start + len(entry.rstrip()))
                    end = len(plain) if end < 0 else end
                    word = plain[start:end].strip()
                    before, after = plain[:start].rsplit(None, 1)[-1:], plain[end : end + 200].split(None, 1)[:1]
                    phrases.update(f" {b} {word} " for b in before)
                    phrases.update(f" {word} {a} " for a in after)
                for phrase in phrases:
                    counts[phrase][2 + toxic] += 1
        yield _flat(counts)

    return neighbours


def _measured(lexicon: Lexicon):
    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for frame in frames:
            rows = []
            for toxic, text in zip(frame.toxic_.tolist(), frame.text_):
                plain = folded(text)
                rows.append((toxic, *evidence(matches(automaton, plain), len(plain))))
            yield pd.DataFrame(rows, columns=["toxic_", "any_", "total_", "density_"])

    return measured


_COUNTS = "entry_ string, clean_blocks_ long, toxic_blocks_ long, clean_texts_ long, toxic_texts_ long"


def _summed(df: DataFrame) -> DataFrame:
    names = [c.strip().split()[0] for c in _COUNTS.split(",")][1:]
    return df.groupBy("entry_").agg(*(F.sum(n).alias(n) for n in names))


def choose_entries(rows: list, clean_blocks: int, toxic_blocks: int) -> dict[str, float]:
    """Weights of the entries with most evidence; of entries that begin alike one stays."""
    ranked = []
    for row in rows:
        rate = row.toxic_blocks_ / max(1, toxic_blocks)
        other = (row.clean_blocks_ + 0.5) / (clean_blocks + 1)
        weight = math.log(rate / other)
        ranked.append((-row.toxic_blocks_ * weight, -len(row.entry_), row.entry_, min(MOST_WEIGHT, weight)))
    chosen: dict[str, float] = {}
    for _, _, entry, weight in sorted(ranked):
        stem = entry.rstrip()
        if not any(stem.startswith(c.rstrip()) or c.startswith(stem) for c in chosen):
            chosen[entry] = weight
        if len(chosen) == ENTRIES:
            break
    return chosen


def fit_score(features: np.ndarray, toxic: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Coefficients of a lightly regularised logistic regression, by Newton's method."""
    x = np.column_stack([np.ones(len(features)), features])
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [0.1] * features.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (toxic - p)) - ridge @ b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
        b += step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    # A text without a match is never called toxic, however common the label is.
    return (min(float(b[0]), MOST_CONSTANT), *(float(v) for v in b[1:]))


def fit(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """A lexicon from texts (id_, text_) and labels (id_, toxic_)."""
    known = labels.where("id_ is not null and toxic_ is not null").groupBy("id_").agg(F.max("toxic_").alias("toxic_"))
    known = materialize(known.withColumn("draw_", uniform(F.col("id_"))), "toxicity-labels")
    total = {r.toxic_: r["count"] for r in known.groupBy("toxic_").count().collect()}
    if not (total.get(0) and total.get(1)):
        return Lexicon()
    drawn = [
        known.where(F.col("toxic_") == kind).orderBy("draw_", "id_").limit(SAMPLE).select("id_", "toxic_") for kind in (0, 1)
    ]
    # At most two times SAMPLE ids: a bounded broadcast.
    sample = docs.join(F.broadcast(drawn[0].unionByName(drawn[1])), "id_").select("toxic_", "text_")
    sample = materialize(sample.distinct(), "toxicity-sample")
    counted = materialize(_summed(sample.mapInPandas(_beginnings, _COUNTS)), "toxicity-entries")
    every = counted.where("entry_ = ''").first()
    if every is None or not (every.clean_texts_ and every.toxic_texts_):
        return Lexicon()
    rate = F.col("toxic_blocks_") / F.lit(every.toxic_blocks_)
    other = (F.col("clean_blocks_") + 0.5) / F.lit(every.clean_blocks_ + 1)
    best = (
        counted.where(f"entry_ <> '' and toxic_texts_ >= {LEAST_TEXTS}")
        .where(rate >= RATIO * other)
        .orderBy(F.desc(F.col("toxic_blocks_") * F.log(rate / other)), F.desc(F.length("entry_")), "entry_")
        .limit(CANDIDATES)
        .collect()
    )
    learned = choose_entries(best, every.clean_blocks_, every.toxic_blocks_)
    default = Lexicon()
    seeds = {
        entry: weight
        for entry, weight in default.weights.items()
        if not any(entry.startswith(c.rstrip()) or c.startswith(entry.rstrip()) for c in learned)
    }
    weights = {**seeds, **learned}
    phrases = _summed(sample.mapInPandas(_neighbours(Lexicon(weights, default.exceptions)), _COUNTS))
    harmless = (
        phrases.where(f"toxic_texts_ = 0 and clean_texts_ >= {EXCEPTION_TEXTS}")
        .orderBy(F.desc("clean_texts_"), "entry_").limit(CANDIDATES).collect()
    )
    lexicon = Lexicon(weights, sorted({*default.exceptions, *(r.entry_ for r in harmless)}))
    rows = sample.mapInPandas(_measured(lexicon), "toxic_ int, any_ double, total_ double, density_ double")
    values = np.array([tuple(r) for r in rows.collect()])
    values = values[np.lexsort(values.T)]
    toxic = values[:, 0]
    counts = {kind: float((toxic == kind).sum()) for kind in (0, 1)}
    share = np.where(toxic == 1, total[1] / max(1.0, counts[1]), total[0] / max(1.0, counts[0]))
    share *= len(values) / share.sum()
    return Lexicon(weights, lexicon.exceptions, fit_score(values[:, 1:], toxic, share))


def _scored(lexicon: Lexicon):
    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for frame in frames:
            rows = []
            for text in frame.text_:
                plain = folded(text)
                found = matches(automaton, plain)
                score = logistic(lexicon.score, evidence(found, len(plain)))
                rows.append((score, int(score >= 0.5), len(found), sorted({entry.strip() for _, entry, _ in found})))
            out = pd.DataFrame(rows, columns=["score", "predicted", "n_matches", "terms"])
            out.insert(0, "id_", frame.id_.array)
            out.insert(1, "held_", frame.held_.array)
            yield out

    return scored


def held_out(id_column: str = "doc_id"):
    """Whether a row's label is kept for testing, by a checksum of its id."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    lexicon: Lexicon | None = None,
) -> DataFrame:
    """A row per row of ``docs``: its id, held_out, score, predicted, n_matches and the folded terms found. Without
    a lexicon one is fitted on the labels that are not held out."""
    bound_batches(docs.sparkSession)
    texts = docs.select(
        F.col(id_column).cast("long").alias("id_"), held_out(id_column).alias("held_"), plain_text(F.col(text_column)).alias("text_")
    )
    if lexicon is None:
        lexicon = Lexicon()
        if labels is not None:
            known = labels.where(~held_out(id_column)).select(
                F.col(id_column).cast("long").alias("id_"), F.col(label_column).cast("int").alias("toxic_")
            )
            lexicon = fit(texts.select("id_", "text_"), known)
    return texts.mapInPandas(
        _scored(lexicon), "id_ long, held_ boolean, score double, predicted int, n_matches int, terms array<string>"
    ).withColumnsRenamed({"id_": id_column, "held_": "held_out"})
