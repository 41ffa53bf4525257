from __future__ import annotations

import os
import zlib

import pytest
from helpers import awkward, empty
from pyspark.sql import functions as F

from railweave.llm import toxicity
from railweave.llm.toxicity import Lexicon, folded, matches

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def found(text: str, lexicon: Lexicon | None = None) -> list[str]:
    return [entry.strip() for _, entry, _ in matches((lexicon or Lexicon()).automaton(), folded(text))]


@pytest.mark.parametrize(
    "text",
    [
        "you idiot", "IDIOTS!", "1d10t", "!d!ot", "іdіоt", "ïdiöt", "ｉｄｉｏｔ", "id​iot", "idiot$$$", "(idiot)", "idi0t,", "|diot", "idiót",
    ],
)
def test_disguises_fold_to_the_entry(text):
    assert found(text) == ["idiot"]


@pytest.mark.parametrize("text", ["", "videotape", "presidiots", "1010", "idea", "take the trash can out", "a clown fish", "$$$ @@@"])
def test_what_is_no_match(text):
    assert found(text) == []


def test_exceptions_cover_their_own_place_only():
    assert found("the trash can is trash") == ["trash"]
    assert len(found("idiot " * 50)) == 50


def test_entries_with_a_blank_are_whole_words():
    lexicon = Lexicon({" ioser ": 1.0, " scum": 1.0}, [])
    assert found("loser losers scumbag", lexicon) == ["ioser", "scum"]


def plain_matches(lexicon: Lexicon, text: str) -> list[tuple[int, str]]:
    """Every entry tried at every place."""
    text = folded(text)
    spans = [(i, i + len(p) - 1) for p in lexicon.exceptions for i in range(len(text)) if text.startswith(p, i)]
    out = []
    for i in range(len(text)):
        here = [e for e in lexicon.weights if text.startswith(e, i)]
        if here:
            best = max(here, key=len)
            if not any(a <= i and i + len(best.rstrip()) - 1 <= b for a, b in spans):
                out.append((i, best))
    return out


def test_matches_equal_the_plain_search():
    import random

    draw = random.Random(3)
    lexicon = Lexicon({" ab": 1.0, " abc ": 2.0, " b": 1.5, " ca ": 3.0}, [" ab ca ", " b b "])
    for _ in range(300):
        text = "".join(draw.choice("abc  ") for _ in range(draw.randint(0, 60)))
        assert [(s, e) for s, e, _ in matches(lexicon.automaton(), folded(text))] == plain_matches(lexicon, text)


def test_score_grows_with_evidence_and_falls_with_length():
    def score(text):
        plain = folded(text)
        return toxicity.logistic(toxicity.DEFAULT_SCORE, toxicity.evidence(matches(Lexicon().automaton(), plain), len(plain)))

    clean, once, thrice = "a calm text " * 50, "idiot " + "a calm text " * 50, "idiot moron scum " + "a calm text " * 50
    assert score(clean) < score(once) < score(thrice)
    assert score("idiot " + "a calm text " * 2000) < score(once)
    # A word counts once in each block.
    assert score("idiot idiot idiot " + "a calm text " * 50) == pytest.approx(score(once), abs=0.02)


def labelled(spark):
    """Toxic texts hold one of two made-up words, or begin a word with a made-up stem; texts of the other label share the rest."""
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [f"w{(i * 7 + k * k) % 211}x" for k in range(60)]
        if toxic:
            words[10::20] = [["grumblo", "zorpish", f"frakk{'abc'[i % 3]}el"][i % 3]] * 3
        elif i % 25 == 0:
            words[3:5] = ["zorpish", "season"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_fit_finds_words_stems_and_exceptions(spark):
    docs, labels = labelled(spark)
    out = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").collect()
    assert len(out) == 600
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (
        {r.doc_id: r.score for r in toxicity.score_toxicity(docs, known).collect()} for known in (labels, turned)
    )
    assert first == second


def test_awkward_documents(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(docs, labels).collect()
    assert len(out) == docs.count()
    assert {r.held_out for r in out if r.doc_id is None} == {True}
    assert all(r.predicted == 0 and r.n_matches == 0 for r in out)
    assert toxicity.score_toxicity(empty(spark), labels).collect() == []
    assert toxicity.score_toxicity(docs, labels.limit(0)).count() == docs.count()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="bundled data not present")
def test_held_out_documents_of_the_bundled_table(spark):
    path = DATA.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    assert sum(s >= 0.5 for s in toxic) >= 0.8 * len(toxic)
    assert sum(s >= 0.5 for s in clean) <= 0.01 * len(clean)
    better = sum((t > c) + (t == c) / 2 for t in toxic for c in clean)
    assert better >= 0.95 * len(toxic) * len(clean)
