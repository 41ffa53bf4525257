"""Hard negatives for anchors, by a secondary sort of scores.

The stated anchors meet all rows in blocks of ``BLOCK_ANCHORS`` by ``BLOCK_ROWS``. A first round keeps of every block an anchor's
best rows of its own label, hence its ``positives`` best over all: its positives. A second round keeps of every block, for each
positive, the best rows of other labels that lie in the positive's window. What is left, a few rows for each anchor and block, is keyed
by (anchor, descending score, kind, id), dealt out by anchor and sorted within partitions. One streaming pass over the sorted
partition opens a window at each positive and emits the negatives that follow until the window is full or left behind;
it holds the open windows of one anchor and nothing else. ``repartition`` and ``sortWithinPartitions`` are the
DataFrame form of the secondary-sort shuffle.

Component x enters as floor(256 * x), so scores are integers and exact: a block multiplies in doubles while no sum can pass
2 ** 53, else in Python integers.

Defined results: rows whose id, label or vector is null or empty, or that hold a null, non-finite or overflowing component, take no part. Of rows
that repeat an id the one with the least (label, vector) stays. Vectors meet those of their own length only. Ties go to the smaller id;
a negative with exactly a positive's score lies in its window. A positive with a negative score has an empty window.
Scores beyond the range of a long count as its ends in the result. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railweave.session import materialize

#: Anchors and rows of one block; tasks that blocks are dealt out to at most.
BLOCK_ANCHORS, BLOCK_ROWS, MOST_TASKS = 512, 4096, 20_000
#: Components are multiplied by this and rounded down.
SCALE = 256
LONG = (1 << 63) - 1

POSITIVES = "anchor_id long, id_ long, score_ long"


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products of two matrices of integer-valued doubles, as exact integers."""
    most = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * anchors.shape[1]
    if most < 2.0**53:
        return (anchors @ rows.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(anchors).dot(whole(rows).T)


def first(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, highest first, earlier places first among equals."""
    places = np.arange(len(score))
    if len(score) > k and score.dtype != object:
        places = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return places[np.argsort(-score[places], kind="stable")][:k]


def _clamped(score: int) -> int:
    return max(-LONG, min(LONG, int(score)))


def _block(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, np.ndarray]:
    """Anchors, rows in order of their ids, and their scores."""
    anchors = frame[frame.asks_]
    rows = frame[~frame.asks_].sort_values("id_")
    if anchors.empty or rows.empty:
        return anchors, rows, np.empty((len(anchors), len(rows)), dtype=np.int64)
    stacked = [np.floor(SCALE * np.stack(part.vector_.to_numpy()).astype(np.float64)) for part in (anchors, rows)]
    return anchors, rows, scores(*stacked)


def _best_positives(k: int):
    def best(frame: pd.DataFrame) -> pd.DataFrame:
        anchors, rows, table = _block(frame)
        ids, labels, out = rows.id_.to_numpy(), rows.label_.to_numpy(), []
        for anchor, label, row in zip(anchors.id_, anchors.label_, table):
            same = np.flatnonzero((labels == label) & (ids != anchor))
            out.extend((anchor, ids[p], _clamped(row[p])) for p in same[first(row[same], k)])
        return pd.DataFrame(out, columns=["anchor_id", "id_", "score_"])

    return best


def _window_negatives(k: int, low: int, high: int):
    """Per anchor and positive score the ``k`` best rows of other labels in the window of that score."""

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        anchors, rows, table = _block(frame)
        ids, labels, out = rows.id_.to_numpy(), rows.label_.to_numpy(), []
        for anchor, label, bars, row in zip(anchors.id_, anchors.label_, anchors.bars_, table):
            other = np.flatnonzero((labels != label) & (ids != anchor))
            score = row[other]
            kept: dict[int, int] = {}
            for bar in {int(b) for b in bars}:
                inside = np.flatnonzero((score <= bar) & (score >= -(-low * bar // high)))
                for p in inside[first(score[inside], k)]:
                    kept[int(ids[other[p]])] = _clamped(score[p])
            out.extend((anchor, i, s) for i, s in kept.items())
        return pd.DataFrame(out, columns=["anchor_id", "id_", "score_"])

    return best


def windows(sorted_rows: Iterator[tuple], k: int, low: int, high: int) -> Iterator[tuple]:
    """The negatives of every positive, from (anchor, id, score, is a negative) sorted by anchor and descending score, positives
    first among equal scores, then by id: (anchor, positive, rank, negative, positive score, negative score)."""
    at, opened = None, []
    for anchor, row, score, is_negative in sorted_rows:
        if anchor != at:
            at, opened = anchor, []
        if not is_negative:
            opened.append([row, score, 0])
            continue
        opened = [w for w in opened if w[2] < k and low * w[1] <= high * score]
        for window in opened:
            window[2] += 1
            yield anchor, window[0], window[2], row, window[1], score


def _stream(k: int, low: int, high: int):
    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

        def rows() -> Iterator[tuple]:
            for frame in frames:
                yield from zip(
                    frame.anchor_id.tolist(), frame.id_.tolist(), frame.score_.tolist(), frame.is_negative_.tolist()
                )

        batch = []
        for row in windows(rows(), k, low, high):
            batch.append(row)
            if len(batch) == 10_000:
                yield pd.DataFrame(batch, columns=columns)
                batch = []
        yield pd.DataFrame(batch, columns=columns)

    return stream


def _usable(vector: Column) -> Column:
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * SCALE < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fits, F.lit(False))


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """Per anchor and positive the first negatives whose scores lie between low/high of the positive's score and that score:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    own_label = F.col(label) if isinstance(label, str) else label
    rows = (
        vectors.select(
            F.col(id_column).cast("long").alias("id_"),
            own_label.cast("long").alias("label_"),
            F.col(vector_column).cast("array<double>").alias("vector_"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks_"),
        )
        .where(_usable(F.col("vector_")) & F.col("id_").isNotNull() & F.col("label_").isNotNull())
        .groupBy("id_")
        .agg(F.min(F.struct("label_", "vector_")).alias("row_"), F.max("asks_").alias("asks_"))
        .select("id_", "row_.label_", "row_.vector_", "asks_", F.size("row_.vector_").alias("dim_"))
    )
    rows = materialize(rows, "negatives-rows")
    grid = rows.groupBy("dim_").agg(
        F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("down_"),
        F.ceil(F.count_if("asks_") / BLOCK_ANCHORS).cast("int").alias("across_"),
    )
    grid = materialize(grid.where("across_ > 0"), "negatives-grid")
    blocks = grid.agg(F.sum(F.col("down_").cast("long") * F.col("across_"))).first()[0] or 1

    def in_blocks(anchors: DataFrame, pick: Callable) -> DataFrame:
        """``pick`` of every block; anchors have bars_, the scores of their positives."""

        def placed(df: DataFrame, asks: bool, *more: Column) -> DataFrame:
            own, other = ("across_", "down_") if asks else ("down_", "across_")
            at = F.pmod(F.xxhash64(F.lit(5), "id_"), F.col(own)).cast("int").alias("own_")
            spread = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("other_")
            spread_rows = df.join(grid, "dim_").select("dim_", at, spread, "id_", "label_", "vector_", *more)
            down, across = ("other_", "own_") if asks else ("own_", "other_")
            return spread_rows.select(
                "dim_", F.col(down).alias("down_"), F.col(across).alias("across_"), F.lit(asks).alias("asks_"),
                "id_", "label_", "vector_", "bars_",
            )

        key = ["dim_", "down_", "across_"]
        both = placed(anchors, True, F.col("bars_")).unionByName(
            placed(rows, False, F.lit(None).cast("array<long>").alias("bars_"))
        )
        dealt = both.repartition(min(int(blocks), MOST_TASKS), *key)
        return dealt.groupBy(*key).applyInPandas(pick, POSITIVES)

    anchors = rows.where("asks_")
    found = in_blocks(anchors.withColumn("bars_", F.lit(None).cast("array<long>")), _best_positives(positives))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score_"), "id_")
    ranked = found.withColumn("place_", F.row_number().over(order)).where(F.col("place_") <= positives)
    best = materialize(ranked.drop("place_"), "negatives-positives")
    bars = best.groupBy(F.col("anchor_id").alias("id_")).agg(F.collect_set("score_").alias("bars_"))
    inside = in_blocks(anchors.join(bars, "id_"), _window_negatives(negatives, low, high))
    keyed = best.withColumn("is_negative_", F.lit(False)).unionByName(inside.withColumn("is_negative_", F.lit(True)))
    in_order = keyed.repartition("anchor_id").sortWithinPartitions(
        "anchor_id", F.desc("score_"), "is_negative_", "id_"
    )
    return in_order.mapInPandas(
        _stream(negatives, low, high),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
