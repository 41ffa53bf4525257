"""Nearest neighbours by cross-polytope hashing, reranked exactly.

Unit vectors are turned by pseudo-rotations (three rounds of random signs and a fast Hadamard transform); the
hash is the nearest signed axis. Each of ``tables`` rotations is a table; a query probes in it the axes nearest
to it, ``probes`` of them. Candidates share a bucket with a probe and are ranked by the exact cosine of
the original vectors in double precision.

A bucket of any size is cut into blocks of about ``BLOCK`` vectors by ``BLOCK`` queries; equal
vectors in a block are compared once and stand for their smallest ids. A query that finds fewer than ``k`` is
compared with all vectors, in the same blocks.

Recall at 5, measured against brute force with the default 12 tables and 12 probes: 0.999 on 51,282 vectors of 64 dimensions,
most of them without any near neighbour (their fifth has a cosine of about 0.45), and above 0.95 on 500 (about 0.35).

Defined results: vectors that are null, zero, or hold null or non-finite numbers neither ask nor answer. Vectors are
compared with those of their own length only. Ties go to the smaller id. Rows that repeat an id count as one
candidate, with its best score, and as one query, likewise. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railweave.session import materialize

TABLES, PROBES, BLOCK, TASK_ROWS, SEED = 12, 12, 2048, 8192, 20
#: More than rough scores of unit vectors are off by.
ROUNDING = 1e-9


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal fast Hadamard transform of the rows."""
    rows, n = x.shape
    half = 1
    while half < n:
        pairs = x.reshape(rows, n // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, tables: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """The rows, padded to a power of two, under one pseudo-rotation per table."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    signs = np.random.default_rng([seed, width]).choice([-1.0, 1.0], size=(tables, 3, width))
    for table in range(tables):
        y = padded
        for round_signs in signs[table]:
            y = hadamard(y * round_signs)
        yield y


def axes(y: np.ndarray, probes: int) -> np.ndarray:
    """Per row the ``probes`` nearest signed axes, nearest first, as 2 * axis + (1 if negative)."""
    order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :probes]
    return 2 * order + (np.take_along_axis(y, order, axis=1) < 0)


def _code(tables: int, probes: int):
    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, part in frame.groupby("dim_"):
                x = np.stack(part.vector_.to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                found = np.stack([_padded(axes(y, probes), probes) for y in rotated(x, tables)], axis=1)
                asks = part.asks_.to_numpy()
                yield pd.DataFrame(
                    {
                        "id_": part.id_.to_numpy(),
                        "dim_": part.dim_.to_numpy(),
                        "codes_": list(found[:, :, 0]),
                        "probes_": [row.tolist() if ask else None for row, ask in zip(found, asks)],
                        "vector_": part.vector_.to_numpy(),
                    }
                )

    return code


def _padded(codes: np.ndarray, probes: int) -> np.ndarray:
    """Short vectors have fewer axes than probes: the rest of the row is -1."""
    out = np.full((len(codes), probes), -1, dtype=np.int32)
    out[:, : codes.shape[1]] = codes
    return out


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row sums in a fixed order, so that equal vectors have equal scores wherever they are compared."""
    q = query / np.abs(query).max()
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (v * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum(axis=1)))


def _nearest(k: int):
    """The ``k`` nearest of every query in every block of a frame (block_, asks_, id_, vector_)."""

    def nearest(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in frame.groupby("block_"):
            asking, answers = block[block.asks_], block[~block.asks_].sort_values("id_")
            if asking.empty or answers.empty:
                continue
            vectors = np.stack(answers.vector_.to_numpy()).astype(np.float64)
            vectors, member = np.unique(vectors, axis=0, return_inverse=True)
            ids: list[list[int]] = [[] for _ in vectors]
            for vector_id, m in zip(answers.id_.tolist(), member.ravel().tolist()):
                # One more than asked for, as the query itself does not count.
                if len(ids[m]) <= k and ids[m][-1:] != [vector_id]:
                    ids[m].append(vector_id)
            unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
            questions = np.stack(asking.vector_.to_numpy()).astype(np.float64)
            # The query may be a candidate itself, and ids may repeat: the k-th place is among the first of these.
            most = min(len(vectors), k + 1 + len(answers) - answers.id_.nunique())
            for low in range(0, len(questions), 256):
                part = questions[low : low + 256] / np.abs(questions[low : low + 256]).max(axis=1, keepdims=True)
                rough = part @ unit.T
                # All that rounding may have put behind it are ranked exactly, so ties of any number go to the smaller ids.
                least = -np.partition(-rough, most - 1, axis=1)[:, most - 1] - ROUNDING * np.sqrt((part * part).sum(axis=1))
                for query_id, query, row, bar in zip(asking.id_.tolist()[low : low + 256], questions[low:], rough, least):
                    places = np.flatnonzero(row >= bar)
                    scores = cosines(query, vectors[places]).tolist()
                    found: dict[int, float] = {}
                    for score, place in zip(scores, places):
                        for i in ids[place]:
                            if i != query_id:
                                found[i] = max(score, found.get(i, -2.0))
                    ranked = sorted((-score, i) for i, score in found.items())
                    out.extend((query_id, i, -score) for score, i in ranked[:k])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return nearest


def _in_blocks(asking: DataFrame, answers: DataFrame, key: list[str], k: int) -> DataFrame:
    """Compares queries and vectors of equal ``key``; both have key, id_, vector_."""
    counts = (
        answers.groupBy(*key).agg(F.count("*").alias("n_"))
        .join(asking.groupBy(*key).agg(F.count("*").alias("m_")), key)
        .withColumn("rows_", F.ceil(F.col("n_") / BLOCK).cast("int"))
        .withColumn("columns_", F.ceil(F.col("m_") / BLOCK).cast("int"))
    )
    grid = materialize(counts, "ann-grid")
    total = grid.agg(F.sum(F.col("n_") * F.col("columns_") + F.col("m_") * F.col("rows_"))).first()[0] or 0
    grid = grid.drop("n_", "m_")

    def placed(df: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        at = F.pmod(F.xxhash64(F.lit(3), "id_"), F.col(own)).cast("int").alias("own_")
        spread = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("other_")
        both = df.join(grid, key).select(*key, "id_", "vector_", at, spread)
        row, column = ("other_", "own_") if asks else ("own_", "other_")
        return both.select(F.xxhash64(*key, row, column).alias("block_"), F.lit(asks).alias("asks_"), "id_", "vector_")

    rows = placed(asking, "columns_", "rows_", True).unionByName(placed(answers, "rows_", "columns_", False))
    task = F.pmod(F.xxhash64("block_"), F.lit(max(1, -(-total // TASK_ROWS)))).alias("task_")
    return rows.groupBy(task).applyInPandas(_nearest(k), "query_id long, vec_id long, score double")


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 5,
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """Per query its ``k`` nearest vectors other than itself: query_id, rank, vec_id, score."""
    element = vectors.schema[vector_column].dataType.elementType
    kind = T.ArrayType(element if isinstance(element, T.FloatType) else T.DoubleType())
    usable = (
        vectors.select(
            F.col(id_column).cast("long").alias("id_"),
            F.col(vector_column).cast(kind).alias("vector_"),
            F.coalesce(is_query, F.lit(False)).alias("asks_"),
        )
        .where(_usable(F.col("vector_")) & F.col("id_").isNotNull())
        .withColumn("dim_", F.size("vector_"))
    )
    schema = T.StructType(
        [
            T.StructField("id_", T.LongType()),
            T.StructField("dim_", T.IntegerType()),
            T.StructField("codes_", T.ArrayType(T.IntegerType())),
            T.StructField("probes_", T.ArrayType(T.ArrayType(T.IntegerType()))),
            T.StructField("vector_", kind),
        ]
    )
    coded = materialize(usable.mapInPandas(_code(tables, probes), schema), "ann-codes")
    key = ["dim_", "table_", "code_"]
    answers = coded.select("dim_", F.posexplode("codes_").alias("table_", "code_"), "id_", "vector_")
    asking = (
        coded.where(F.col("probes_").isNotNull())
        .select("dim_", F.posexplode("probes_").alias("table_", "list_"), "id_", "vector_")
        .select("dim_", "table_", F.explode("list_").alias("code_"), "id_", "vector_")
        .where("code_ >= 0")
    )

    def best(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    ranked = materialize(best(_in_blocks(asking, answers, key, k)), "ann-ranked")
    full = ranked.where(F.col("rank") == k).select(F.col("query_id").alias("id_"))
    queries = coded.where(F.col("probes_").isNotNull()).select("dim_", "id_", "vector_")
    short = materialize(queries.join(full, "id_", "left_anti"), "ann-short")
    if not short.isEmpty():
        every = best(_in_blocks(short, coded.select("dim_", "id_", "vector_"), ["dim_"], k))
        ranked = ranked.join(short.select(F.col("id_").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(every)
    return ranked.select("query_id", "rank", "vec_id", "score")
