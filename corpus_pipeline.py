"""From raw documents to packed windows: language, exact and near copies, source mix, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns
of ``docs``. Each stage's result is written to the shared folder and read back for the next, so that no
stage depends on the executors of an earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railweave.llm import exact_dedup, language, mixing, near_dedup, packing
from railweave.llm.queries import labelled_quality
from railweave.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go."""
    return language.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays, as a single row."""
    return exact_dedup.drop_exact_copies(docs, one_per_text=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs, quality=labelled_quality(spark, sf_dir))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per packed window, with the ids, places and text of its pieces."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("best-fit packing", pack_windows),
]

#: SQL cannot express language ID, exponential-key packing order and best fit; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
