"""Exact dedup: sorted runs of digests merged up a tree.

Every row becomes (digest, length, second hash, identifier) and belongs to one of ``2 ** levels``
runs. In each round every task sorts the entries of its runs and walks them in order, so that equal
entries become one; the sorted runs whose numbers agree but for the lowest ``fan_bits`` bits are then
exchanged, digest by digest, and merged in order into one run. What stays of equal entries is their
best identifier and their row count. Entries are equal only if length and second hash agree too, at
every level, so that a digest alone never decides. After the last round one run is left, which is
the table of groups. A group of any size arrives at a reducer as one entry per task and run.

Defined results: null text counts as empty, and empty texts form one group like any other. A null
identifier never wins over another; a group with only null identifiers keeps its rows. Rows that
repeat identifier and text are the same document and share its verdict; ``drop_exact_copies`` keeps a
single row of either kind if asked for ``one_per_text``, as the pipeline does. Empty tables give empty
results; extra columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.llm.text import ascii_lower, packed, plain_text, unpacked
from railweave.session import materialize

#: The tree starts from 2 ** LEVELS runs and merges 2 ** FAN_BITS of them at a time.
LEVELS, FAN_BITS = 6, 3
KEY = ["digest_", "length_", "second_"]


def _with_digest(df: DataFrame, text_column: str) -> DataFrame:
    normal = ascii_lower(plain_text(F.col(text_column)))
    return (
        df.withColumn("normal_", normal)
        .withColumn("digest_", F.sha2("normal_", 256))
        .withColumn("length_", F.octet_length("normal_"))
        .withColumn("second_", F.xxhash64("normal_"))
        .drop("normal_")
    )


def merge_runs(
    entries: DataFrame, keep: str = "largest", levels: int = LEVELS, fan_bits: int = FAN_BITS
) -> DataFrame:
    """Merges runs of (digest_, length_, second_, id_) to one row per text: keep_id_, group_size_.

    ``keep`` names the identifier that survives every level: ``largest`` or ``smallest``. It travels in a
    struct, for which Spark aggregates sorted entries instead of hashing them: sort and merge within the
    task, exchange, sort and merge across tasks.
    """
    best = {"largest": F.max, "smallest": F.min}[keep]
    run = F.pmod(F.xxhash64(F.lit(7), "id_"), F.lit(1 << levels)).cast("int")
    # Null identifiers take no part, as no struct is made for them.
    held = F.when(F.col("id_").isNotNull(), F.struct(F.col("id_").alias("id")))
    merged = entries.select(run.alias("run_"), *KEY, held.alias("held_"), F.lit(1).cast("long").alias("group_size_"))
    left = levels
    while left >= 0:
        merged = merged.groupBy("run_", *KEY).agg(
            best("held_").alias("held_"), F.sum("group_size_").alias("group_size_")
        )
        if left == 0:
            return merged.select(*KEY, F.col("held_.id").alias("keep_id_"), "group_size_")
        step = min(fan_bits, left)
        merged, left = merged.withColumn("run_", F.shiftright("run_", step)), left - step
    return merged


def dedup_report(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest"
) -> DataFrame:
    """A row for each row of ``docs``: the id, keep_id, group_size, kept, text_sha256."""
    entries = materialize(
        _with_digest(
            docs.select(F.col(id_column).alias("id_"), F.col(text_column).alias("text_")), "text_"
        ).select("id_", *KEY),
        "digests",
    )
    # Written first: the join then reads two plain tables, and Spark can split a frequent digest.
    groups = materialize(merge_runs(entries, keep), "digest-groups")
    return entries.join(groups, KEY).select(
        F.col("id_").alias(id_column),
        F.col("keep_id_").alias("keep_id"),
        F.col("group_size_").alias("group_size"),
        F.col("id_").eqNullSafe(F.col("keep_id_")).alias("kept"),
        F.col("digest_").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest", one_per_text: bool = False
) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``.

    With ``one_per_text`` one row stays of those that repeat identifier and text, and one of a group without identifiers.
    """
    schema = docs.schema
    rows = _with_digest(
        packed(docs).withColumn("text_", F.col(f"row_.`{text_column}`")), "text_"
    ).withColumn("id_", F.col(f"row_.`{id_column}`"))
    entries = rows.select("id_", *KEY)
    if one_per_text:
        entries = materialize(entries, "digests")
    groups = merge_runs(entries, keep)
    # Only texts that occur more than once are looked up. Their number follows the input, so the join is a
    # merge at every size; Spark splits a frequent digest.
    repeated = materialize(groups.where("group_size_ > 1"), "digest-groups")
    joined = rows.join(repeated.hint("merge"), KEY, "left")
    stays = F.col("group_size_").isNull() | F.col("id_").eqNullSafe(F.col("keep_id_"))
    kept = joined.where(stays)
    if one_per_text:
        # Texts whose identifier that stays is that of several rows.
        pairs = entries.groupBy("id_", *KEY).agg(F.count("*").alias("rows_")).where("rows_ > 1").drop("rows_")
        best = repeated.select(*(F.col(k).alias(f"of_{k}") for k in KEY), "keep_id_")
        same_text = [F.col(k) == F.col(f"of_{k}") for k in KEY]
        tied = materialize(
            materialize(pairs, "digest-pairs")
            .join(best.hint("merge"), [*same_text, F.col("id_").eqNullSafe(F.col("keep_id_"))])
            .select("id_", *KEY),
            "digest-ties",
        )
        if not tied.isEmpty():
            # Rows are reduced by identifier and text within each task before any of them meet.
            one = rows.dropDuplicates(["id_", *KEY]).join(
                tied.select(*(F.col(k).alias(f"of_{k}") for k in KEY), F.col("id_").alias("of_id_")).hint("merge"),
                [*same_text, F.col("id_").eqNullSafe(F.col("of_id_"))],
                "left_semi",
            )
            kept = kept.join(tied.select(*KEY).hint("merge"), KEY, "left_anti").select("row_").unionByName(one.select("row_"))
    return unpacked(kept, schema)
