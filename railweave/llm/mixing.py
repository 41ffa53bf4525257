"""Mixing sources to target weights by exponential keys.

Source targets: weights are dealt to the sources in code-point order; the wanted total is shared by
weight, a target stops at ``max_epochs`` times its source, and the excess is reshared by weight until
no target is above its bound. The targets so reached are ``min(bound, level * weight)`` with one
common level, which a running sum over the sources in order of ``bound / weight`` finds.

Documents: the whole part of target / source size is taken as complete epochs of the source. What
remains is selected by Efraimidis and Spirakis: each document gets the key ``-ln(u) / quality`` with u
uniform from its id, and documents are taken in key order while the prefix sum of their sizes stays
within the remaining budget. The budget that the prefix leaves is given to the one later document
whose size comes nearest to it, if that brings the source nearer to its target.

The sort within a source is cut into slices of the key's distribution. Slice sums are aggregated
before the shuffle, prefix sums run over slices, and only inside a slice over documents, so
a source with a third of all rows is spread over ``slices`` groups; the result is that of one sort.

Defined results: null text has size 0 and takes 0; the null source comes last in the order; null
ids sort first among equal keys; a null, zero, negative or infinite quality counts as 1. Rows that repeat an id
have equal keys: they are taken in the order of their size, and equal rows are interchangeable. The mixed corpus has each row as
often as its own plan says; rows are told apart by all their columns.
Empty tables and tables without words give targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railweave.llm.text import packed, plain_text, unpacked, word_count
from railweave.session import materialize

WEIGHTS = (5, 2, 1)
SHARE, MAX_EPOCHS, SLICES = 1.5, 2, 4096


def uniform(id_column: Column) -> Column:
    """A number in (0, 1) from the id alone: reruns and other engines get the same."""
    digits = F.substring(F.md5(F.coalesce(id_column.cast("string"), F.lit(""))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source_, source_size_) to the same with target_. One row per source goes in: the two ordered
    windows run over sources, not over documents."""
    rank = F.row_number().over(Window.orderBy(F.col("source_").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    bound = F.col("source_size_") * F.lit(float(max_epochs))
    by_ratio = Window.orderBy("ratio_", "rank_")
    before, total = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    ordered = (
        sizes.select("*", rank.alias("rank_"), weight.alias("weight_"), bound.alias("bound_"))
        .withColumn("ratio_", F.col("bound_") / F.col("weight_"))
        .withColumn("below_", F.coalesce(F.sum("bound_").over(before), F.lit(0.0)))
        .withColumn("weight_below_", F.coalesce(F.sum("weight_").over(before), F.lit(0.0)))
        .withColumn("wanted_", F.sum("source_size_").over(total) * F.lit(float(share)))
        .withColumn("weights_", F.sum("weight_").over(total))
        # The level if this source and all with a larger ratio are the ones below their bound.
        .withColumn("level_", (F.col("wanted_") - F.col("below_")) / (F.col("weights_") - F.col("weight_below_")))
        .withColumn("common_", F.max(F.when(F.col("level_") <= F.col("ratio_"), F.col("level_"))).over(total))
    )
    capped = F.least(F.col("bound_"), F.coalesce(F.col("common_"), F.lit(float("inf"))) * F.col("weight_"))
    return ordered.select("source_", "source_size_", F.round(capped, 6).alias("target_"))


def plan_mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    quality: DataFrame | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    slices: int = SLICES,
    mark: Column | None = None,
) -> DataFrame:
    """A row per row of ``docs``: id_, source_, size_, key_, source_size_, target_, taken_, and mark_ if a ``mark`` of the rows is given.

    ``quality`` gives weights by id in the columns (id, quality); the largest counts if there are
    several, and documents without one weigh 1.
    """
    sized = docs.select(
        F.col(id_column).alias("id_"),
        F.col(source_column).alias("source_"),
        word_count(F.col(text_column)).alias("size_"),
        *([] if mark is None else [mark.alias("mark_")]),
    )
    marks = [] if mark is None else ["mark_"]
    good = F.lit(1.0)
    if quality is not None:
        by_id = quality.groupBy(F.col("id").alias("of_")).agg(F.max(F.col("quality").cast("double")).alias("quality_"))
        sized = sized.join(by_id, F.col("id_") == F.col("of_"), "left").drop("of_")
        known = (F.col("quality_") > 0) & (F.col("quality_") < float("inf"))
        good = F.when(known, F.col("quality_")).otherwise(1.0)
    # 1 - exp(-key) rises with the key and spreads it over (0, 1).
    spread = F.floor((1 - F.exp(-F.col("key_"))) * slices)
    sized = materialize(
        sized.withColumn("key_", -F.log(uniform(F.col("id_"))) / good)
        .withColumn("slice_", F.least(spread, F.lit(slices - 1)).cast("int"))
        .drop("quality_"),
        "mix-sizes",
    )
    slice_sums = materialize(
        sized.groupBy("source_", "slice_").agg(F.sum("size_").alias("slice_size_")), "mix-slices"
    )
    targets = source_targets(slice_sums.groupBy("source_").agg(F.sum("slice_size_").alias("source_size_")), weights, share, max_epochs)
    epochs = F.when(F.col("source_size_") > 0, F.floor(F.col("target_") / F.col("source_size_"))).otherwise(0)
    targets = targets.withColumn("epochs_", epochs.cast("long")).withColumn(
        "budget_", F.col("target_") - F.col("epochs_") * F.col("source_size_")
    )
    earlier = Window.partitionBy("source_").orderBy("slice_").rowsBetween(Window.unboundedPreceding, -1)
    starts = slice_sums.withColumn("start_", F.coalesce(F.sum("slice_size_").over(earlier), F.lit(0)))
    starts = materialize(
        starts.join(targets.withColumnRenamed("source_", "of_"), F.col("source_").eqNullSafe(F.col("of_")))
        .drop("slice_size_", "of_"),
        "mix-targets",
    )
    placed = sized.join(
        starts.withColumnsRenamed({"source_": "of_", "slice_": "at_"}),
        F.col("source_").eqNullSafe(F.col("of_")) & (F.col("slice_") == F.col("at_")),
    ).drop("of_", "at_")
    inside = (
        Window.partitionBy("source_", "slice_").orderBy("key_", "id_", "size_", *marks).rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = materialize(
        placed.withColumn("through_", F.col("start_") + F.sum("size_").over(inside)).drop("start_", "slice_"),
        "mix-prefix",
    )
    within = F.col("through_") <= F.col("budget_")
    # Per source: what the prefix leaves, and the one later document that fits it best.
    left = placed.groupBy("source_").agg(
        F.max(F.when(within, F.col("through_")).otherwise(0)).alias("prefix_"), F.max("budget_").alias("of_budget_")
    ).select("source_", (F.col("of_budget_") - F.col("prefix_")).alias("left_"))
    left = materialize(left, "mix-left").withColumnRenamed("source_", "of_")
    rest = placed.where(~within & (F.col("size_") > 0)).join(left, F.col("source_").eqNullSafe(F.col("of_"))).drop("of_")
    miss = F.abs(F.col("size_") - F.col("left_"))
    extra = materialize(
        rest.where(miss < F.col("left_"))
        .groupBy("source_")
        .agg(F.min(F.struct(miss.alias("m"), F.col("key_").alias("k"), F.col("id_").alias("i"), F.col("through_").alias("t"))).alias("best_"))
        .select(F.col("source_").alias("of_"), F.col("best_.k").alias("best_key_"), F.col("best_.i").alias("best_id_"), F.col("best_.t").alias("best_through_")),
        "mix-extra",
    )
    chosen = (
        within
        | (
            F.col("best_key_").isNotNull()
            & (F.col("key_") == F.col("best_key_"))
            & F.col("id_").eqNullSafe(F.col("best_id_"))
            & (F.col("through_") == F.col("best_through_"))
            & (F.col("size_") > 0)
        )
    )
    return placed.join(extra, F.col("source_").eqNullSafe(F.col("of_")), "left").select(
        "id_", "source_", "size_", "key_", "source_size_", "target_",
        (F.col("size_") * (F.col("epochs_") + F.when(chosen, 1).otherwise(0))).alias("taken_"),
        *marks,
    )


def _row_mark(columns: dict[str, Column], text_column: str) -> Column:
    """A digest of the whole row: rows with one mark are equal in all columns."""
    others = F.struct(*(column.alias(name) for name, column in columns.items() if name != text_column))
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.sha2(F.concat(F.to_json(others, exact), plain_text(columns[text_column])), 256)


def mix(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options
) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: each document as often as it was taken.

    Rows that repeat an id, or have none, are told apart by all their columns. Rows that agree in all are
    interchangeable and come as often as they were taken together.
    """
    schema = docs.schema
    mark = _row_mark({c: F.col(f"`{c}`") for c in docs.columns}, text_column)
    taken = plan_mix(docs, id_column, text_column, source_column, mark=mark, **options)
    plan = taken.where("size_ > 0").groupBy("id_", "source_", "mark_").agg(
        F.sum(F.expr("taken_ div size_")).alias("times_"), F.count("*").alias("rows_")
    )
    rows = packed(docs).select(
        "row_",
        F.col(f"row_.`{id_column}`").alias("of_id_"),
        F.col(f"row_.`{source_column}`").alias("of_source_"),
        _row_mark({c: F.col(f"row_.`{c}`") for c in docs.columns}, text_column).alias("of_mark_"),
    )
    same = (
        F.col("of_id_").eqNullSafe(F.col("id_"))
        & F.col("of_source_").eqNullSafe(F.col("source_"))
        & (F.col("of_mark_") == F.col("mark_"))
    )
    # The plan follows the input, so the join is a merge at every size.
    plan = materialize(plan.where("times_ > 0"), "mix-plan")
    once = rows.join(plan.where("rows_ = 1").hint("merge"), same)
    copies = once.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("times_").cast("int"))))
    several = plan.where("rows_ > 1")
    if not several.isEmpty():
        # One of the equal rows gives all their copies, in chunks, so that no task makes all copies of a frequent row.
        chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(times_ - 1) div 1000")))
        chunks = materialize(several.withColumn("chunk_", chunk), "mix-repeated")
        one = rows.dropDuplicates(["of_id_", "of_source_", "of_mark_"])
        inside = F.least(F.lit(1000).cast("long"), F.col("times_") - 1000 * F.col("chunk_")).cast("int")
        repeated = one.join(chunks.hint("merge"), same).withColumn("copy_", F.explode(F.sequence(F.lit(1), inside)))
        copies = copies.select("row_").unionByName(repeated.select("row_"))
    return unpacked(copies, schema)
