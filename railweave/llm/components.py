"""Connected components of a link table, by alternating large-star and small-star steps.

Every step aggregates before it shuffles and writes its table, so that a vertex with a third of all
links arrives at a reducer as a few rows, and the joins read plain tables that Spark can split. Tables are written in
as many files as their links fill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.session import materialize

MAX_ROUNDS = 60
LINKS_PER_FILE = 250_000


def _mark(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(u, v) links in either direction to (u, component) for every linked vertex that is not itself the least of its component."""
    up = materialize(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "links"
    )
    before = _mark(up)
    # A step at most doubles the links.
    files = 1 + before[0] // LINKS_PER_FILE

    def stored(df: DataFrame, label: str) -> DataFrame:
        return materialize(df.coalesce(files), label)

    for _ in range(MAX_ROUNDS):
        both = up.unionByName(up.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = stored(least, "links-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "links-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        up = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _mark(up)
        if now == before:
            return up.select("u", F.col("v").alias("component"))
        before = now
    raise RuntimeError("Components did not settle")
