"""Near-duplicate detection: chosen-path set similarity join over five-word shingles.

1. Every whole text becomes its set of shingle hashes, 64 MinHash values and a digest of the set. Equal
   sets form a class; only class representatives go on.
2. ``TREES`` independent trees branch the representatives. A node chooses ``BRANCHES`` of the 64 values
   (from a hash of its path) and deals its members to children by them. A node of at most ``SMALL``
   members is compared exhaustively, on the MinHash estimates. In a larger one every member is compared with its least
   member. Members like it are tied to it; if the others are few, they are compared with all, else the node is
   branched again, down to ``DEPTH``. Estimates only sort out pairs: they are kept down to ``MARGIN`` below the
   threshold, which is over five standard deviations, and members of large nodes that are still together at the full
   depth all stay together. What is kept forms clusters of candidates.
3. Candidates are compared on their full sets, blockwise, by counting common shingles. A cluster of any size is dealt out in blocks;
   each block holds the cluster's least member too, so that the links inside blocks join most of the cluster.
   What they leave apart is compared with every block of the cluster, in chunks of bounded size.
4. Links are closed to components; only links that span them are written, never all pairs of a group.

Recall: at similarity ``s`` a pair in small nodes is missed with probability ``(1 - s) ** (trees * branches)``,
which is 6e-8 at 0.75; deeper, a tree keeps the pair with about 0.9 at 0.75, and six trees miss 1e-6.

Defined results: null and empty texts have no shingles, are linked with nothing and stay. Fewer than five
words make one shingle. Rows without an id are linked with nothing; rows that repeat an id are one vertex. Long texts are
hashed whole. Empty tables give empty results; extra columns are untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.llm.components import components
from railweave.llm.shingles import MinHash, Shingles
from railweave.llm.text import bound_batches, packed, unpacked
from railweave.session import materialize

THRESHOLD_PERCENT = 75
VALUES, TREES, BRANCHES, DEPTH, SMALL = 64, 6, 2, 4, 256
MARGIN = 0.29
# A larger node is compared as well if it has at most so many members and pairs to compare.
WIDE, PAIRS = 16_384, 4_000_000
#: Members per block, and rows that a task holds at once, about.
BLOCK, TASK_ROWS = 512, 2048

_SIGNED = pa.schema(
    [
        ("id_", pa.int64()),
        ("n_", pa.int64()),
        ("set_a_", pa.int64()),
        ("set_b_", pa.int64()),
        ("values_", pa.list_(pa.int32())),
    ]
)
SIGNED = "id_ long, n_ long, set_a_ long, set_b_ long, values_ array<int>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles, minhash = Shingles(), MinHash(VALUES)
    for batch in batches:
        sizes, digests, values = [], [], []
        for hashes in shingles.sets(batch.column(1)):
            sizes.append(len(hashes))
            digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            values.append(minhash.of(hashes))
        digest = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
        flat = np.concatenate([*values, np.empty(0, dtype=np.uint32)]).view(np.int32)
        offsets = np.arange(0, (len(sizes) + 1) * VALUES, VALUES, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(digest[:, 0].copy(), pa.int64()),
                pa.array(digest[:, 1].copy(), pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
            ],
            schema=_SIGNED,
        )


def _forest(pairs: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """Of the given index pairs, those that join what was apart."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs.tolist():
        a_root, b_root = root(a), root(b)
        if a_root != b_root:
            parent[max(a_root, b_root)] = min(a_root, b_root)
            yield a, b


def _compare_estimates(least: float):
    """Spanning candidate links inside every node of a frame (node_, first_, id_, values_): members marked ``first_`` are
    compared with all."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, node in frame.groupby("node_"):
            node = node.sort_values(["first_", "id_"], ascending=[False, True])
            values, marked = np.stack(node.values_.to_numpy()).T.copy(), int(node.first_.sum())
            ids = node.id_.tolist()
            for low in range(0, marked, SMALL):
                high = min(low + SMALL, marked)
                agree = np.zeros((high - low, len(node)), dtype=np.uint8)
                for column in values:
                    agree += column[low:high, None] == column
                pairs = np.argwhere(agree >= least * len(values)) + [low, 0]
                links.extend((ids[a], ids[b]) for a, b in _forest(pairs[pairs[:, 0] < pairs[:, 1]], len(ids)))
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return compare


def similar(sets: list[np.ndarray], against: int, percent: int, width: int = 4096) -> np.ndarray:
    """Index pairs (i, j), i < j, of sets with 100 * common >= percent * union, where i < ``against``.

    Counts common hashes as a product of 0/1 matrices, ``width`` hashes at a time.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    _, codes = np.unique(np.concatenate([*sets, np.empty(0, dtype=np.uint64)]), return_inverse=True)
    shared = np.flatnonzero(np.bincount(codes, minlength=1) > 1) if len(codes) else np.empty(0, dtype=np.int64)
    place = np.full(int(codes.max()) + 1 if len(codes) else 1, -1, dtype=np.int64)
    place[shared] = np.arange(len(shared))
    at = place[codes]
    owners, at = owners[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    owners, at = owners[order], at[order]
    common = np.zeros((against, len(sets)), dtype=np.float32)
    for low in range(0, len(shared), width):
        part = slice(*np.searchsorted(at, [low, low + width]))
        member = np.zeros((len(sets), min(width, len(shared) - low)), dtype=np.float32)
        member[owners[part], at[part] - low] = 1
        common += member[:against] @ member.T
    common = common.astype(np.int64)
    union = sizes[:against, None] + sizes - common
    found = np.argwhere(100 * common >= percent * union)
    return found[found[:, 0] < found[:, 1]]


def _compare_sets(percent: int):
    """Spanning links inside every block of a frame (block_, first_, id_, set_): members marked ``first_`` are compared with
    all, or all with all where none is marked."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, block in frame.groupby("block_"):
            block = block.sort_values(["first_", "id_"], ascending=[False, True])
            marked = int(block.first_.sum())
            sets = [np.frombuffer(x, dtype=np.uint64) for x in block.set_]
            pairs = similar(sets, marked or len(sets), percent)
            ids = block.id_.tolist()
            links.extend((ids[a], ids[b]) for a, b in _forest(pairs, len(ids)) if ids[a] != ids[b])
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return compare


def _in_tasks(df: DataFrame, key: Column, rows: int, function, schema: str = "u long, v long") -> DataFrame:
    """Applies ``function`` to whole groups of ``key``, about TASK_ROWS rows at a time."""
    task = F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows // TASK_ROWS)))).alias("task_")
    return df.groupBy(task).applyInPandas(function, schema)


def _candidate_links(reps: DataFrame, least: float) -> DataFrame:
    """Links that join candidates, from the nodes of all trees. ``reps`` has id_, values_."""
    roots = F.array(
        *(F.xxhash64(F.lit(c // BRANCHES), F.lit(c), F.col("values_")[c]) for c in range(TREES * BRANCHES))
    )
    members = reps.select(F.explode(roots).alias("node_"), "id_")
    compare, links = _compare_estimates(least), []

    def compared(chosen: DataFrame, label: str) -> None:
        """Compares the members of whole nodes; those marked with all."""
        chosen = materialize(chosen.select("node_", "first_", "id_"), "path-chosen")
        rows = chosen.count()
        if rows:
            links.append(materialize(_in_tasks(chosen.join(reps, "id_"), F.col("node_"), rows, compare).distinct(), label))

    for level in range(1, DEPTH + 1):
        members = materialize(members, "path-members")
        nodes = materialize(
            members.groupBy("node_").agg(F.count("*").alias("size_"), F.min("id_").alias("least_")).where("size_ > 1"),
            "path-nodes",
        )
        small = nodes.where(F.col("size_") <= SMALL)
        compared(members.join(small, "node_").withColumn("first_", F.lit(True)), "path-links")
        large = nodes.where(F.col("size_") > SMALL)
        if large.isEmpty():
            break
        heads = large.join(reps.select(F.col("id_").alias("least_"), F.col("values_").alias("head_")), "least_")
        agree = F.size(F.filter(F.zip_with("values_", "head_", lambda a, b: a == b), lambda same: same))
        faced = members.join(materialize(heads, "path-heads"), "node_").join(reps, "id_")
        faced = materialize(
            faced.select("node_", "id_", "least_", "size_", (agree < least * VALUES).alias("first_")), "path-faced"
        )
        links.append(faced.where("not first_ and id_ <> least_").select(F.col("least_").alias("u"), F.col("id_").alias("v")).distinct())
        apart = faced.groupBy("node_").agg(F.count_if("first_").alias("apart_"), F.count("*").alias("size_")).where("apart_ > 0")
        few = (F.col("size_") <= WIDE) & (F.col("size_") * F.col("apart_") <= PAIRS)
        apart = materialize(apart.select("node_", few.alias("few_")), "path-apart")
        compared(faced.join(apart.where("few_"), "node_"), "path-links")
        wide = faced.join(apart.where("not few_"), "node_").select("node_", "id_", "least_")
        if level == DEPTH:
            links.append(wide.where("id_ <> least_").select(F.col("least_").alias("u"), F.col("id_").alias("v")).distinct())
        elif wide.isEmpty():
            break
        else:
            chosen = [F.pmod(F.xxhash64("node_", F.lit(i)), F.lit(VALUES)).cast("int") for i in range(BRANCHES)]
            children = F.array(*(F.xxhash64("node_", c, F.element_at("values_", c + 1)) for c in chosen))
            members = wide.join(reps, "id_").select(F.explode(children).alias("node_"), "id_").distinct()
    out = reps.select(F.col("id_").alias("u"), F.col("id_").alias("v")).limit(0)
    for more in links:
        out = out.unionByName(more)
    return out


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_, *others) to (set_, *others)."""
    shingles = Shingles()
    for batch in batches:
        sets = pa.array([s.tobytes() for s in shingles.sets(batch.column(0))], pa.binary())
        yield pa.RecordBatch.from_arrays([sets, *batch.columns[1:]], names=["set_", *batch.schema.names[1:]])


def _links(candidates: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """True links that span the components. candidates: (u, component); texts: (id_, text_)."""
    clusters = materialize(
        candidates.unionByName(candidates.select(F.col("component").alias("u"), "component").distinct()), "clusters"
    )
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size_"))
    blocks = F.ceil(F.col("size_") / F.lit(BLOCK)).cast("int")
    block = F.pmod(F.xxhash64("u"), F.col("blocks_")).cast("int")
    placed = materialize(
        clusters.join(materialize(sizes, "cluster-sizes"), "component")
        .withColumn("blocks_", blocks)
        .withColumn("at_", block),
        "placed",
    )
    total = placed.count()
    members = texts.join(placed.withColumnRenamed("u", "id_"), "id_").select(
        "text_", "id_", "component", "blocks_", "at_"
    )
    sets = materialize(
        members.mapInArrow(_set_rows, "set_ binary, id_ long, component long, blocks_ int, at_ int"), "sets"
    )
    # Every block with the cluster's least member.
    leader = F.col("id_") == F.col("component")
    places = F.when(leader, F.sequence(F.lit(0), F.col("blocks_") - 1)).otherwise(F.array("at_"))
    inside = sets.withColumn("at_", F.explode(places)).select(
        F.xxhash64("component", "at_").alias("block_"), F.lit(False).alias("first_"), "id_", "set_"
    )
    first = materialize(_in_tasks(inside, F.col("block_"), total, _compare_sets(percent)), "links-inside")
    wide = sets.where("blocks_ > 1")
    if wide.isEmpty():
        return first
    # What is not yet joined with the bulk of its cluster meets every block.
    joined = materialize(components(first), "joined").withColumnsRenamed({"u": "of_", "component": "part_"})
    parted = wide.select("id_", "component", "blocks_", "at_").join(joined, F.col("id_") == F.col("of_"), "left")
    parted = materialize(parted.withColumn("part_", F.coalesce("part_", "id_")).drop("of_"), "parted")
    bulk = (
        parted.groupBy("component", "part_")
        .agg(F.count("*").alias("n_"))
        .groupBy("component")
        .agg(F.max(F.struct("n_", "part_"))["part_"].alias("bulk_"))
    )
    apart = materialize(
        parted.join(materialize(bulk, "bulk"), "component").where("part_ <> bulk_").drop("part_", "bulk_"), "apart"
    )
    chunks = apart.groupBy("component").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("chunks_"))
    chunks = materialize(chunks, "chunks")
    chunk = F.pmod(F.xxhash64(F.lit(5), "id_"), F.col("chunks_")).cast("int")
    asking = (
        sets.join(apart.select("id_").distinct(), "id_")
        .join(chunks, "component")
        .withColumn("chunk_", chunk)
        .withColumn("at_", F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)))
        .withColumn("first_", F.lit(True))
    )
    asked = (
        wide.join(chunks, "component")
        .withColumn("chunk_", F.explode(F.sequence(F.lit(0), F.col("chunks_") - 1)))
        .withColumn("first_", F.lit(False))
    )
    columns = [F.xxhash64(F.lit(9), "component", "at_", "chunk_").alias("block_"), "first_", "id_", "set_"]
    met = asking.select(*columns).unionByName(asked.select(*columns))
    rows = chunks.join(parted, "component").agg(F.sum("chunks_")).first()[0] or 0
    return first.unionByName(_in_tasks(met, F.col("block_"), 2 * rows, _compare_sets(percent)))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = THRESHOLD_PERCENT
) -> DataFrame:
    """A row per row of ``docs``: the id, n_shingles, component_id (the least id reachable by links), kept."""
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_column).cast("long").alias("id_"), F.col(text_column).alias("text_"))
    signed = materialize(texts.mapInArrow(_sign, SIGNED), "signed")
    key = ["set_a_", "set_b_"]
    classes = materialize(
        signed.where("n_ > 0 and id_ is not null").groupBy(*key).agg(F.min("id_").alias("rep_")), "classes"
    )
    rows = materialize(
        signed.drop("values_").join(classes, key, "left").withColumn(
            "rep_", F.when(F.col("n_") > 0, F.col("rep_"))
        ).drop(*key),
        "rows",
    )
    reps = materialize(
        signed.join(classes, key).where("id_ = rep_").select("id_", *key, "values_").dropDuplicates(["id_", *key]).drop(*key), "reps"
    )
    candidates = components(_candidate_links(reps, percent / 100 - MARGIN))
    links = _links(candidates, texts, percent)
    # An id that stands for several texts joins their classes.
    several = (
        rows.where("id_ is not null and rep_ is not null")
        .groupBy("id_")
        .agg(F.min("rep_").alias("u"), F.max("rep_").alias("v"))
        .where("u <> v")
        .select("u", "v")
    )
    closed = materialize(components(links.unionByName(several)), "components").withColumnRenamed("u", "of_")
    component = F.coalesce("component", "rep_", "id_")
    return rows.join(closed, F.col("rep_") == F.col("of_"), "left").select(
        F.col("id_").alias(id_column),
        F.col("n_").alias("n_shingles"),
        F.when(F.col("id_").isNotNull(), component).alias("component_id"),
        F.col("id_").eqNullSafe(F.when(F.col("id_").isNotNull(), component)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one document per component, with the columns of ``docs``."""
    schema = docs.schema
    report = near_duplicates(docs, id_column, text_column, **options)
    dropped = materialize(report.where("not kept").select(F.col(id_column).alias("gone_")).distinct(), "near-copies")
    rows = packed(docs).withColumn("id_", F.col(f"row_.`{id_column}`").cast("long"))
    return unpacked(rows.join(dropped, F.col("id_") == F.col("gone_"), "left_anti"), schema)
