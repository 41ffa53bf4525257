"""Best-fit packing into fixed windows under conflicts.

A document longer than a window fills whole windows of its own; its remainder is packed like any
short document. Pieces are packed in shards: a piece's shard follows from a hash of its document, and
the number of shards from the total words, so that a shard holds about ``shard_words`` words whatever
the input's size or skew. Rows that repeat id and text would have one hash; their place in the input
is hashed with them, so a document repeated in a third of the rows spreads over all shards. Within a shard pieces go in falling size. The open bins are kept ordered by
residual space; the search starts at the successor of the piece's size and goes on to the next larger
residual until a bin is compatible, which is the tightest compatible bin. If there is none, a bin is opened.

Each bin carries bitmaps: the duplicate clusters it holds, the sources it holds, and the sources that
have reached ``per_source`` pieces. A bin takes no second piece of a cluster and no more of a full
source. Clusters come from a column, or else from the text (A-Z lower-cased, white space collapsed).

Defined results: null and empty texts have no words and are not packed; null sources and null
clusters count as a value of their own, a null cluster conflicting with nothing; documents that
repeat never share a bin; ties go to the smaller id, then piece, then the older bin. An empty table
gives no bins.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.llm.text import WORD, ascii_lower, bound_batches, plain_text, word_count
from railweave.session import materialize

#: Words per window, words per shard, and pieces of one source per window.
WINDOW, SHARD_WORDS, PER_SOURCE = 2048, 1_000_000, 2
PIECE = "id_ long, source_ string, cluster_ long, copy_ long, piece_ int, start_ long, size_ long, place_ long, text_ string"
COLUMNS = [field.split()[0] for field in PIECE.split(", ")]
BIN = (
    "bin_id long, n_words long, doc_ids array<long>, pieces array<int>, starts array<long>, sizes array<long>, text string"
)


def best_fit(sizes: list[int], sources: list, clusters: list, window: int, per_source: int) -> list[int]:
    """The bin number of each piece; pieces come in the order in which they are packed.

    Bins of one residual that have the same full sources and hold the same repeated clusters are
    alike to every piece, so they lie in one heap and the search tests each such kind once. Clusters
    of a single piece conflict with nothing, and bins that are full for all sources leave the index.
    """
    source_bit = {source: 1 << place for place, source in enumerate(dict.fromkeys(sources))}
    every_source = (1 << len(source_bit)) - 1
    often = (cluster for cluster, n in Counter(clusters).items() if n > 1 and cluster is not None)
    cluster_bit = {cluster: 1 << place for place, cluster in enumerate(often)}
    counts: list[dict] = []  # pieces of each source, by bin
    # residual -> (full sources, repeated clusters) -> numbers of the bins of that kind, oldest first.
    index: dict[int, dict[tuple[int, int], list[int]]] = {}
    residuals: list[int] = []  # the residuals of the index, in order
    chosen = []
    for size, source, cluster in zip(sizes, sources, clusters):
        one, mark = source_bit[source], cluster_bit.get(cluster, 0)
        space, kind, number = window, (0, 0), len(counts)
        for place in range(bisect_left(residuals, size), len(residuals)):
            kinds = index[residuals[place]]
            fitting = [(heap[0], k) for k, heap in kinds.items() if not k[0] & one and not k[1] & mark]
            if fitting:
                space, (number, kind) = residuals[place], min(fitting)
                heappop(kinds[kind])
                if not kinds[kind]:
                    del kinds[kind]
                if not kinds:
                    del index[space]
                    residuals.pop(place)
                break
        else:
            counts.append({})
        held = counts[number]
        held[source] = held.get(source, 0) + 1
        full = kind[0] | one if held[source] >= per_source else kind[0]
        if space > size and full != every_source:
            if space - size not in index:
                insort(residuals, space - size)
            kinds = index.setdefault(space - size, {})
            heappush(kinds.setdefault((full, kind[1] | mark), []), number)
        chosen.append(number)
    return chosen


def _pieces(window: int):
    """Cuts texts into pieces of at most ``window`` words, each with its place in the document."""
    word = re.compile(WORD)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            short = frame[frame.words_ <= window]
            yield short.assign(piece_=0, start_=0, size_=short.words_)[COLUMNS]
            parts = []
            for row in frame[frame.words_ > window].itertuples(index=False):
                starts = [m.start() for i, m in enumerate(word.finditer(row.text_)) if i % window == 0]
                for i, (begin, end) in enumerate(zip(starts, [*starts[1:], len(row.text_)])):
                    size = min(window, row.words_ - i * window)
                    parts.append((row.id_, row.source_, row.cluster_, row.copy_, i, i * window, size, row.place_, row.text_[begin:end]))
                    if len(parts) == 256:
                        yield pd.DataFrame(parts, columns=COLUMNS)
                        parts = []
            yield pd.DataFrame(parts, columns=COLUMNS)

    return cut


def _pack_shard(window: int, per_source: int, separator: str):
    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["size_", "id_", "copy_", "piece_", "text_"], ascending=[False, True, True, True, True], na_position="first"
        )
        columns = {c: [None if pd.isna(v) else v for v in frame[c]] for c in frame.columns}
        numbers = best_fit(columns["size_"], columns["source_"], columns["cluster_"], window, per_source)
        members: dict[int, list[int]] = {}
        for place, number in enumerate(numbers):
            members.setdefault(number, []).append(place)

        def of(name: str, kind: type = int) -> list[list]:
            value = columns[name]
            return [[None if value[p] is None else kind(value[p]) for p in places] for places in members.values()]

        sizes, texts = of("size_"), of("text_", str)
        return pd.DataFrame(
            {
                "bin_id": [int(key[0]) * (1 << 32) + number for number in members],
                "n_words": [sum(x) for x in sizes],
                "doc_ids": of("id_"),
                "pieces": of("piece_"),
                "starts": of("start_"),
                "sizes": sizes,
                "text": [separator.join(x) for x in texts],
            }
        )

    return pack


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    cluster_column: str | None = None,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    per_source: int = PER_SOURCE,
    separator: str = "\n\n",
) -> DataFrame:
    """A row per bin: bin_id, n_words, and of its pieces in order doc_ids, pieces, starts and sizes (in
    words), with the joined text."""
    bound_batches(docs.sparkSession)
    text = plain_text(F.col(text_column))
    words = word_count(F.col(text_column))
    total = docs.select(words.alias("words_")).agg(F.sum("words_")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    if cluster_column is None:
        cluster = F.xxhash64(F.trim(F.regexp_replace(ascii_lower(text), r"[\x20\x09-\x0D]+", " ")))
    else:
        cluster = F.xxhash64(F.col(cluster_column).cast("string"))
        cluster = F.when(F.col(cluster_column).isNotNull(), cluster)
    rows = docs.select(
        F.col(id_column).cast("long").alias("id_"),
        F.col(source_column).cast("string").alias("source_"),
        cluster.alias("cluster_"),
        F.xxhash64(text).alias("copy_"),
        words.alias("words_"),
        text.alias("text_"),
    ).where("words_ > 0")
    # Counted over narrow rows and within each task first. In a table of distinct documents there are none.
    repeated = rows.groupBy("id_", "copy_").agg(F.count("*").alias("rows_")).where("rows_ > 1").drop("rows_")
    repeated = materialize(repeated.withColumnsRenamed({"id_": "of_id_", "copy_": "of_copy_"}), "packing-repeated")
    rows = rows.withColumn("place_", F.lit(0).cast("long"))
    if not repeated.isEmpty():
        same = F.col("id_").eqNullSafe(F.col("of_id_")) & (F.col("copy_") == F.col("of_copy_"))
        rows = (
            rows.withColumn("row_", F.monotonically_increasing_id())
            .join(repeated, same, "left")
            .withColumn("place_", F.when(F.col("of_copy_").isNotNull(), F.col("row_")).otherwise(F.col("place_")))
            .drop("row_", "of_id_", "of_copy_")
        )
    shard = F.pmod(F.xxhash64("id_", "copy_", "piece_", "place_"), F.lit(shards)).alias("shard_")
    pieces = rows.mapInPandas(_pieces(window), PIECE)
    return pieces.groupBy(shard).applyInPandas(_pack_shard(window, per_source, separator), BIN)
