"""Language identification by Bayesian fusion of evidence.

Evidence on a row's language: its text, the language that its markup or metadata declares, the suffix of its
address, and what else its host publishes.

* Text: log-likelihoods of hashed letter trigrams per language, fitted on about ``SAMPLE`` labelled rows per
  language (chosen by a hash of the id) and tempered: as neighbouring trigrams depend on each other, a text
  counts as at most ``STRENGTH`` independent ones.
* Declared language and suffix: how often each value goes with each language, from expected counts over all
  rows, smoothed towards the value's share overall.
* Host: expected counts over all other rows of the host, smoothed towards its domain, which is smoothed towards the
  whole corpus.

All counts are grouped sums over all rows; tables of values meet the rows again in plain joins.

A row is rejected if it has no letter or if no language reaches ``LEAST`` of the fused posterior.

Defined results: null and empty texts are rejected, with the language of the other evidence. Null or blank
declarations, addresses and hosts give no evidence. Long texts are read whole. Rows that repeat an id are judged one
by one. An empty table, or one without labels, gives uniform likelihoods. Ties go to the first language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.llm.mixing import uniform
from railweave.llm.text import ascii_lower, bound_batches, host_of, packed, unpacked
from railweave.session import materialize

LANGUAGES = ("de", "en", "es", "fr")
#: Labelled rows per language that the text model is fitted on, expected.
SAMPLE = 500
STRENGTH, LEAST = 40.0, 0.5
#: Rows that a smoothing level counts as.
PRIOR_ROWS = 5.0
BUCKETS, CHUNK = 1 << 16, 1 << 18


class Trigrams:
    """Codes of the trigrams around each letter. Anything but letters and bytes above 127 counts as blank."""

    def __init__(self) -> None:
        self.fold = np.full(256, 32, dtype=np.uint32)
        self.fold[97:123] = np.arange(97, 123)
        self.fold[65:91] = np.arange(97, 123)
        self.fold[128:] = np.arange(128, 256)

    def codes(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
        """Chunks of texts: the codes, the text each belongs to, and the chunk's first and last text."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
            low, high = int(offsets[at]), int(offsets[to])
            folded = self.fold[data[low:high]]
            owner = np.repeat(np.arange(to - at), np.diff(offsets[at : to + 1]))
            # Beyond a text's ends stand blanks. Only trigrams around a letter count.
            joined = np.zeros(len(folded) + 1, dtype=bool)
            joined[1:-1] = owner[1:] == owner[:-1]
            before = np.where(joined[:-1], np.concatenate([[32], folded[:-1]]), 32).astype(np.uint32)
            after = np.where(joined[1:], np.concatenate([folded[1:], [32]]), 32).astype(np.uint32)
            whole = folded != 32
            triple = (before << 16) | (folded << 8) | after
            yield (triple[whole] * np.uint32(0x9E3779B1)) >> 16, owner[whole], at, to
            at = to


def _count(languages: tuple[str, ...]):
    """(label_, text_) to (label_, bucket_, n_)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams = Trigrams()
        for batch in batches:
            labels = np.array([languages.index(x) for x in batch.column(0).to_pylist()], dtype=np.int64)
            counts = np.zeros(len(languages) * BUCKETS, dtype=np.int64)
            for codes, owner, low, high in trigrams.codes(batch.column(1)):
                counts += np.bincount(labels[low:high][owner] * BUCKETS + codes, minlength=len(counts))
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen // BUCKETS, pa.int32()), pa.array(seen % BUCKETS, pa.int32()), pa.array(counts[seen], pa.int64())],
                names=["label_", "bucket_", "n_"],
            )

    return count


def fit_text_model(rows: DataFrame, languages: tuple[str, ...], sample: int) -> np.ndarray:
    """Log-likelihoods [language, bucket] from (id_, label_, text_); its size does not depend on the rows."""
    labelled = rows.where(F.col("label_").isin(*languages))
    sizes = {r.label_: r.n_ for r in labelled.groupBy("label_").agg(F.count("*").alias("n_")).collect()}
    shares = [F.when(F.col("label_") == x, F.lit(min(1.0, sample / n))) for x, n in sizes.items()]
    counts = np.zeros((len(languages), BUCKETS))
    if shares:
        chosen = labelled.where(uniform(F.col("id_")) < F.coalesce(*shares)).select("label_", "text_")
        table = (
            chosen.mapInArrow(_count(languages), "label_ int, bucket_ int, n_ long")
            .groupBy("label_", "bucket_")
            .agg(F.sum("n_").alias("n_"))
            .toArrow()
        )
        label, bucket, n = (table.column(name).to_numpy() for name in ("label_", "bucket_", "n_"))
        counts[label, bucket] = n
    smooth = counts + 0.5
    return np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)


def _likelihoods(model: np.ndarray, strength: float):
    """(text_, *others) to (likelihoods_, trigrams_, *others)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, table = Trigrams(), np.ascontiguousarray(model.T)
        for batch in batches:
            sums = np.zeros((batch.num_rows, table.shape[1]))
            seen = np.zeros(batch.num_rows, dtype=np.int64)
            for codes, owner, low, high in trigrams.codes(batch.column(0)):
                n = np.bincount(owner, minlength=high - low)
                seen[low:high] = n
                for language in range(table.shape[1]):
                    sums[low:high, language] = np.bincount(owner, weights=model[language][codes], minlength=high - low)
            sums *= np.minimum(1.0, strength / np.maximum(seen, 1))[:, None]
            offsets = pa.array(np.arange(0, sums.size + 1, table.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, pa.array(sums.ravel())), pa.array(seen), *batch.columns[1:]],
                names=["likelihoods_", "trigrams_", *batch.schema.names[1:]],
            )

    return score


def _posterior(logs: Column) -> Column:
    """Normalised probabilities of an array of logarithms."""
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, y: a + y))


def declared_language(value: Column) -> Column:
    """The primary subtag of a language tag, null if blank."""
    tag = F.regexp_extract(ascii_lower(F.trim(value)), "^([a-z0-9]+)", 1)
    return F.when(tag != "", tag)


def markup_language(html: Column) -> Column:
    """What the ``lang`` attribute of a page's html element declares."""
    return declared_language(F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([a-z0-9-]+)", 1))


def address_suffix(url: Column) -> Column:
    """The last label of the host."""
    suffix = F.regexp_extract(host_of(url), r"\.([a-z0-9-]+)(?::\d+)?$", 1)
    return F.when(suffix != "", suffix)


def domain_of(host: Column) -> Column:
    """The last two labels of a host name; a name without dots is its own domain."""
    return F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1)


def identify(
    rows: DataFrame,
    languages: tuple[str, ...] = LANGUAGES,
    sample: int = SAMPLE,
    strength: float = STRENGTH,
    least: float = LEAST,
) -> DataFrame:
    """(id_, text_, declared_, suffix_, host_) to id_, language_, confidence_, text_language_, kept_."""
    bound_batches(rows.sparkSession)
    number = len(languages)
    labelled = rows.select("id_", F.col("declared_").alias("label_"), "text_")
    model = fit_text_model(labelled, languages, sample)
    keep = ["id_", "declared_", "suffix_", "host_"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    scored = rows.select("text_", *keep).mapInArrow(
        _likelihoods(model, strength), f"likelihoods_ array<double>, trigrams_ long, {', '.join(f'{c} {kinds[c]}' for c in keep)}"
    )
    scored = scored.withColumn("expected_", F.when(F.col("trigrams_") > 0, _posterior(F.col("likelihoods_"))))
    scored = materialize(scored.withColumn("domain_", domain_of(F.col("host_"))), "language-text")

    def expected(by: str | None, name: str) -> DataFrame:
        sums = [F.sum(F.coalesce(F.col("expected_")[i], F.lit(0.0))) for i in range(number)]
        if by is None:
            return scored.agg(F.array(*sums).alias(name))
        grouped = scored.where(F.col(by).isNotNull()).groupBy(F.col(by).alias(f"{name}key_"))
        return materialize(grouped.agg(F.array(*sums).alias(name)), "language-counts")

    overall = [x or 0.0 for x in expected(None, "all_").first()[0]]
    rows_seen = sum(overall)
    share = F.array(*(F.lit((x + 1) / (rows_seen + number)) for x in overall))
    total = F.array(*(F.lit(x) for x in overall))
    known = scored
    for by, name in (("declared_", "dc_"), ("suffix_", "sc_"), ("host_", "hc_"), ("domain_", "mc_")):
        known = known.join(expected(by, name), F.col(by) == F.col(f"{name}key_"), "left").drop(f"{name}key_")
    zeros = F.array(*(F.lit(0.0) for _ in languages))
    own = F.coalesce("expected_", zeros)

    def others(counts: str) -> Column:
        """Without the row itself."""
        return F.zip_with(F.coalesce(counts, own), own, lambda c, o: F.greatest(c - o, F.lit(0.0)))

    def added(column: Column) -> Column:
        return F.aggregate(column, F.lit(0.0), lambda a, x: a + x)

    def smoothed(counts: Column, towards: Column) -> Column:
        return F.zip_with(counts, towards, lambda n, p: (n + p * PRIOR_ROWS) / (added(counts) + PRIOR_ROWS))

    def value_logs(counts: Column) -> Column:
        """log P(value | language) up to a constant per row."""
        overall_share = added(counts) / F.lit(rows_seen + 1.0)
        return F.zip_with(
            counts, total, lambda n, m: F.log((n + overall_share * PRIOR_ROWS + 1e-6) / (m + PRIOR_ROWS))
        )

    def sum_logs(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: x + y)

    known = (
        known.withColumn("dc_", others("dc_"))
        .withColumn("sc_", others("sc_"))
        .withColumn("mc_", smoothed(others("mc_"), share))
        .withColumn("hc_", smoothed(others("hc_"), F.col("mc_")))
    )
    prior = F.transform("hc_", lambda p: F.log(p))
    declared = F.when(F.col("declared_").isNotNull(), value_logs(F.col("dc_"))).otherwise(zeros)
    suffix = F.when(F.col("suffix_").isNotNull(), value_logs(F.col("sc_"))).otherwise(zeros)
    text = F.when(F.col("trigrams_") > 0, F.col("likelihoods_")).otherwise(zeros)
    fused = _posterior(F.col("logs_"))
    names = F.array(*(F.lit(x) for x in languages))

    def top(probabilities: Column) -> Column:
        return F.element_at(names, F.array_position(probabilities, F.array_max(probabilities)).cast("int"))

    return (
        known.withColumn("logs_", sum_logs(sum_logs(text, prior), sum_logs(declared, suffix)))
        .withColumn("fused_", fused)
        .select(
            "id_",
            top(F.col("fused_")).alias("language_"),
            F.array_max("fused_").alias("confidence_"),
            top(F.col("expected_")).alias("text_language_"),
            ((F.col("trigrams_") > 0) & (F.array_max("fused_") >= least)).alias("kept_"),
        )
    )


def document_evidence(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", declared_column: str = "lang", host_column: str = "source"
) -> DataFrame:
    """Documents name their language and source; they have no address."""
    host = F.col(host_column).cast("string")
    return docs.select(
        F.col(id_column).alias("id_"),
        F.col(text_column).alias("text_"),
        declared_language(F.col(declared_column)).alias("declared_"),
        F.lit(None).cast("string").alias("suffix_"),
        F.when(F.trim(host) != "", host).alias("host_"),
    )


def page_evidence(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Pages declare a language in their markup; their text is what stands between the tags."""
    markup = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"
    host = host_of(F.col(url_column))
    return pages.select(
        F.col(id_column).alias("id_"),
        F.regexp_replace(html_column, markup, " ").alias("text_"),
        markup_language(F.col(html_column)).alias("declared_"),
        address_suffix(F.col(url_column)).alias("suffix_"),
        F.when(host != "", host).alias("host_"),
    )


def keep_identified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose language is known, with the columns of ``docs``. Rows that repeat an id stay if any of them does."""
    schema = docs.schema
    judged = identify(document_evidence(docs, id_column, text_column), **options)
    verdicts = judged.groupBy("id_").agg(F.max("kept_").alias("kept_"))
    gone = materialize(verdicts.where("not kept_").select(F.col("id_").alias("gone_")), "language-rejected")
    rows = packed(docs).withColumn("id_", F.col(f"row_.`{id_column}`"))
    return unpacked(rows.join(gone, F.col("id_").eqNullSafe(F.col("gone_")), "left_anti"), schema)
