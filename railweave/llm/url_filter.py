"""URL filter: rules first, then a list behind a blocked Bloom filter.

A rule is a host and a path; it fits its host and all subdomains if the url's path starts with the
rule's, and the longest fitting rule decides. Urls without a rule are blocked if their canonical form is
listed. The canonical form has no scheme, ``www.`` or ``m.`` label, query, fragment, ``.html`` or final slash.

The blocked Bloom filter has one row per block: a url hashes to one block of 512 bits and to
``PROBES`` bits in it, so that a probe touches one row. The number of blocks follows the number of
listed urls; the filter is a table that Spark broadcasts only below its own size bound and
otherwise shuffles. Distinct canonical urls are probed, never their repeats. Possible hits go to an exact
join with the list, which removes the filter's false positives.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is
allowed; null and empty entries of the list are ignored, repeats count once. Repeated rows get one
verdict each. Empty tables give empty results, an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.llm.text import host_of, path_of
from railweave.session import materialize

#: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
WORDS, PROBES, URLS_PER_BLOCK = 8, 6, 40


def canonical(host: Column, path: Column) -> Column:
    """The form in which urls are listed; null without a host."""
    bare = F.regexp_replace(host, r"^(?:www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"(?:\.html|/)$", "")))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))

    def first(value) -> Column:
        fits = [
            F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)), value(h, p, v))
            for h, p, v in ordered
        ]
        return F.coalesce(*fits, F.lit(None).cast("string"))

    return first(lambda h, p, v: F.lit(h + p)), first(lambda h, p, v: F.lit(v))


def _block_and_bits(url: Column, blocks: int) -> tuple[Column, Column]:
    """The url's block, and per word of the block the bits it sets."""
    block = F.pmod(F.xxhash64(url), F.lit(blocks))
    places = F.transform(F.sequence(F.lit(1), F.lit(PROBES)), lambda i: F.pmod(F.xxhash64(i, url), F.lit(64 * WORDS)).cast("int"))
    one = F.lit(1).cast("long")
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(WORDS - 1)),
        lambda word: F.aggregate(
            places,
            F.lit(0).cast("long"),
            lambda bits, p: bits.bitwiseOR(
                F.when(F.floor(p / 64) == word, F.call_function("shiftleft", one, p % 64)).otherwise(F.lit(0).cast("long"))
            ),
        ),
    )
    return block, bits


def bloom_filter(listed: DataFrame) -> tuple[DataFrame, int]:
    """Rows (block_, words_) over the distinct urls in ``listed.url_``, and the number of blocks."""
    blocks = max(1, -(-listed.count() // URLS_PER_BLOCK))
    block, bits = _block_and_bits(F.col("url_"), blocks)
    marked = listed.select(block.alias("block_"), bits.alias("bits_"))
    words = (F.bit_or(F.col("bits_")[i]) for i in range(WORDS))
    return marked.groupBy("block_").agg(F.array(*words).alias("words_")), blocks


def possible_hits(urls: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``urls`` (column url_) that the filter lets pass."""
    block, bits = _block_and_bits(F.col("url_"), blocks)
    probes = urls.select("url_", block.alias("block_"), bits.alias("bits_"))
    inside = F.forall(F.zip_with("words_", "bits_", lambda w, b: w.bitwiseAND(b) == b), lambda held: held)
    return probes.join(bloom, "block_").where(inside).select("url_")


def judge_urls(
    pages: DataFrame, listed: DataFrame, id_column: str = "page_id", url_column: str = "url", rules=RULES
) -> DataFrame:
    """A row per row of ``pages``: id, host, path, rule, verdict, listed. ``listed`` has canonical urls in ``url``."""
    listed = materialize(
        listed.select(F.col("url").alias("url_")).where(F.col("url_") != "").distinct(), "listed-urls"
    )
    host, path = F.col("host"), F.col("path")
    rule, verdict = rule_of(host, path, rules)
    judged = (
        pages.select(F.col(id_column).alias("id_"), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))
        .select("id_", "host", "path", rule.alias("rule"), verdict.alias("by_rule_"), canonical(host, path).alias("url_"))
    )
    bloom, blocks = bloom_filter(listed)
    asked = judged.where(F.col("by_rule_").isNull() & F.col("url_").isNotNull()).select("url_").distinct()
    hits = possible_hits(asked, materialize(bloom, "listed-bloom"), blocks)
    found = materialize(
        hits.join(listed, "url_").select(F.col("url_").alias("hit_")), "listed-hits"
    )
    return judged.join(found, F.col("url_") == F.col("hit_"), "left").select(
        F.col("id_").alias(id_column), "host", "path", "rule",
        F.coalesce("by_rule_", F.when(F.col("hit_").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.col("hit_").isNotNull().alias("listed"),
    )
