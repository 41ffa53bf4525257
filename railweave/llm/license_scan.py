"""License scan: MinHash bands over overlapping windows find templates, containment confirms them.

Texts become words (A-Z lower-cased; a word is a run of letters and digits) and shingles of five words.
A template of ``m`` words is looked for in windows of ``2 m`` words that start every ``m`` words,
so that any passage of its length lies whole in one window; the last window ends with the text. Each window gets ``bands`` MinHash values,
one row to a band, and a template is a candidate for a window that agrees with it in at least one band. If
a window contains the share ``c`` of a template's ``k`` shingles, their Jaccard similarity is at
least ``c k / (windows's shingles + (1 - c) k)``; the number of bands is chosen per template length so that such a
window collides with a probability of at least ``1 - miss``. A candidate counts if the window really
contains the share ``c`` of the template's distinct shingles.

Windows that share no shingle with any template cannot collide in a band; texts without any such
shingle are set aside before windows are made, which loses nothing.

Defined results: null and empty texts match nothing, as do texts of fewer than five words. Long texts are
scanned whole. Rows that repeat an id are scanned on their own and reported once per id and license, with
the best containment and the most windows of any of them. Templates of fewer than five words are refused.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railweave.llm.text import ascii_lower, plain_text
from railweave.session import materialize

SHINGLE, CONTAINMENT, MISS = 5, 0.75, 1e-6

#: License lines and the public notices of common licenses.
TEMPLATES = {
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software."
    ),
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version."
    ),
}


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def bands_for(length: int, containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """Bands of one row after which a window that contains a template of ``length`` words is missed
    with a probability of at most ``miss``."""
    shingles, window = length - SHINGLE + 1, 2 * length - SHINGLE + 1
    shared = math.ceil(containment * shingles - 1e-9)
    similarity = shared / (window + shingles - shared)
    return max(1, math.ceil(math.log(miss) / math.log(1 - similarity)))


def _band_values(hashes: Column, bands: int) -> Column:
    """The least value of the hashes under each of ``bands`` functions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band))),
    )


def _once(column: Column) -> Column:
    """The column as a generated one: filters on what is made of it are not moved below it, so it is made once per row."""
    return F.explode(F.array(column))


def with_shingles(docs: DataFrame, text_column: str) -> DataFrame:
    """Adds ``sequence_``, the hashes of all five-word shingles in order."""
    words = F.filter(F.split(ascii_lower(plain_text(F.col(text_column))), "[^a-z0-9]+"), lambda w: w != "")
    several = F.transform(
        F.sequence(F.lit(0), F.size("words_") - SHINGLE),
        lambda i: F.xxhash64(*(F.get(F.col("words_"), i + k) for k in range(SHINGLE))),
    )
    sequence = F.when(F.size("words_") >= SHINGLE, several).otherwise(F.array().cast("array<bigint>"))
    hashed = docs.withColumn("words_", _once(F.transform(words, lambda w: F.xxhash64(w))))
    return hashed.withColumn("sequence_", _once(sequence)).drop("words_")


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
    miss: float = MISS,
) -> DataFrame:
    """A row per document and license found: id, license, containment, windows."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    lengths = {name: len(template_words(text)) for name, text in templates.items()}
    if min(lengths.values()) < SHINGLE:
        raise ValueError("A template needs at least five words")
    rows = [F.struct(F.lit(n).alias("license"), F.lit(lengths[n]).alias("length"), F.lit(t).alias("text")) for n, t in templates.items()]
    known = with_shingles(spark.range(1).select(F.inline(F.array(*rows))), "text").select(
        "license", "length", F.array_distinct("sequence_").alias("template_")
    )
    universe = known.agg(F.array_distinct(F.flatten(F.collect_list("template_")))).first()[0]
    near = materialize(
        with_shingles(docs.select(F.col(id_column).alias("id_"), F.col(text_column).alias("text_")), "text_")
        .drop("text_")
        .where(F.arrays_overlap("sequence_", F.lit(universe))),
        "license-texts",
    )
    found = []
    for length in sorted(set(lengths.values())):
        bands, wide = bands_for(length, containment, miss), 2 * length - SHINGLE + 1
        starts = F.sequence(F.lit(0), F.greatest(F.size("sequence_") - 1, F.lit(0)), F.lit(length))
        windows = near.select("id_", "sequence_", F.explode(starts).alias("start_")).select(
            "id_", "start_", F.array_distinct(F.slice("sequence_", F.col("start_") + 1, F.lit(wide))).alias("window_")
        )
        sought = known.where(F.col("length") == length)
        template_bands = sought.select("license", F.posexplode(_band_values(F.col("template_"), bands)).alias("band_", "least_"))
        hits = (
            windows.select("id_", "start_", "window_", F.posexplode(_band_values(F.col("window_"), bands)).alias("at_", "low_"))
            # At most one row per template and band.
            .join(F.broadcast(template_bands), (F.col("at_") == F.col("band_")) & (F.col("low_") == F.col("least_")))
            .join(F.broadcast(sought.select(F.col("license").alias("of_"), "template_")), F.col("license") == F.col("of_"))
        )
        share = F.size(F.array_intersect("window_", "template_")) / F.size("template_")
        found.append(
            hits.select("id_", "license", "start_", share.alias("containment"), "band_").where(F.col("containment") >= containment)
        )
    hits = reduce(DataFrame.unionByName, found)
    return (
        hits.groupBy("id_", "license")
        .agg(F.max("containment").alias("containment"), F.countDistinct("start_").alias("windows"))
        .withColumnRenamed("id_", id_column)
    )
