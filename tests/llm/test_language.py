from __future__ import annotations

import os

import pytest
from helpers import awkward, empty
from pyspark.sql import functions as F

from railweave.llm import language

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="bundled data not present")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    # Every second document hides its label: neither the fit nor the fusion sees it.
    hidden = docs.withColumn("truth", F.col("lang")).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    judged = language.identify(language.document_evidence(hidden)).withColumnRenamed("id_", "doc_id")
    rows = judged.join(hidden, "doc_id").where("doc_id % 2 = 1 and n_chars > 40").collect()
    assert sum(r.language_ == r.truth for r in rows) >= 0.97 * len(rows) and all(r.kept_ for r in rows)


def evidence(spark, rows):
    return spark.createDataFrame(rows, "id_ long, text_ string, declared_ string, suffix_ string, host_ string")


def test_other_evidence_decides_where_the_text_does_not(spark):
    texts = {"de": "der hund und die katze sind hier", "fr": "le chien et la chatte sont ici"}
    rows = [
        (i * 2 + k, texts[x], x, x, f"{x}{i % 3}.example.{x}")
        for k, x in enumerate(("de", "fr"))
        for i in range(60)
    ]
    rows += [(900, "", "de", None, None), (901, None, None, "fr", None), (902, "123", None, None, "www.de1.example.de"), (903, "123", None, None, "fr1.example.fr")]
    found = {r.id_: r for r in language.identify(evidence(spark, rows), languages=("de", "fr")).collect()}
    assert all(found[r[0]].language_ == r[2] and found[r[0]].kept_ for r in rows[:120])
    assert [found[i].language_ for i in (900, 901, 902, 903)] == ["de", "fr", "de", "fr"]
    assert not any(found[i].kept_ for i in (900, 901, 902, 903))


def test_page_evidence(spark):
    html = "<html  lang='de-AT'><head><script>the and of</script></head><body>Hallo &amp; Welt</body>"
    pages = spark.createDataFrame([(1, "http://A.b.Example.at:80/x", html), (2, None, None)], "page_id long, url string, html string")
    first, second = sorted(language.page_evidence(pages).collect(), key=lambda r: r.id_)
    assert (first.declared_, first.suffix_, first.host_) == ("de", "at", "a.b.example.at:80") and "the" not in first.text_
    assert (second.declared_, second.suffix_, second.host_, second.text_) == (None, None, None, None)


def test_awkward_and_empty_tables(spark):
    judged = language.identify(language.document_evidence(awkward(spark))).collect()
    assert len(judged) == awkward(spark).count()
    # No letters, no language.
    rejected = {r.id_ for r in judged if not r.kept_}
    assert rejected >= {4, 5, 6} and not rejected & {1, 2, 3, 9, 10, 12}
    stays = {r.id_ for r in judged if r.kept_}
    kept = language.keep_identified(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.id_ or 0 for r in judged if r.id_ in stays)
    assert language.identify(language.document_evidence(empty(spark))).collect() == []
    assert language.keep_identified(empty(spark)).collect() == []
