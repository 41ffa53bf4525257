from __future__ import annotations

import re

from railweave.llm import url_filter

PAGES = "page_id long, url string, host string, rule string, url_ string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "r", "u") for i, u in enumerate(urls)], PAGES)


def reference(url, listed):
    match = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), match[1]) if match else ""
    path = match[2] if match else ""
    fits = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    rule = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    form = re.sub(r"^(www|m)\.", "", host) + re.sub(r"(\.html|/)$", "", path) if host else None
    verdict = rule[2] if rule else "block" if form in listed else "allow"
    return host, path, rule and rule[0] + rule[1], verdict, not rule and form in listed


URLS = [
    None, "", "no scheme/x", "http://", "https://WWW.Example.COM/en/1", "http://example.com/en/2?q", "http://a.example.com/en/",
    "http://com/x", "http://xcom/x", "http://shop.net/es/1", "http://shop.net/fr", "ftp://shop.net/fr/#a", "http://bad.org/p/1.html",
    "http://www.bad.org/p/1/", "http://m.bad.org/p/1?x=1#y", "http://bad.org/p/2", "http://bad.org/p/2", "http://good.org/p/1", "http://x.com?y",
]


def test_verdicts(spark):
    listed = {"bad.org/p/1", "bad.org/p/2", "shop.net/de/9"}
    table = spark.createDataFrame([(u,) for u in [*listed, "bad.org/p/2", "", None]], "url string")
    found = url_filter.judge_urls(pages(spark, URLS), table).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.listed) for r in found}
    assert len(found) == len(URLS)
    assert got == {i: reference(u, listed) for i, u in enumerate(URLS)}


def test_bloom_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(4000).selectExpr("concat('l', id) as url_")
    bloom, blocks = url_filter.bloom_filter(listed)
    asked = listed.union(spark.range(20000).selectExpr("concat('other', id)"))
    passed = [r.url_ for r in url_filter.possible_hits(asked, bloom, blocks).collect()]
    assert sum(x.startswith("l") for x in passed) == 4000
    assert len(passed) < 4000 + 0.02 * 20000


def test_empty_tables(spark):
    none = spark.createDataFrame([], "url string")
    assert url_filter.judge_urls(pages(spark, []), none).collect() == []
    found = url_filter.judge_urls(pages(spark, ["http://bad.org/p"]), none).collect()
    assert [(r.verdict, r.listed) for r in found] == [("allow", False)]
