from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from railweave.llm import html_diff
from railweave.llm.html_diff import ARTICLE, OPEN, SITE, lines_of, shared_lines
from railweave.llm.queries import op1_html_diff

PAGES = "page_id long, url string, html string, key_ string, html_ string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "h") for r in rows], PAGES)


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    found = shared_lines(a, b)
    rest = iter(b)
    assert found == sorted(set(found)) and all(a[i] in rest for i in found)
    assert len(found) == longest(a, b)


def test_lines_and_labels():
    html = (
        "<html><head><title>T</title></head><body><nav><a>menu</a></nav><div class='ad-slot'>buy</div>"
        "<p>a <b>b</b>c &amp; d<br>e&nbsp;\n f<script>var t='</p>';</script></p><!-- <p>no</p> -->"
        "<p style='display:none'>hidden</p></body></html>"
    )
    assert lines_of(html) == [("menu", SITE), ("buy", SITE), ("a bc & d", OPEN), ("e f", OPEN)]
    marked = "<p>before</p><article><h1>T</h1><p>x<aside>y</aside><section id='comments'>z</section></article>after"
    assert lines_of(marked) == [("before", SITE), ("T", ARTICLE), ("x", ARTICLE), ("y", SITE), ("z", SITE), ("after", SITE)]
    assert lines_of("<div class='ad'>never closed<article><p>x</p></article>")[-1] == ("x", ARTICLE)
    assert lines_of(None) == lines_of("") == []


def test_boilerplate_without_end_tags_ends():
    def labels(html):
        return {text: label for text, label in lines_of(html)}

    assert labels("<article><p>a</p><p class=ad>buy<p>b</p><p>c</p></article>") == {"a": ARTICLE, "buy": SITE, "b": ARTICLE, "c": ARTICLE}
    for before, after in (
        ("<ul><li class=ad>buy", "<li>b</ul>"),
        ("<ul><li class=ad><div>buy", "<li>b</ul>"),
        ("<dl><dt class=ad>buy", "<dd>b</dl>"),
        ("<table><tr><td class=ad>buy", "<td>b</table>"),
        ("<table><tr class=ad><td>buy", "<tr><td>b</table>"),
        ("<div><div class=ad>buy", "</div></div>b"),
        ("<section><div class=ad>buy", "</section>b"),
        ("<section class=ad><p>buy<section>buy</section>", "</section>b"),
        ("<p>a <span class=ad>buy<span>buy</span>", "</span>b"),
        ("<p style='display:none'>x", "<p>b"),
    ):
        found = labels(f"<article>{before}{after}<p>c</p></article><p>end</p>")
        assert (found["b"], found["c"], found["end"]) == (ARTICLE, ARTICLE, SITE) and found.get("buy", SITE) == SITE, before
    # An element of the article that was never closed ends with the article.
    assert labels("<body><article>a<div class=ad>buy</article><main>b</main></body>") == {"a": ARTICLE, "buy": SITE, "b": ARTICLE}
    assert labels("<div><nav>menu</div>b") == {"menu": SITE, "b": OPEN}
    # Boilerplate inside of boilerplate does not end it, and a stray end tag does not end the article.
    assert labels("<ul class=menu><li>x<li>y</ul>b") == {"x": SITE, "y": SITE, "b": OPEN}
    assert labels("<div><article><div>a</div></div>b</article></div>") == {"a": ARTICLE, "b": ARTICLE}


def test_shared_lines_go_between_nearest_pages_of_a_host(spark):
    def page(own):
        return f"<body><p>Welcome to the site</p><p>{own}</p><p>Write to us</p></body>"

    rows = [
        (1, "http://a.org/x/1", page("first text")),
        (2, "http://a.org/x/2", page("second text")),
        (3, "http://b.org/x/3", page("alone")),
        (4, None, page("no address")),
        (5, "http://a.org/y", None),
        (6, "http://a.org/x/2", page("second text")),
        (1, "http://a.org/x/1", page("first text")),
    ]
    found = sorted((r.page_id, r.text, r.n_chars, r.n_deleted) for r in html_diff.main_texts(pages(spark, rows)).collect())
    alone, nowhere = "Welcome to the site alone Write to us", "Welcome to the site no address Write to us"
    assert found == [
        (1, "first text", 10, 2),
        (1, "first text", 10, 2),
        # Two pages with one address are each other's nearest, and share everything.
        (2, "", 0, 3),
        (3, alone, len(alone), 0),
        (4, nowhere, len(nowhere), 0),
        (5, "", 0, 0),
        (6, "", 0, 3),
    ]


def test_copies_are_not_compared_with_each_other(spark, tmp_path):
    def page(own, extra=""):
        return f"<body><p>Welcome to the site</p>{own}<p>Write to us</p><nav>{extra}</nav></body>"

    def paragraphs(name, changed=()):
        return "".join(f"<p>{name} {i}{' anew' if i in changed else ''}</p>" for i in range(30))

    rows = [(i, f"http://a.org/x/{i % 7}?session={i}", page("<p>the article</p>", f"menu {i}")) for i in range(300)]
    rows += [
        (1000, "http://a.org/x/3", page("<p>another article</p>")),
        # Alone on its host, but for its copies.
        (1001, "http://b.org/1", page("<p>mirrored</p>")),
        (1002, "http://b.org/1?print", page("<p>mirrored</p>")),
        # Nearly copies, and a page beyond them.
        (1003, "http://c.org/p/1", page(paragraphs("line"))),
        (1004, "http://c.org/p/2", page(paragraphs("line", [4]))),
        (1005, "http://c.org/p/3", page(paragraphs("other"))),
    ]
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: (r.text, r.n_deleted) for r in op1_html_diff(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    assert all(found[i] == ("the article", 2) for i in range(300))
    assert found[1000] == ("another article", 2)
    assert found[1001] == found[1002] == ("Welcome to the site mirrored Write to us", 0)
    for i, name, changed in ((1003, "line", ()), (1004, "line", (4,)), (1005, "other", ())):
        assert found[i] == (" ".join(f"{name} {k}{' anew' if k in changed else ''}" for k in range(30)), 2)


def test_blocks_give_the_result_of_one_pass(spark, monkeypatch):
    monkeypatch.setattr(html_diff, "BLOCK", 2)
    rows = [
        (i, f"http://h{i // 40}.org/p/{i:03d}", f"<p>site {i // 3}</p><p>own {i}</p><p>foot</p>") for i in range(97)
    ]
    order = sorted(rows, key=lambda r: r[1])
    expected = {}
    for at, (i, url, html) in enumerate(order):
        host = url.split("/")[2]
        beside = [order[k] for k in (at - 1, at + 1) if 0 <= k < len(order) and order[k][1].split("/")[2] == host]
        path = url.split(host)[1]
        same = lambda other: html_diff._same_start(path, other[1].split(host)[1])
        lines = [x for x, _ in lines_of(html)]
        gone = set(shared_lines(lines, [x for x, _ in lines_of(max(beside, key=same)[2])])) if beside else set()
        expected[i] = " ".join(x for k, x in enumerate(lines) if k not in gone)
    found = {r.page_id: r.text for r in html_diff.main_texts(pages(spark, rows)).collect()}
    assert found == expected


def test_empty_table(spark):
    assert html_diff.main_texts(pages(spark, [])).collect() == []


def texts(html):
    return [text for text, label in html_diff.lines_of(html)]


@pytest.mark.parametrize(
    "html,lines",
    [
        ("<html><head><title>x</title><body><article><p>hello</p></article></body></html>", ["hello"]),
        ("<html><head><title>x</title><meta a=b><p>hello</p>", ["hello"]),
        ("<head><title>x</title>bare text<p>hello</p>", ["bare text", "hello"]),
        ("<head><title>a < b</title><script>if (a < b) '</head>'</script></head><p>hello", ["hello"]),
        ('<p title="a>b">text</p>', ["text"]),
        ("<p title='a>b' data-x = \"<i>\">text</p>", ["text"]),
        ("<p title=it's>one</p><p>isn't</p>", ["one", "isn't"]),
        ('<p title="never closed>one</p><p>two</p>', ["one", "two"]),
        ("a <b c", ["a <b c"]),
        ("1 < 2 <p>3 <4", ["1 < 2", "3 <4"]),
        ("<p>a<!-- b > c --> d<!doctype x><?php e ?> f</p>", ["a d f"]),
        ("<p>a</p><!-- never closed <p>b</p>", ["a"]),
        ("<p>a</p><svg width=1/><p>b</p><svg><title>t</title></svg><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><script src=x>never closed <p>b</p>", ["a"]),
        ("<scripty>kept</scripty>", ["kept"]),
    ],
)
def test_tags_are_told_from_text(html, lines):
    assert texts(html) == lines


@pytest.mark.parametrize("piece", ["<a ", "<a x=\"", "<a x='>", "<!- ", "<script ", "</script ", "<p ", "<", "<!--", "<textarea>", "='", "<a ='>\"", "<head>"])
def test_unclosed_tags_take_linear_time(piece):
    import time

    started = time.perf_counter()
    html_diff.lines_of("<p>start</p>" + piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - started < 20
