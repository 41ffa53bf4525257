"""Main text of pages by differencing with the page of the nearest address.

1. A page becomes its visible lines: text between block tags, character references decoded, white space turned into single
   blanks. Scripts, styles, comments, the head and hidden elements give no lines. Lines are labelled: ``SITE`` in elements that
   say that they are menus, headers, footers, sidebars, notices, adverts, forms or reader comments (by tag, role, class or
   id), and outside of the article on pages that mark one; ``ARTICLE`` in a marked article; else ``OPEN``. Elements end at their end tag, where HTML lets that be
   omitted (p, li, dt, dd, option and the parts of tables), and with the elements around them.
2. Pages are ordered by host, path and address. A page is paired with its neighbour in that order that has
   the same host and the longer common path, the earlier one if equal. With ``skip_copies`` pages of a host whose lines (but
   for SITE lines) are equal stand in that order once, at their first address, and share the deletions found there; and
   neighbours that share ``NEARLY_ALL`` lines are passed over, up to ``REACH`` places on either side. A page with no other
   neighbour within reach loses nothing.
3. The line sequences of a pair are aligned by their longest common subsequence. The page's shared lines are the site's
   and are deleted; so are SITE lines, which need not be the same on every page. ARTICLE lines stay: what two marked
   articles share is a passage that both quote.

Only hashes of lines travel: pages are numbered in the order of their addresses, and blocks of ``BLOCK`` consecutive numbers
with the pages beside them are aligned together, so that a host of any size is spread evenly. Deletions of OPEN
lines come back as a table of the pages that have any.

Defined results: null and empty html have empty text. Pages without a host have no neighbours. Rows that repeat id, address
and html are one page and get the same text. Long pages are aligned whole, in memory linear in their length. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railweave.llm.text import bound_batches, host_of, path_of, plain_text
from railweave.session import materialize

BLOCK, TASK_BLOCKS = 64, 16
#: Neighbours looked at on either side, and the share of lines that makes one a copy.
REACH, NEARLY_ALL = 4, 0.95
SITE, OPEN, ARTICLE = 0, 1, 2

#: Elements whose content is no visible text.
_UNSEEN = frozenset("script style template noscript svg iframe textarea select title".split())
#: Elements that a head may hold: any other starts the body, with or without ``</head>``.
_IN_HEAD = frozenset("html head meta link base title script style template noscript".split())
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)")
# Quotes hide ``>`` where they hold a value.
_ATTRIBUTES = re.compile(r"""((?:[^>=]|=\s*+"[^"]*"|=\s*+'[^']*'|=)*+)>""")
_END_OF = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in _UNSEEN}
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BOILERPLATE_TAGS = frozenset("nav header footer aside form button dialog menu".split())
_BOILERPLATE_ROLES = frozenset("navigation banner complementary contentinfo search alert dialog form menu menubar".split())
_BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " copyright disclaimer disqus footer header legal login masthead menu modal nav navbar navigation newsletter notice notices"
    " overlay pager pagination popup promo promoted promotion recommended related share sharing sidebar signup social sponsor"
    " sponsored subscribe subscription toolbar widget".split()
)
#: Block elements at whose start an open paragraph ends.
_ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
#: Elements whose end tag may be missing, and the open ones that their start ends.
_ENDS_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
_TABLE_SECTIONS = frozenset("tbody thead tfoot caption colgroup".split())
#: Parts of tables, and the open elements that stay when one starts.
_STAYS = {
    **{tag: {"table"} for tag in _TABLE_SECTIONS},
    "tr": {"table", *_TABLE_SECTIONS},
    **{tag: {"table", "tr", *_TABLE_SECTIONS} for tag in ("td", "th")},
}
_CELLS = frozenset(("td", "th", "caption"))
_HEADINGS = frozenset(f"h{n}" for n in range(1, 7))
#: Deeper elements are not followed, as in browsers.
MOST_DEPTH = 512
_LABEL = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPACE = re.compile(r"\s+")


def _is_boilerplate(tag: str, attributes: str) -> bool:
    if tag in _BOILERPLATE_TAGS:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        # An article may still be a reader's comment.
        return tag == "article" and bool(re.search(r"\bcomments?\b", attributes, re.I))
    for name, *values in _LABEL.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value.strip() in _BOILERPLATE_ROLES:
                return True
            continue
        for label in value.split():
            words = re.split(r"[-_]+", label)
            if words[0] not in ("has", "with", "no", "without") and _BOILERPLATE_WORDS.intersection(words):
                return True
    return False


def _left_at_start(open_: list[str], tag: str) -> int:
    """How many of the open elements stay open where ``tag`` starts."""
    left = len(open_)
    if tag in _ENDS_P and "p" in open_:
        for i in range(left - 1, -1, -1):
            if open_[i] == "p":
                left = i
                break
            if open_[i] in _CELLS or open_[i] in ("button", "article", "main"):
                break
    if tag in _ENDS_LIKE:
        for i in range(left - 1, -1, -1):
            if open_[i] in _ENDS_LIKE[tag]:
                return i
            if open_[i] not in _INLINE and open_[i] not in ("address", "div", "p"):
                break
    elif tag in _STAYS and "table" in open_[:left]:
        while open_[left - 1] not in _STAYS[tag]:
            left -= 1
    return left


def _left_at_end(open_: list[str], tag: str) -> int:
    """How many of the open elements stay open after the end tag ``tag``. An article is left by its own end tag only; what is
    open in it ends with any element around it."""
    names = _HEADINGS if tag in _HEADINGS else {tag}
    if names.isdisjoint(open_):
        return len(open_)
    article = 0
    for i in range(len(open_) - 1, -1, -1):
        if open_[i] in names:
            return max(i, article)
        if open_[i] in ("article", "main"):
            article = article or (i + 1 if tag not in ("article", "main") else 0)
        elif open_[i] in _CELLS and tag not in _STAYS and tag not in ("table", "section", "article", "main", "body", "html"):
            break
    return len(open_)


def tags_of(html: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text before it, name, whether it closes, attributes) of every tag; last, with no name, the text behind them. Comments,
    declarations and what is never seen are left out. Every character is passed a bounded number of times."""
    at, text, in_head, last = 0, [], False, html.rfind(">")
    while True:
        start = html.find("<", at)
        # What comes without any ``>`` behind it is no tag, so an unclosed one is looked for once.
        if start < 0 or start > last and not html.startswith("<!--", start):
            text.append(html[at:])
            break
        text.append(html[at:start])
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = len(html) if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), start):
            at = html.find(">", start) + 1
            continue
        name = _NAME.match(html, start)
        if not name:
            text.append("<")
            at = start + 1
            continue
        tag, closing = name[1].lower(), html[start + 1] == "/"
        found = _ATTRIBUTES.match(html, name.end())
        # A quote that is never closed quotes nothing.
        at = found.end() if found else html.find(">", start) + 1
        attributes = html[name.end() : at - 1]
        if in_head and (tag not in _IN_HEAD or "".join(text).strip()):
            in_head = False
        if in_head:
            text.clear()
        yield "".join(text), tag, closing, attributes
        text.clear()
        if tag == "head":
            in_head = not closing
        elif tag in _UNSEEN and not closing and not (tag == "svg" and attributes.endswith("/")) and attributes[:1] in ("", "/", *" \t\n\r\f"):
            end = _END_OF[tag].search(html, at)
            at = len(html) if not end else end.start()
    yield "".join(text), "", False, ""


def lines_of(html: str | None) -> list[tuple[str, int]]:
    """The page's visible lines in order, with their labels."""
    if not html:
        return []
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    open_: list[str] = []  # block elements, and the inline ones that matter for ``site``
    counted: list[bool] = []  # which of them are articles outside of boilerplate
    inside = 0  # how many are
    site, top = "", 0  # the boilerplate or hidden element around, and how many elements are around it
    hidden = False

    def end_line() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        if text and not hidden:
            lines.append((text, SITE if site else ARTICLE if inside else OPEN))
        parts.clear()

    for text, tag, closing, attributes in tags_of(html):
        parts.append(text)
        if not tag or tag in _UNSEEN:
            continue
        conceals = not closing and tag not in _VOID and tag not in ("html", "body") and bool(_HIDDEN.search(attributes))
        opens_site = not closing and tag not in _VOID and (conceals or _is_boilerplate(tag, attributes))
        if tag not in _INLINE or opens_site or site == tag:
            end_line()
        if closing:
            if tag not in _INLINE:
                left = _left_at_end(open_, tag)
            else:
                left = len(open_) - 1 - open_[::-1].index(tag) if site == tag else len(open_)
        else:
            left = _left_at_start(open_, tag)
        inside -= sum(counted[left:])
        del open_[left:], counted[left:]
        if site and left <= top:
            site, hidden = "", False
        if closing or tag in _VOID:
            continue
        if site and tag in ("article", "main") and not opens_site and site != tag:
            site, hidden = "", False  # it was never closed
        if not site and opens_site:
            site, top, hidden = tag, len(open_), conceals
        elif tag in _INLINE and tag != site or attributes.endswith("/") or len(open_) >= MOST_DEPTH:
            continue
        open_.append(tag)
        counted.append(not site and tag in ("article", "main"))
        inside += counted[-1]
    end_line()
    if any(label == ARTICLE for _, label in lines):
        lines = [(text, SITE if label == OPEN else label) for text, label in lines]
    return lines


# Alignment --------------------------------------------------------------------------------------


def _lengths(a: list, b: list) -> np.ndarray:
    """For every prefix of ``b`` the length of its longest common subsequence with ``a``, bit-parallel."""
    places: dict = {}
    for i, item in enumerate(b):
        places[item] = places.get(item, 0) | (1 << i)
    full = (1 << len(b)) - 1
    row = full
    for item in a:
        hit = row & places.get(item, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8)
    zeros = 1 - np.unpackbits(bits, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate([[0], np.cumsum(zeros)])


def _common(a: list, b: list, low: int, out: list[int]) -> None:
    """Appends the places of ``a``, shifted by ``low``, that are in one longest common subsequence."""
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        out.append(low + head)
        head += 1
    a, b, low = a[head:], b[head:], low + head
    tail = 0
    while tail < len(a) and tail < len(b) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = [low + len(a) - tail + i for i in range(tail)]
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    in_b = set(b)
    kept = [i for i, item in enumerate(a) if item in in_b]
    if len(kept) == 1:
        out.append(low + kept[0])
    elif kept:
        # Halve the page, and split the other where both halves together are longest.
        half = len(kept) // 2
        first, second = [a[i] for i in kept[:half]], [a[i] for i in kept[half:]]
        before, after = _lengths(first, b), _lengths(second[::-1], b[::-1])[::-1]
        cut = int(np.argmax(before + after))
        found: list[int] = []
        _common(first, b[:cut], 0, found)
        _common(second, b[cut:], half, found)
        out.extend(low + kept[i] for i in found)
    out.extend(ends)


def shared_lines(page: list, other: list) -> list[int]:
    """The places in ``page`` of one longest common subsequence with ``other``."""
    out: list[int] = []
    _common(page, other, 0, out)
    return out


def deleted_lines(page: dict, before: dict | None, after: dict | None) -> list[int]:
    """Places of the lines that ``page`` shares with the nearer of its neighbours, but for those of its marked article.
    Pages have path, lines (hashes) and labels."""
    beside = [x for x in (before, after) if x]
    if not beside:
        return []
    nearest = max(beside, key=lambda x: _same_start(page["path"], x["path"]))
    return [i for i in shared_lines(page["lines"], nearest["lines"]) if page["labels"][i] != ARTICLE]


def _is_copy(page: dict, other: dict) -> bool:
    """Whether two pages share nearly all lines that are not SITE lines."""
    a, b = (Counter(line for line, label in zip(x["lines"], x["labels"]) if label != SITE) for x in (page, other))
    return (a & b).total() >= NEARLY_ALL * max(a.total(), b.total())


def _neighbour(pages: dict, rank: int, step: int, reach: int, skip_copies: bool) -> dict | None:
    """The next page of the same host in the direction of ``step``."""
    page = pages[rank]
    for at in range(rank + step, rank + step * (reach + 1), step):
        other = pages.get(at)
        if not other or not page["host"] or other["host"] != page["host"]:
            return None
        if not (skip_copies and _is_copy(page, other)):
            return other
    return None


def _same_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _outline(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(page_, key_, host_, path_, html_) to line hashes and labels instead of the html."""
    for frame in frames:
        pages = [lines_of(html) for html in frame.html_]
        digest = lambda text: hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest()
        hashes = [[int.from_bytes(digest(text), "little", signed=True) for text, _ in lines] for lines in pages]
        labels = [[label for _, label in lines] for lines in pages]
        kept = [[(h, label) for h, label in zip(*page) if label != SITE] for page in zip(hashes, labels)]
        text = [hashlib.blake2b(repr(lines).encode(), digest_size=16).hexdigest() for lines in kept]
        yield frame.drop(columns="html_").assign(lines_=hashes, labels_=labels, same_=text)


def _difference(reach: int, skip_copies: bool):
    """Deletions of the pages of some blocks, as places among the lines that are not SITE lines; pages marked ``beside_`` are
    there for their neighbours only."""

    def difference(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in frame.groupby("block_"):
            pages = {
                r.rank_: {"host": r.host_, "path": r.path_, "lines": list(r.lines_), "labels": list(r.labels_)}
                for r in block.itertuples(index=False)
            }
            for row in block[~block.beside_].itertuples(index=False):
                near = [_neighbour(pages, row.rank_, step, reach, skip_copies) for step in (-1, 1)]
                shared = set(deleted_lines(pages[row.rank_], *near))
                # SITE lines go anyway.
                places = [i for i, label in enumerate(row.labels_) if label != SITE]
                if gone := [k for k, i in enumerate(places) if i in shared]:
                    out.append((row.page_, row.key_, row.host_, row.same_, gone))
        found = pd.DataFrame(out, columns=["page_", "key_", "host_", "same_", "gone_"])
        return found.astype({"page_": "Int64", "key_": "Int64"})

    return difference


def _texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = []
        for html, gone in zip(frame.html_, frame.gone_):
            drop = set() if gone is None else set(gone)
            lines = [x for x, label in lines_of(html) if label != SITE]
            texts.append(" ".join(x for i, x in enumerate(lines) if i not in drop))
        yield pd.DataFrame(
            {
                "page_": frame.page_.array,
                "url_": frame.url_.array,
                "text": texts,
                "n_chars": [len(x) for x in texts],
                "n_deleted": [0 if g is None else len(g) for g in frame.gone_],
            }
        )


def main_texts(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", skip_copies: bool = False
) -> DataFrame:
    """A row per row of ``pages``: id, url, text, n_chars (code points), n_deleted (lines)."""
    bound_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_"),
        F.col(url_column).cast("string").alias("url_"),
        plain_text(F.col(html_column)).alias("html_"),
    ).withColumn("key_", F.xxhash64("page_", "url_", "html_"))
    outline = "page_ long, key_ long, host_ string, path_ string, lines_ array<long>, labels_ array<int>, same_ string"
    narrow = (
        rows.select("page_", "key_", host_of(F.col("url_")).alias("host_"), path_of(F.col("url_")).alias("path_"), "html_")
        .mapInPandas(_outline, outline)
        .dropDuplicates(["page_", "key_"])
    )
    narrow = materialize(narrow, "page-lines")
    compared, reach = narrow, 1
    if skip_copies:
        reach = REACH
        first = F.min(F.struct("path_", "page_", "key_", "lines_", "labels_")).alias("first_")
        compared = materialize(narrow.groupBy("host_", "same_").agg(first).select("host_", "same_", "first_.*"), "page-firsts")
    total = compared.count()
    order = ["host_", "path_", "page_", "key_"]
    # Numbers rise along the order: the partition in the high bits, the place in it in the low ones.
    placed = materialize(
        compared.repartitionByRange(max(1, -(-total // 20_000)), *order)
        .sortWithinPartitions(*order)
        .withColumn("place_", F.monotonically_increasing_id()),
        "page-order",
    )
    part = F.shiftright("place_", 33).alias("part_")
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = placed.groupBy(part).agg(F.count("*").alias("n_")).select(
        "part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_")
    )
    ranked = placed.withColumn("part_", part).join(F.broadcast(starts), "part_").withColumn(
        "rank_", F.col("start_") + F.col("place_").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("part_", "start_", "place_")
    own = F.floor(F.col("rank_") / BLOCK)
    low, high = (F.floor((F.col("rank_") + step) / BLOCK) for step in (-reach, reach))
    dealt = ranked.withColumn("block_", F.explode(F.sequence(F.greatest(low, F.lit(0).cast("long")), high))).withColumn(
        "beside_", F.col("block_") != own
    )
    gone = materialize(
        dealt.groupBy(F.floor(F.col("block_") / TASK_BLOCKS).alias("task_")).applyInPandas(
            _difference(reach, skip_copies), "page_ long, key_ long, host_ string, same_ string, gone_ array<int>"
        ),
        "page-deletions",
    )
    if skip_copies:
        shared = gone.select("host_", "same_", "gone_")
        gone = materialize(narrow.select("page_", "key_", "host_", "same_").join(shared, ["host_", "same_"]), "copy-deletions")
    gone = gone.select(F.col("page_").alias("of_page_"), F.col("key_").alias("of_key_"), "gone_")
    joined = rows.join(
        gone, F.col("page_").eqNullSafe(F.col("of_page_")) & (F.col("key_") == F.col("of_key_")), "left"
    ).select("page_", "url_", "html_", "gone_")
    return (
        joined.mapInPandas(_texts, "page_ long, url_ string, text string, n_chars long, n_deleted long")
        .withColumnsRenamed({"page_": id_column, "url_": url_column})
    )
