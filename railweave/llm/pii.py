"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole spans.

Base spans follow the fixed patterns (emails, IP addresses, card and phone numbers) and always stay. The field adds
spans the patterns miss, such as spelled-out emails, defanged addresses, cards with other separators and
phone numbers without a plus. It works on regions, the text around whatever some shape of a span cannot do without, cut into
tokens. Every run of tokens of at most ``MAX_SPAN`` characters is a candidate segment of every kind; features of the whole span and
its context score it, and dynamic programming over the tokens chooses the best set of segments jointly, so that boundaries and kinds compete. Segments
that touch a base span are no candidates.

Fitting: base spans are found in all documents first. Then, by a hash of the ids, at most ``PER_KIND`` windows around base spans
are drawn for each kind, and at most ``NEGATIVES`` regions of documents without any; every task sends on no more than that.
However rare a kind is, its spans are found among all rows. Each window also
enters with its spans rewritten into forms the patterns miss, and with spans made invalid (a failing check
digit, an address part above 255, too few digits), which then count as no data. The weights maximise the likelihood of these segmentations.

Defined results: null and empty texts have no spans. Positions are code points, ends exclusive. Long texts are
searched whole, in time linear in their length. Rows are judged one by one, repeated ids too. An empty
table, or one without any base span, gives the base spans only. A kind without any base span in the table is not added.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railweave.llm.mixing import uniform
from railweave.llm.text import bound_batches, plain_text
from railweave.session import materialize

#: The kinds, in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone")
#: Windows fitted on, at most: for each kind, and regions of documents without base spans; windows of one kind from one document.
PER_KIND, NEGATIVES, PER_DOCUMENT = 50, 100, 4
#: Longest window.
WINDOW = 400
#: Longest candidate; text of a region on both sides of its sign, so that no candidate is cut; text before a span searched for cues.
MAX_SPAN, CONTEXT, CUE = 64, 64, 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive forms of the fixed patterns: the same matches without trying a start twice.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Where regions lie: two digits in a row, a plus before a digit, a mail sign, a bracketed at or dot, a spelled-out dot, a
#: spelled-out at before a domain, three groups of hex digits. Every shape below holds one of these.
_SIGN = re.compile(
    r"[0-9]{2,}|\+[0-9]|@|[\[({]\s?(?:at|AT|dot|DOT|\.)\s?[\])}]|\s(?:dot|DOT)(?=\s)"
    r"|\s(?:at|AT)\s[A-Za-z0-9-]++\.[A-Za-z0-9-]|[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]"
)
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start and then kind."""
    spans: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            spans.append(("email", start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        spans += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0].split("."))]
        for match in _CARD.finditer(text):
            digits = _digits(match[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *match.span()))
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


# Whole-span features ----------------------------------------------------------------------------

_AT = r"(?:\s?@\s?|\s?[\[({]\s?(?:at|AT)\s?[\])}]\s?|\s(?:at|AT)\s)"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?|\s(?:dot|DOT)\s)"
_SHAPES = {
    "email": {
        "plain": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
        "spelled": re.compile(rf"[A-Za-z0-9][A-Za-z0-9._%+-]*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+"),
    },
    "ip": {
        "quad": re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
        "defanged": re.compile(r"[0-9]{1,3}(?:\s?[\[({]\s?(?:\.|dot)\s?[\])}]\s?[0-9]{1,3}){3}"),
        "hextets": re.compile(r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}"),
    },
    "card": {
        "fours": re.compile(r"[0-9]{4}(?:[ ._/-]{1,2}[0-9]{4}){3}"),
        "other groups": re.compile(r"[0-9]{4}(?:[ ._/-]{1,2}[0-9]{2,7}){2,4}"),
        "run": re.compile(r"[0-9]{14,19}"),
    },
    "phone": {
        "plus": re.compile(r"\+[0-9][ ().0-9-]+[0-9]"),
        "zeros": re.compile(r"00[1-9][0-9]{0,2}[ ().-]{1,2}[0-9][ ().0-9-]+[0-9]"),
        "area": re.compile(r"\(0?[0-9]{2,5}\)[ -]?[0-9]{3,4}[ -]?[0-9]{3,5}"),
        "dashes": re.compile(r"[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"),
    },
}
_CUES = {
    "email": re.compile(r"mail|contact|write|reach", re.I),
    "ip": re.compile(r"\bip\b|host|server|addr", re.I),
    "card": re.compile(r"card|visa|master|credit|pay", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobil|cell", re.I),
}


def features(kind: str, text: str, start: int, end: int) -> list[str] | None:
    """Names of the span's features; None if the span has none of the kind's shapes."""
    span = text[start:end]
    shapes = [name for name, shape in _SHAPES[kind].items() if shape.fullmatch(span)]
    if not shapes:
        return None
    digits = _digits(span)
    found = [f"{kind} {name}" for name in shapes] + [kind]
    found.append(f"{kind} {min(len(digits), 20)} digits" if kind != "email" else f"email {min(span.count('.'), 3)} dots")
    if kind == "card":
        found.append(f"card check {luhn(digits)} length {14 <= len(digits) <= 19}")
    if kind == "ip" and "hextets" not in shapes:
        found.append(f"ip parts {_octets(re.findall('[0-9]+', span))}")
    if kind == "phone":
        found.append(f"phone length {10 <= len(digits) <= 15}")
    if kind == "email":
        tail = re.findall(r"[A-Za-z]+", span)[-1:] or [""]
        found.append(f"email tail {min(len(tail[0]), 7)}")
    if _CUES[kind].search(text[max(0, start - CUE) : start]):
        found.append(f"{kind} cue")
    for side, at in (("before", start - 1), ("after", end)):
        beside = text[at] if 0 <= at < len(text) else " "
        if beside.isalnum() or beside in "@+":
            found.append(f"{kind} cut {side}")
        elif beside in "-._/" and 0 <= at < len(text) and (text[at + 1 : at + 2] if side == "after" else text[max(0, at - 1) : at]).isalnum():
            found.append(f"{kind} joined {side}")
    return found


# The field --------------------------------------------------------------------------------------


def regions(text: str) -> list[tuple[int, int]]:
    """Where spans can lie, in order and apart from each other."""
    found: list[list[int]] = []
    for match in _SIGN.finditer(text):
        low, high = max(0, match.start() - CONTEXT), min(len(text), match.end() + CONTEXT)
        if found and low <= found[-1][1]:
            found[-1][1] = high
        else:
            found.append([low, high])
    return [(a, b) for a, b in found]


def covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover, in order and apart."""
    starts: list[int] = []
    ends: list[int] = []
    for _, start, end in spans:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def segments(text: str, low: int, high: int, taken: tuple[list[int], list[int]]) -> tuple[int, list[tuple]]:
    """The number of tokens in the region, and its candidates (first token, token after, kind, features, start, end)."""
    tokens = [m.span() for m in _TOKEN.finditer(text, low, high)]
    starts, ends = taken
    # The first cover that ends after the token's start must not begin before its end.
    blocked = [(at := bisect_right(ends, a)) < len(starts) and starts[at] < b for a, b in tokens]
    digital = [text[a].isdigit() for a, _ in tokens]
    out = []
    for i, (start, _) in enumerate(tokens):
        lead = text[start]
        for j in range(i, len(tokens)):
            end = tokens[j][1]
            if blocked[j] or end - start > MAX_SPAN:
                break
            if j == i and not digital[j] or not (text[end - 1].isalnum()):
                continue
            kinds = ("ip", "card", "phone") if digital[i] else ("phone",) if lead in "+(" else ()
            if lead.isalnum():
                kinds = ("email", *kinds, *(("ip",) if not digital[i] and ":" in text[start:end] else ()))
            for kind in kinds:
                names = features(kind, text, start, end)
                if names:
                    out.append((i, j + 1, kind, names, start, end))
    return len(tokens), out


def decode(weights: dict[str, float], n: int, candidates: list[tuple]) -> list[tuple]:
    """The best-scoring set of disjoint segments; a token outside of all segments scores 0."""
    ending = defaultdict(list)
    for candidate in candidates:
        ending[candidate[1]].append((candidate, sum(weights.get(f, 0.0) for f in candidate[3])))
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j], back[j] = best[j - 1], None
        for candidate, score in ending[j]:
            if best[candidate[0]] + score > best[j]:
                best[j], back[j] = best[candidate[0]] + score, candidate
    chosen, j = [], n
    while j:
        if back[j]:
            chosen.append(back[j])
            j = back[j][0]
        else:
            j -= 1
    return chosen[::-1]


def fit(examples: list[tuple[str, list[Span]]], rounds: int = 30, rate: float = 0.5, decay: float = 0.01) -> dict[str, float]:
    """Weights that maximise the likelihood of the spans of each text among all its segmentations."""
    index: dict[str, int] = {}
    lattices = []
    for text, spans in examples:
        n, candidates = segments(text, 0, len(text), ([], []))
        gold = {(k, s, e) for k, s, e in spans}
        arcs = [
            (i, j, [index.setdefault(f, len(index)) for f in names], (kind, s, e) in gold)
            for i, j, kind, names, s, e in candidates
        ]
        if arcs:
            lattices.append((n, arcs))
    weights = np.zeros(len(index))
    for turn in range(rounds):
        gradient = -decay * weights * max(1, len(lattices))
        for n, arcs in lattices:
            scores = [float(weights[f].sum()) for _, _, f, _ in arcs]
            by_end, by_start = defaultdict(list), defaultdict(list)
            for a, (i, j, _, _) in enumerate(arcs):
                by_end[j].append(a)
                by_start[i].append(a)
            forward, backward = np.zeros(n + 1), np.zeros(n + 1)
            for j in range(1, n + 1):
                forward[j] = np.logaddexp.reduce([forward[j - 1], *(forward[arcs[a][0]] + scores[a] for a in by_end[j])])
            for i in range(n - 1, -1, -1):
                backward[i] = np.logaddexp.reduce([backward[i + 1], *(backward[arcs[a][1]] + scores[a] for a in by_start[i])])
            for a, (i, j, names, right) in enumerate(arcs):
                gradient[names] += right - math.exp(forward[i] + scores[a] + backward[j] - forward[n])
        weights += rate / (1 + turn / 10) / max(1, len(lattices)) * 20 * gradient
    return {name: float(weights[i]) for name, i in index.items()}


def _rewritten(kind: str, span: str, draw: random.Random, valid: bool) -> str:
    """The span in a form that the patterns miss, or made invalid."""
    if kind == "email":
        if not valid:
            return span.replace("@", " ").replace(".", " ")
        at = draw.choice([" at ", " [at] ", "(at)", " (at) ", "[at]"])
        dot = draw.choice([" dot ", "[dot]", " (dot) ", "."])
        local, _, domain = span.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        if not valid:
            return ".".join([*span.split(".")[:3], str(draw.randint(256, 999))])
        return span.replace(".", draw.choice(["[.]", "(.)", "[dot]"]))
    digits = _digits(span)
    if kind == "card":
        if not valid:
            digits = digits[:-1] + str((int(digits[-1]) + draw.randint(1, 9)) % 10)
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return draw.choice([".", "_", "/", "  "]).join(groups)
    if not valid:
        return f"{digits[:3]}-{digits[3:6]}-{draw.randint(10, 99)}"
    last = digits[-10:]
    return draw.choice(
        [f"({last[:3]}) {last[3:6]}-{last[6:]}", f"{last[:3]}-{last[3:6]}-{last[6:]}", f"00{digits[:2].lstrip('0') or '1'} {digits[2:6]} {digits[6:]}"]
    )


def training_examples(found: list[tuple[str, list[Span]]]) -> list[tuple[str, list[Span]]]:
    """Each region as it is, rewritten and made invalid, with the spans that hold in each form."""
    draw = random.Random(7)
    out = []
    for text, spans in found:
        disjoint = [s for i, s in enumerate(spans) if all(s[1] >= t[2] for t in spans[:i])]
        for form in ("plain", "rewritten", "invalid"):
            pieces, at, gold, length = [], 0, [], 0
            for kind, start, end in disjoint:
                new = text[start:end] if form == "plain" else _rewritten(kind, text[start:end], draw, form == "rewritten")
                pieces += [text[at:start], new]
                length += start - at
                if form != "invalid":
                    gold.append((kind, length, length + len(new)))
                length += len(new)
                at = end
            out.append(("".join([*pieces, text[at:]]), gold))
            if not disjoint:
                break
    return out


def _find(weights: dict[str, float]):
    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame.text_:
                base = base_spans(text)
                added: list[Span] = []
                if weights:
                    taken = covered(base)
                    for low, high in regions(text):
                        n, candidates = segments(text, low, high, taken)
                        added += [(c[2], c[4], c[5]) for c in decode(weights, n, candidates)]
                every = sorted([*base, *added], key=lambda s: (s[1], KINDS.index(s[0])))
                listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
                rows.append(
                    (
                        *(sum(s[0] == kind for s in base) for kind in KINDS),
                        hashlib.sha256(listed.encode()).hexdigest(),
                        ",".join(f"{k}:{a}:{b}" for k, a, b in every),
                        len(added),
                    )
                )
            found = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])
            found.insert(0, "id_", frame.id_.array)
            yield found

    return find


def _window(spans: list[Span], length: int, at: Span) -> tuple[int, int]:
    """The text around a span, without the parts of other spans at its edges."""
    _, start, end = at
    low, high = max(0, start - CONTEXT), min(length, end + CONTEXT)
    for _, a, b in spans:
        if a < low < b <= start:
            low = b
        elif end <= a < high < b:
            high = a
    return low, high


def labelled_windows(text: str) -> list[tuple[str, str, str]]:
    """(kind, window, its base spans); kind is empty for a region of a text without base spans."""
    spans = base_spans(text)
    if not spans:
        # A region without data teaches what to leave alone.
        return [("", text[a : min(b, a + WINDOW)], "") for a, b in regions(text)[:1]]
    out = []
    for kind in KINDS:
        for span in [s for s in spans if s[0] == kind][:PER_DOCUMENT]:
            low, high = _window(spans, len(text), span)
            if high - low <= WINDOW:
                inside = [(k, s - low, e - low) for k, s, e in spans if low <= s and e <= high]
                out.append((kind, text[low:high], ",".join(f"{k}:{a}:{b}" for k, a, b in inside)))
    return out


def _draw_windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each kind, and of the regions without data, the first in order of the draw."""
    drawn: dict[str, list[tuple]] = {kind: [] for kind in ("", *KINDS)}
    for frame in frames:
        for draw, text in zip(frame.draw_, frame.text_):
            for kind, window, listed in labelled_windows(text):
                drawn[kind].append((draw, window, listed))
        for kind, found in drawn.items():
            drawn[kind] = sorted(set(found))[: PER_KIND if kind else NEGATIVES]
    rows = [(kind, *row) for kind, found in drawn.items() for row in found]
    yield pd.DataFrame(rows, columns=["kind_", "draw_", "region_", "spans_"]).astype({"draw_": "float64"})


def fit_on(texts: DataFrame) -> dict[str, float]:
    """Weights from windows of (id_, text_), drawn by kind; empty if there is no base span."""
    drawn = materialize(
        texts.select(uniform(F.col("id_")).alias("draw_"), "text_").mapInPandas(
            _draw_windows, "kind_ string, draw_ double, region_ string, spans_ string"
        ),
        "pii-windows",
    )
    rows = set()
    for kind in ("", *KINDS):
        first = drawn.where(F.col("kind_") == kind).select("draw_", "region_", "spans_").distinct()
        first = first.orderBy("draw_", "region_", "spans_").limit(PER_KIND if kind else NEGATIVES)
        rows.update(tuple(row) for row in first.collect())
    found = []
    for _, region, listed in sorted(rows):
        parts = [x.rsplit(":", 2) for x in listed.split(",") if x]
        found.append((region, [(k, int(a), int(b)) for k, a, b in parts]))
    if not any(spans for _, spans in found):
        return {}
    return fit(training_examples(found))


def find_personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", weights: dict[str, float] | None = None
) -> DataFrame:
    """A row per row of ``docs``: the id, n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, spans (all of them), n_added."""
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_column).cast("long").alias("id_"), plain_text(F.col(text_column)).alias("text_"))
    if weights is None:
        weights = fit_on(texts)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return texts.mapInPandas(
        _find(weights), f"id_ long, {counts}, base_sha256 string, spans string, n_added long"
    ).withColumnRenamed("id_", id_column)
