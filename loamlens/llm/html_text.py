"""Main text of web pages: flat blocks, their neighbours, and a decision tree over both."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# fixed values: names of the HTML standard
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir
    div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li
    main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul
    """.split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "object")
CONTAINERS = BLOCK - frozenset("p hr li dt dd h1 h2 h3 h4 h5 h6 tr td th option".split())
SIDE = frozenset("nav footer aside form head menu button select dialog fieldset title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# fixed values: words in class, id and role that name what isn't the article, or is
SIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb
    breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer form gdpr
    header hidden login menu menubar modal nav navbar navigation newsletter notice notices pagination
    pager popup promo promoted promotion related reply replies respond search share sharing sidebar
    signup social sponsor sponsored subscribe teaser toolbar widget widgets masthead complementary
    contentinfo""".split())
MAIN_WORDS = frozenset("article content entry main maincontent post story".split())

# a tag up to its end outside of quoted values; a quote that never closes is an ordinary character
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)
    ((?:[^>"'=]++ | =\s*+(?:"[^"]*+"|'[^']*+')? | ["'])*+)>""", re.X)
# the same where no quote counts
_BARE_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>")
_CDATA = re.compile(r"<!\[CDATA\[", re.I)
_NAMED = re.compile(r"</?[a-zA-Z]")
_RAW_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW}
_DIGITS = re.compile(r"&#([0-9]{8,})")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)

#: what the tree sees of a block: words, share of them in links, the same for the blocks before and
#: after, whether it is a heading, and what its page says of it: 1 inside the main part it marks, -1
#: inside a side part or outside of the main part it marks, 0 nothing
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading",
            "part")

# fixed values: the labelled table, blocks of ordinary pages in the order of FEATURES, then 1 for
# article and 0 for the rest. The first 73 were written by hand, the others are blocks of given pages
# with the page's marks left out.
LABELLED = """
 1 1.0  0 0.0   1 1.0  0 -1  0
 1 1.0  1 1.0   1 1.0  0 -1  0
 2 1.0  1 1.0   9 0.0  0 -1  0
 1 1.0  1 1.0  12 0.0  0  0  0
 3 1.0  2 1.0   3 1.0  0  0  0
 6 0.0  1 1.0   8 0.0  0 -1  0
 9 0.0  1 1.0  10 0.0  0 -1  0
12 0.0  2 1.0   7 0.0  0 -1  0
25 0.0  9 0.0  30 0.0  0 -1  0
60 0.0 40 0.0   0 0.0  0 -1  0
40 0.1 55 0.0   4 0.0  0 -1  0
30 0.0 80 0.0  20 0.0  0 -1  0
45 0.0 30 0.0   6 0.0  0 -1  0
 4 0.0 50 0.0  12 0.0  0 -1  0
 2 1.0 60 0.0   2 1.0  0 -1  0
 5 0.0 70 0.0   3 0.0  1 -1  0
10 0.0 40 0.0   0 0.0  0 -1  0
 8 0.2 90 0.0   0 0.0  0 -1  0
 7 0.0  6 0.0  60 0.0  1  1  1
10 0.0  8 0.0  45 0.0  1  1  1
 3 0.0 12 0.0   1 0.0  1  1  1
60 0.0  9 0.0  80 0.0  0  1  1
 1 0.0 40 0.0   1 0.0  0  1  1
 1 0.0  1 0.0  30 0.0  0  1  1
 2 0.0  0 0.0   9 0.0  0  1  1
 4 1.0 50 0.0  60 0.0  0  1  1
 8 0.0 20 0.0   8 0.0  0  1  1
35 0.1  7 0.0  10 0.0  0  1  1
90 0.0 70 0.0  12 0.0  0  1  1
15 0.3 80 0.0   5 0.0  0  1  1
 5 1.0 30 0.0   6 1.0  0  1  1
 4 0.0 30 0.0   0 0.0  0  1  1
 1 0.0  2 0.0   0 0.0  0  1  1
 2 0.0  0 0.0   0 0.0  1  1  1
 3 1.0  4 0.0   6 1.0  0  1  1
12 0.0  8 0.0  20 1.0  0  1  1
 6 0.5 10 0.0   9 0.9  0  1  1
 7 0.0  5 0.9  11 0.8  0  1  1
 2 1.0  1 1.0   2 1.0  0  1  1
 5 0.2  3 0.8   4 1.0  1  1  1
 6 0.0  9 1.0  70 0.0  1  0  1
 8 0.0  3 1.0  90 0.0  1  0  1
 5 0.0 60 0.0  50 0.0  1  0  1
 4 0.0 70 0.0   3 1.0  1  0  0
 3 0.0  2 1.0   2 1.0  1  0  0
60 0.0  6 0.0  70 0.0  0  0  1
40 0.1 50 0.0  55 0.0  0  0  1
25 0.0 60 0.0  30 0.1  0  0  1
18 0.0 45 0.0  50 0.0  0  0  1
 9 0.0 50 0.0  60 0.0  0  0  1
 5 0.0 40 0.0  35 0.0  0  0  1
12 0.0 60 0.0   4 1.0  0  0  1
30 0.0  8 0.0   3 1.0  0  0  1
22 0.0  0 0.0   0 0.0  0  0  1
 8 0.0  0 0.0   0 0.0  0  0  0
 4 0.0  3 1.0   5 0.0  0  0  0
 6 0.1  4 0.0   3 1.0  0  0  0
 5 0.0 70 0.0   0 0.0  0  0  0
30 0.8  5 0.9  12 0.8  0  0  0
16 0.6 50 0.0  14 0.7  0  0  0
10 0.9 70 0.0   8 0.9  0  0  0
 9 0.0  1 1.0  60 0.0  0 -1  0
14 0.0  2 1.0  45 0.0  0 -1  0
30 0.0 12 0.0  70 0.0  0 -1  0
 8 0.0 40 0.0  55 0.0  0 -1  0
45 0.0 50 0.0  60 0.0  0 -1  0
80 0.0 70 0.0  90 0.0  0 -1  0
12 0.0 60 0.0  80 0.0  0 -1  0
20 0.0  1 1.0  45 0.0  1 -1  0
60 0.2 80 0.0  40 0.1  0 -1  0
 6 0.0  0 0.0  50 0.0  1 -1  0
 3 1.0 70 0.0  90 0.0  0 -1  0
25 0.6  4 1.0  40 0.0  0 -1  0
 1 1.0  1 1.0   1 1.0  0  0  0
 1 1.0  1 1.0   5 0.0  0  0  0
 1 1.0  5 0.0   1 1.0  0  0  0
 1 1.0  8 0.0   1 1.0  0  0  0
 1 1.0  9 0.0   1 1.0  0  0  0
 2 0.0 17 0.0  85 0.0  0  0  1
 3 0.0  0 0.0   1 1.0  0  0  0
 4 0.0 121 0.0 131 0.0  0  0  1
 4 0.0 21 0.0  14 0.0  0  0  1
 5 0.0  1 1.0  11 0.0  0  0  0
 6 0.0  2 0.0  87 0.0  0  0  1
 6 0.0  5 0.0   6 0.0  1  0  1
 7 0.0  8 0.0   0 0.0  0  0  0
 7 0.0 150 0.0   0 0.0  0  0  0
 8 0.0  0 0.0   1 1.0  0  0  0
 8 0.0  1 1.0   6 0.0  0  0  0
 8 0.0  8 0.0   0 0.0  0  0  0
 9 0.0  0 0.0   1 1.0  0  0  0
 9 0.0  1 1.0   6 0.0  0  0  0
 9 0.0  1 1.0   8 0.0  0  0  0
 9 0.0  5 0.0   0 0.0  0  0  0
 9 0.0 120 0.0   0 0.0  0  0  0
 9 0.0 132 0.0   0 0.0  0  0  0
10 0.0  0 0.0   1 1.0  0  0  0
10 0.0 19 0.0   3 0.0  0  0  1
11 0.0  0 0.0   1 1.0  0  0  0
11 0.0 59 0.0  19 0.0  0  0  1
12 0.0  0 0.0   1 1.0  0  0  0
12 0.0  5 0.0  14 0.0  1  0  1
12 0.0  8 0.0  20 0.0  1  0  1
12 0.0  8 0.0  42 0.0  1  0  1
12 0.0  9 0.0   0 0.0  0  0  0
12 0.0 19 0.0   0 0.0  0  0  0
12 0.0 91 0.0   4 0.0  0  0  1
122 0.0 45 0.0 123 0.0  0  0  1
13 0.0  0 0.0   1 1.0  0  0  0
16 0.0 29 0.0   0 0.0  0  0  0
16 0.0 70 0.0   0 0.0  0  0  0
18 0.0 28 0.0   5 0.0  0  0  1
18 0.0 87 0.0   3 0.0  0  0  1
19 0.0  9 0.0 138 0.0  0  0  1
19 0.0 56 0.0  38 0.0  0  0  1
20 0.0 30 0.0   8 0.0  0  0  1
211 0.0 23 0.0  35 0.0  0  0  1
24 0.0  7 0.0  14 0.0  0  0  1
27 0.0 40 0.0 108 0.0  0  0  1
29 0.0 27 0.0  16 0.0  0  0  1
31 0.0 39 0.0   5 0.0  0  0  1
32 0.0 21 0.0  13 0.0  0  0  1
32 0.0 50 0.0   6 0.0  0  0  1
36 0.0  5 0.0  47 0.0  0  0  1
37 0.0 11 0.0   3 0.0  0  0  1
37 0.0 17 0.0   1 0.0  0  0  1
40 0.0 108 0.0   2 0.0  0  0  1
43 0.0 17 0.0  42 0.0  0  0  1
47 0.0 63 0.0  42 0.0  0  0  1
48 0.0 57 0.0  34 0.0  0  0  1
52 0.0 31 0.0 152 0.0  0  0  1
57 0.0 81 0.0  32 0.0  0  0  1
61 0.0  5 0.0   7 0.0  0  0  1
78 0.0 82 0.0  10 0.0  0  0  1
81 0.0 214 0.0 215 0.0  0  0  1
"""


@dataclass(frozen=True)
class Block:
    text: str
    words: int
    linked: int
    side: bool
    main: bool
    heading: bool


def _marks(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element opens a side part, and whether it opens the marked main part."""
    if not attributes:
        return name in SIDE, name in ("article", "main")
    words = {w for value in _NAMES.findall(attributes)
             for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower())}
    side = name in SIDE or bool(words & SIDE_WORDS) or bool(_HIDDEN.search(attributes))
    main = name in ("article", "main") or bool(words & MAIN_WORDS)
    return side, main


def decoded(text: str) -> str:
    """Character references as characters; a number beyond Unicode, however long, is U+FFFD."""
    if "&" not in text:
        return text
    if "&#" in text:  # int() refuses very long numbers
        text = _DIGITS.sub(lambda m: f"&#{m[1].lstrip('0')[:8]}", text)
    return entities.unescape(text)


def tokens(page: str) -> Iterator[tuple[str, bool, str, str]]:
    """Text as ``("", False, "", text)`` and tags as ``(name, closing, attributes, "")``, in one pass.

    Nothing is read twice but for a constant number of searches to the end of the page: a "<" without any
    ">" after it is text, as is all that follows; once a tag's quotes leave it without an end, quotes no
    longer count. Comments and declarations are left out, raw elements become a space.
    """
    at, last, tag_of = 0, page.rfind(">"), _TAG
    while 0 <= (start := page.find("<", at)) < last:
        if start > at:
            yield "", False, "", page[at:start]
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
        elif _CDATA.match(page, start):
            at = start + 9
        elif page[start + 1] in "!?" or page.startswith("</", start) and not _NAMED.match(page, start):
            at = page.find(">", start) + 1
        elif _NAMED.match(page, start):
            tag = tag_of.match(page, start)
            if not tag:
                tag_of = _BARE_TAG
                tag = tag_of.match(page, start)
            at = tag.end()
            closing, name, attributes = tag[1] == "/", tag[2].lower(), tag[3]
            if name in _RAW_END and not closing:
                if not attributes.endswith("/"):
                    end = _RAW_END[name].search(page, at)
                    at = end.end() if end else len(page)
                yield "", False, "", " "
            else:
                yield name, closing, attributes, ""
        else:
            yield "", False, "", "<"
            at = start + 1
    rest = _CDATA.sub("", page[at:].partition("<!--")[0])
    if rest:
        yield "", False, "", rest


def blocks_of(page: str | None) -> list[Block]:
    """The page's text blocks in order, in time linear in its length, however broken its markup.

    Tags within a block don't split words; a line break is a space. A header inside the marked main part
    is part of it, one outside is a side part.
    """
    out: list[Block] = []
    open_parts: list[tuple[str, bool, bool]] = []  # name, in a side part, in the main part
    n_open: Counter[str] = Counter()
    pieces: list[str] = []
    linked, in_link, heading, lone_side = 0, 0, False, False

    def flush():
        nonlocal linked, heading, lone_side
        text = " ".join("".join(pieces).split())
        if text:
            side, main = open_parts[-1][1:] if open_parts else (False, False)
            n = text.count(" ") + 1
            out.append(Block(text, n, min(n, linked), side or lone_side, main, heading))
        pieces.clear()
        linked, heading, lone_side = 0, False, False

    for name, closing, attributes, raw in tokens(page or ""):
        if raw:
            text = decoded(raw)
            pieces.append(text)
            if in_link:
                linked += len(text.split())
        elif name == "a":
            in_link = 0 if closing else 1
        elif name == "br":
            pieces.append(" ")
        elif name in BLOCK:
            flush()
            in_link = 0
            if closing:
                # parts left open inside of it end with it
                while n_open[name]:
                    ended = open_parts.pop()[0]
                    n_open[ended] -= 1
                    if ended == name:
                        break
                continue
            side, main = _marks(name, attributes)
            above = open_parts[-1][1:] if open_parts else (False, False)
            if name == "header" and not above[1]:
                side = True
            if name in CONTAINERS:
                if not attributes.endswith("/"):
                    open_parts.append((name, above[0] or side, above[1] or main))
                    n_open[name] += 1
            else:
                heading, lone_side = name in HEADINGS, side
    flush()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block, in the order of ``FEATURES``."""
    own = np.array([(b.words, b.linked / b.words) for b in blocks], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    marked = any(b.main and not b.side for b in blocks)
    part = [(b.heading, -1 if b.side or marked and not b.main else int(b.main)) for b in blocks]
    return np.hstack([own, np.vstack([edge, own])[:-1], np.vstack([own, edge])[1:],
                      np.array(part, float).reshape(-1, 2)])


@dataclass(frozen=True)
class Node:
    """A leaf has no feature and says ``label``; otherwise values up to ``at`` go to ``low``."""

    label: int
    feature: int = -1
    at: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Node:
    """A decision tree by Gini impurity; the earlier feature and the lower threshold win ties."""
    label = int(2 * y.sum() > len(y))
    if not depth or y.min() == y.max():
        return Node(label)
    best = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for at in (values[1:] + values[:-1]) / 2:
            low = x[:, feature] <= at
            impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, at
    if best is None:
        return Node(label)
    _, feature, at = best
    low = x[:, feature] <= at
    return Node(label, feature, float(at), grow(x[low], y[low], depth - 1),
                grow(x[~low], y[~low], depth - 1))


def classify(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), bool(node.label))
    low = x[:, node.feature] <= node.at
    return np.where(low, classify(node.low, x), classify(node.high, x))


def trained() -> Node:
    rows = np.array([line.split() for line in LABELLED.strip().splitlines()], float)
    return grow(rows[:, :-1], rows[:, -1])


def written(node: Node, indent: str = "") -> str:
    """The tree as lines of text."""
    if node.feature < 0:
        return f"{indent}{'article' if node.label else 'rest'}"
    return (f"{indent}{FEATURES[node.feature]} <= {node.at:g}\n{written(node.low, indent + '  ')}\n"
            f"{indent}otherwise\n{written(node.high, indent + '  ')}")


def main_text(page: str | None, tree: Node) -> str:
    """The blocks that the tree takes for the article, one per line; empty if there is none."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    kept = classify(tree, features(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``.

    A null page is empty; broken markup is read as far as it goes; very long pages, hostile ones included,
    take time linear in their length; repeated rows are each extracted; an empty table gives an empty
    one; other columns of ``pages``, ``text`` and ``n_chars`` included, are not read. Nothing is
    shuffled. The tree is trained once by the driver from the table above and sent along.
    """
    tree = pages.sparkSession.sparkContext.broadcast(trained())

    def run(batches):
        for batch in batches:
            texts = [main_text(p, tree.value) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string").withColumn(
            "n_chars", F.char_length("text").cast("bigint"))
