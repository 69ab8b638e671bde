"""Texts that a crawl contains and that a careless pattern takes the square of their length for."""

from __future__ import annotations

import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamlens.llm import html_text, line_dedup, secrets

LONG = 1_000_000


@pytest.mark.parametrize("tail", ["", ">", '">', "'\">x"])
@pytest.mark.parametrize("unit", [
    "<script ", "<a ", '<a b="', '<a b=">', "<a b='\">", '<a b="x\'>"<', "<!--", "<", "</", "<![CDATA[",
    "</section><div>", "<script>", "</script ", "&#9", "class=", "<p class='x' "])
def test_broken_pages_end(unit, tail):
    start = time.perf_counter()
    html_text.blocks_of(unit * (LONG // len(unit)) + tail)
    assert time.perf_counter() - start < 10


def test_parts_that_never_open_or_close():
    start = time.perf_counter()
    html_text.blocks_of("<div>" * 50_000 + "</section>" * 50_000)
    assert time.perf_counter() - start < 10


def test_long_character_references():
    page = "<p>&#" + "9" * 10_000 + "; &#" + "0" * 10_000 + "65; &#x41; &amp;"
    assert html_text.blocks_of(page)[0].text == "� A A &"


def test_broken_markup_has_a_meaning():
    texts = lambda page: [b.text for b in html_text.blocks_of(page)]
    assert texts("a < b <i>c") == ["a < b c"]
    assert texts("<p>a<p title=\"x>b</p><p>c") == ["a", "b", "c"]
    assert texts("<p>a <script") == ["a <script"]
    assert texts("<p>a<script>b</SCRIPT >c<!-- d --><p>e<!-- f") == ["a c", "e"]
    assert texts("<p title='a>b'>c</p></3>d<?php e?>") == ["c", "d"]
    assert texts("<p>a<svg/>b</p><![CDATA[c") == ["a b", "c"]


class _Plain(HTMLParser):
    """Blocks as lists of pieces, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.link, self.raw = [["", 0]], False, None

    def handle_starttag(self, tag, attrs):
        if tag in html_text.RAW:
            self.raw = tag
        elif tag == "a":
            self.link = True
        elif tag == "br":
            self.blocks[-1][0] += " "
        elif tag in html_text.BLOCK:
            self.blocks.append(["", 0])
            self.link = False

    def handle_endtag(self, tag):
        if tag == self.raw:
            self.raw = None
            self.blocks[-1][0] += " "
        elif tag == "a":
            self.link = False
        elif tag in html_text.BLOCK:
            self.blocks.append(["", 0])
            self.link = False

    def handle_data(self, data):
        if not self.raw:
            self.blocks[-1][0] += data
            self.blocks[-1][1] += len(data.split()) if self.link else 0


def _pages(spark, sf_dir):
    return [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").collect()]


def test_blocks_and_features_equal_brute_force(spark, sf_dir):
    for page in _pages(spark, sf_dir):
        plain = _Plain()
        plain.feed(page)
        plain.close()
        want = [(" ".join(t.split()), n) for t, n in plain.blocks if t.split()]
        blocks = html_text.blocks_of(page)
        assert [b.text for b in blocks] == [t for t, _ in want]
        own = [(len(t.split()), n / len(t.split())) for t, n in want]
        around = [(0, 0), *own, (0, 0)]
        rows = [(*around[i], *around[i - 1], *around[i + 1]) for i in range(1, len(around) - 1)]
        assert np.allclose(html_text.features(blocks)[:, :6], rows)


def test_tree_without_what_pages_say_of_themselves(spark, sf_dir):
    """Words and links of a block and its neighbours alone tell nearly all blocks; none of these is in the table."""
    tree, right, n = html_text.trained(), 0, 0
    for i, page in enumerate(_pages(spark, sf_dir)):
        if i % 50:
            blocks = html_text.blocks_of(page)
            x = html_text.features(blocks)
            x[:, html_text.FEATURES.index("part")] = 0
            right += (html_text.classify(tree, x) == [b.main and not b.side for b in blocks]).sum()
            n += len(blocks)
    assert right / n > 0.97


def test_long_runs_in_texts(spark):
    rows = [(1, "eyJ" * (LONG // 3)), (2, "a" + " " * LONG + "b\nc\nd"), (3, "token" * (LONG // 5)),
            (4, " " * LONG), (5, "\t" * LONG + "a\nc\nd")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    start = time.perf_counter()
    assert {r.spans for r in secrets.secrets(docs).collect()} == {""}
    assert {r.n_removed for r in line_dedup.dedup_lines(docs).collect()} == {0}
    assert time.perf_counter() - start < 60


def test_web_tokens_start_after_no_token_character(spark):
    web = "eyJ" + "a" * 8 + ".eyJ" + "b" * 8 + "." + "c" * 8
    texts = [web, f"x{web}", f"é{web} {web}", f".{web}", "eyJ" * 20 + web[3:], f"{web}.{web}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rule = re.compile(r"(?<![A-Za-z0-9_-])" + secrets.RULES[4].body)
    for r in secrets.secrets(docs).collect():
        assert r.spans == ",".join(f"jwt:{m.start()}:{m.end()}" for m in rule.finditer(texts[r.doc_id]))


def test_only_unseen_pairs_are_scanned(spark):
    make = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    pairs = lambda *given: secrets.unseen(*given).agg(F.sum(F.size("todo"))).first()[0]
    first, second = make(["a", "b", "a", None]), make(["a", "", "c", "c"])
    assert pairs(first, None, secrets.BASE_RULES) == 3 * 3
    _, ledger = secrets.scan_history(first, rules=secrets.BASE_RULES)
    assert pairs(first, ledger, secrets.BASE_RULES) is None
    assert pairs(first, ledger, secrets.RULES) == 3 * 3
    assert pairs(second, ledger, secrets.RULES) == 2 * 3 + 6
