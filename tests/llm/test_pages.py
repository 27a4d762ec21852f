"""Broken and hostile markup, and extraction against a tree made by the standard parser."""

from __future__ import annotations

import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from shardloom.llm import html

PAGES = "/root/testdata/sf0.001/pages.parquet"


def text(page):
    nodes = html.parse(page)
    return html.rendered(nodes, [not b for b in html._barred(nodes, frozenset(), tokens=False)])


@pytest.mark.parametrize("page,want", [
    ("<title>İ</title><p>kept</p>", "kept"),
    ("İ<script>var a = '<p>no</p>';</script><p>kept", "İ kept"),
    ("İ<STYLE>p {}</StYlE ><p>kept</p>", "İ kept"),
    ("<script>var a = '</scripty>no';</script>kept", "kept"),
    ('<p title="a > b">kept</p>', "kept"),
    ("<p title='a > b' class=x>kept</p>", "kept"),
    ('<a href="x>kept</a>', "kept"),
    ("<script src='a.js'/>var leak = 1;</script><p>kept", "kept"),
    ("<div/>one<p/>two", "one two"),
    ("<svg><path/><title>no</title></svg>kept", "kept"),
    ("a<!-->b<!-- no -->c<!--->d<!-- no", "abcd"),
    ("a</ no>b</>c<!no>d<?no?>e<a no", "abcde"),
    ("<ul><li>one<li>two<ul><li>three</ul><li>four</ul>", "one two three four"),
    ("1 < 2 & 3 &lt; 4 &#x1F600;", "1 < 2 & 3 < 4 \U0001F600"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("", ""), ("<", "<"), ("<p", ""), ("</", ""),
])
def test_markup(page, want):
    assert text(page) == want


@pytest.mark.parametrize("part", [
    "<b>", "<b></i>", "<div><p>", "<li>", "<td>", "<p><b>", "<a title='>' ", "</ ", "<!-- ", '<p x="', "<svg><a/>",
    "<script>", "</script", "<a" + " " * 50,
])
def test_time_follows_the_length(part):
    def seconds(n):
        began = time.process_time()
        html.parse(part * n + ">")
        return time.process_time() - began

    assert seconds(20_000) < 2
    assert seconds(80_000) < 0.5 + 12 * seconds(20_000)


def test_many_open_elements_and_long_pages(spark):
    words = "some words of an article. " * 60
    pages = [
        "<article><p>" + "<b>" * 20_000 + words + "</i>" * 20_000,
        "<html><body><article>" + f"<p>{words}</p>" * 2_000 + "</article></body></html>",  # 3 MB
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string")
    began = time.time()
    rows = {r.page_id: r for r in html.extract(df, html.train(df, url_col="page_id")).collect()}
    assert time.time() - began < 60
    assert rows[0].text == words.strip()
    assert rows[1].text == " ".join([words.strip()] * 2_000)


class Tree(HTMLParser):
    """Text below article or main, without what menus, forms, notices and comments hold."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.out = [], []

    def handle_starttag(self, tag, attrs):
        if tag in html.BLOCKS:
            self.out.append(" ")
        if tag in html.VOID:
            return
        tokens = {t for k, v in attrs if k in ("class", "id", "role") for t in re.findall("[a-z]+", (v or "").lower())}
        bad = tag in html.BAD_TAGS | html.HIDDEN or bool(tokens & html.BAD)
        self.stack.append((tag, bad))

    def handle_endtag(self, tag):
        if tag in html.BLOCKS:
            self.out.append(" ")
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        inside = any(t in ("article", "main") for t, _ in self.stack)
        if inside and not any(bad for _, bad in self.stack):
            self.out.append(data)


def by_tree(page):
    tree = Tree()
    tree.feed(page or "")
    tree.close()
    return re.sub(r"\s+", " ", "".join(tree.out)).strip()


def test_pages_equal_a_tree_of_the_standard_parser(spark):
    pages = spark.read.parquet(PAGES)
    model = html.train(pages)
    # The given pages, and the same with what the parser must not stumble over.
    spoiled = pages.withColumn("html", F.regexp_replace("html", "<p>", '<p title="a > bİ">')).withColumn(
        "html", F.regexp_replace("html", "<body([^>]*)>", "<body$1><script src='x'/>var İ = '<p>';</script>")
    )
    for table in (pages, spoiled):
        rows = html.extract(table, model).select("html", "text").collect()
        shaped = [r for r in rows if re.search(r"<(article|main)[\s>]", r.html or "")]
        assert len(shaped) > 10
        assert [r.text for r in shaped] == [by_tree(r.html) for r in shaped]
