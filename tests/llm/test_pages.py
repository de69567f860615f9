"""Page texts: depth, names that only look like boilerplate, teasers, and a plain extraction of the small table."""

from __future__ import annotations

import os
from html.parser import HTMLParser

import pytest

from voxlake.llm import html

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("depth", [210, 5000])
def test_deep_pages(depth):
    page = "<body>" + "<div>" * depth + "<nav>menu menu</nav><p>text</p>" + "</div>" * depth + "</body>"
    assert html.extract(page) == "text"
    assert html.induce([page.replace("text", f"text {i}") + "<p>Same</p>" for i in range(4)])


def test_names_of_content_are_kept():
    page = "<body><article><p class='feature-search'>a</p><section id='comment-on-policy'>b</section><div class='notice-board'>c</div><div class='ad-slot'>x</div><div id='siteFooter2'>y</div><div class='reader-comments'>z</div></article></body>"
    assert html.extract(page) == "a b c"


def test_teasers_are_no_text():
    page = "<body><article><h1>Title</h1><p>Body <a href=x>with a link</a> in it</p></article><article><a href=y>Another story</a> 2 min</article></body>"
    assert html.extract(page) == "Title Body with a link in it"
    assert html.extract("<article><a>All</a></article><article><a>links</a></article>") == "All links"


def test_the_wrapper_decides():
    """Pages without an article, and with constants inside one: without a wrapper the text is worse."""
    outside = [f"<body><div id=c><p>body {i}</p></div><div><p>Share this story</p></div></body>" for i in range(5)]
    inside = [f"<body><article><p>Share this story with friends</p><p>body {i}</p><p>Copyright X</p></article></body>" for i in range(5)]
    for pages in (outside, inside):
        wrapper = frozenset(html.induce(pages))
        assert [html.extract(p, wrapper) for p in pages] == [f"body {i}" for i in range(5)]
        assert all("Share" in html.extract(p) for p in pages)


class Plain(HTMLParser):
    """Text of the article by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside = self.skipped = 0
        self.blocks = [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag not in html.VOID:
            self.skipped += tag in ("script", "style", "nav", "aside", "footer", "form") or dict(attrs).get("class") == "ad"
        if tag not in html.INLINE:
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.skipped -= bool(self.skipped) and tag in ("script", "style", "nav", "aside", "footer", "form")
        if tag not in html.INLINE:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.skipped:
            self.blocks[-1] += data


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_pages_equal_a_plain_extraction(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in html.main_text(pages).collect()}
    wrong = 0
    for r in pages.collect():
        text = ""
        source = r.html or ""
        if "<article" in source:
            plain = Plain()
            plain.feed(source[source.index("<article") : source.rindex("</article>") + 10])
            plain.close()
            text = " ".join(filter(None, (" ".join(b.split()) for b in plain.blocks)))
        assert got[r.page_id][1] == len(got[r.page_id][0])
        wrong += got[r.page_id][0] != text
    assert wrong == 0
