"""Main text of web pages: odd markup, layouts with and without an article element, odd rows."""

from __future__ import annotations

import html
import os
import re

import pytest

from __spark_entry__ import SMALLEST
from tidemark.llm import html_main_text
from tidemark.llm.html_main_text import main_text
from tidemark.llm.queries import QUERIES

LONG = "A long paragraph, with commas, that says enough, to be an article's own, and ends here."


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), (" \n ", ""), ("<p></p>", ""), ("plain &amp; simple", "plain & simple"),
    ("<article><p>One<p>Two<br>lines</article>", "One Two lines"),
    ("<article><h1>Head</h1><p><b>Bold<br><p>next &lt;b&gt; &eacute;</p></article>",
     "Head Bold next <b> é"),
    ("<article>a<b>b</b>c <i>d</i></article>", "abc d"),
    ("<nav>menu</nav><article>Text.</article><footer>end</footer>", "Text."),
    ("<article><p>x</p><script>var a='</p>'; if (a<b) {}</script><p>y</p></article>", "x y"),
    ("<article><!-- no > yes --><p>x</p><style>p{}</style><!-- open", "x"),
    ("<article><p title='a>b'>x</p><p>y</p", "x y"),
    ("<ARTICLE><P CLASS=lead>x</P><DIV CLASS='ad'>buy</DIV>y</ARTICLE>", "x y"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer><aside>a</aside></article>",
     "T x"),
    ("<header><h1>Site</h1></header><main><p>x</p></main>", "x"),
    ("<article><p>x</p><div class='post-comments'><p>first!</p></div></article>", "x"),
    ("<article><p>x</p><section id=comments><article class=comment><p>" + LONG
     + "</p></article></section></article>", "x"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>",
     "one two a b c"),
    ("<body class='has-sidebar'><article><p>x</article>", "x"),
    ("<article><p>a  b\t\nc</p> <p> 3 < 4 && 5 > 2 </p></article>", "a b c 3 < 4 && 5 > 2"),
    ("<article><p>x</p><p hidden>h</p><p style='display: none'>n</p><p>z</p></article>", "x z"),
    ("<head><title>T</title><body><p>x", "x"),
    ("<article><p>x</p></div></span></article>", "x"),
    ("<article><a href='?id=ads&class=nav'>link</a> text</article>", "link text"),
    ("<article><p>x</p><form><p>name</p><input value=v><button>go</button></form></article>", "x"),
    ("<article><p>x</p><div role=complementary>r</div><div class='cookieNotice'>c</div></article>",
     "x"),
])
def test_markup(source, text):
    assert main_text(source) == text


def test_best_container_without_an_article_element():
    page = (f"<body><div id=top><ul><li><a href=/a>Home</a><li><a href=/b>News</a><li>"
            f"<a href=/c>Sport</a></ul></div><div><div class=c><h2>Head</h2><p>{LONG}</p><p>Short."
            f"</p><p>{LONG}</p></div></div><div><p><a href=/1>Other story, with, commas, many</a>"
            f"</p><p><a href=/2>Another story, longer, with more, of them</a></p></div></body>")
    assert main_text(page) == f"Head {LONG} Short. {LONG}"


def test_siblings_of_the_container_are_kept():
    page = (f"<body><h1>Head</h1><p>{LONG}</p><div><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}"
            f"</p></div><p><a href=/x>Only, a, link, to, elsewhere, of some length, and more</a></p>"
            f"<div><a href=/>x</a></div></body>")
    assert main_text(page) == f"Head {LONG} {LONG} {LONG} {LONG}"


def test_menu_in_the_body_itself():
    page = (f"<body><ul><li><a>Home</a><li><a>News</a><li><a>Sport</a></ul><p>{LONG}</p><p>{LONG}"
            "</p></body>")
    assert main_text(page) == f"{LONG} {LONG}"


def test_long_and_deep_pages_end():
    assert len(main_text("<article><p>" + "word " * 600_000)) == 5 * 600_000 - 1
    assert main_text("<div>" * 20_000 + "x") == "x"
    assert main_text("<a " * 50_000) == ""
    assert main_text("<" * 50_000) == "<" * 50_000


SCHEMA = "page_id long, url string, html string, text string, n_chars int, row int"


def test_rows(spark):
    pages = [(1, "u", "<article>x</article>", "clash", 9, 7), (1, "u", "<article>x</article>", "", 9, 7),
             (None, None, None, None, None, None), (2, "v", "", "", 0, 1)]
    df = spark.createDataFrame(pages, SCHEMA)
    found = html_main_text.extract(df)
    assert found.columns == ["page_id", "url", "html", "row", "text", "n_chars"]
    assert sorted(tuple(r)[-2:] for r in found.collect()) == [("", 0), ("", 0), ("x", 1), ("x", 1)]
    assert html_main_text.extract(df.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="needs the given tables")
def test_page_query(spark):
    """The given pages hold one article element each, with nothing but headline and paragraphs."""
    expected = {}
    for r in spark.read.parquet(f"{SMALLEST}/pages.parquet").collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0]
        inner = re.sub("<[^>]*>", "", re.sub("</?(p|h1)>|<br>", " ", inner))
        expected[r["page_id"]] = (r["url"], " ".join(html.unescape(inner).split()))
    found = QUERIES["op13_html_main_text"](spark, SMALLEST)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in rows} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
