import html
import re

import pytest

from tessera.llm.html_extract import extract, main_blocks
from tests.conftest import SF0001

P1 = "The first paragraph of the article is long enough, has commas, and says something about its subject."
P2 = "A second paragraph follows, with a <a href='/x'>link</a> inside, and it goes on for a while, too."
T2 = "A second paragraph follows, with a link inside, and it goes on for a while, too."
MENU = "".join(f'<li><a href="/{i}">Menu entry number {i}, long, longer</a></li>' for i in range(9))


def test_given_pages_against_their_article(spark):
    """In these pages the article element holds headings, paragraphs, b and br only."""
    from tessera.llm.queries_more import op11_html_extraction
    got = {r.page_id: r for r in op11_html_extraction(spark, SF0001).collect()}
    pages = spark.read.parquet(f"{SF0001}/pages.parquet").collect()
    assert len(got) == len(pages) == 50
    for r in pages:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<b>", "").replace("</b>", "")
        want = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1|br)>", inner)]
        assert got[r.page_id].text == "\n".join(x for x in want if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


@pytest.mark.parametrize("around", [
    f"<nav><ul>{MENU}</ul></nav>", f"<ul class='x'>{MENU}</ul>", f"<div id=main-menu><p>{P1}</p></div>",
    f"<header><p>{P1}</p></header>", f"<footer><p>{P1}</p></footer>", f"<aside><p>{P1}</p></aside>",
    f"<div class='sidebar-left'><p>{P1}</p></div>", f"<div class='cookieNotice' role=alert><p>{P1}</p></div>",
    f"<div class='ad'><p>{P1}</p></div>", f"<div class='sponsored-box'><p>{P1}</p></div>",
    f"<form action=/q><p>{P1}</p><input><button>{P1}</button></form>", f"<script>var t='</p><p>{P1}</p>';</script>",
    "<style>p{margin:0}</style>", f"<section id='comments'><article><p>{P1}</p></article></section>",
    f"<div class='content comment'><p>{P1}</p></div>", f"<ol class='comment-list'><li><div class='comment-body'>{P1}</div></li></ol>",
    f"<noscript><p>{P1}</p></noscript>", f"<!-- <p>{P1}</p> -->", f"<div style='display: none'><p>{P1}</p></div>",
    f"<div hidden><p>{P1}</p></div>", f"<template><p>{P1}</p></template>", "<svg/><svg><text>drawn</text></svg>",
    f"<div class='newsletter-signup'><p>{P1}</p></div>", f"<div class='related-posts'><ul>{MENU}</ul></div>",
])
@pytest.mark.parametrize("shell", [
    "<article><h1>Title</h1>{b}<p>{p1}</p>{b}<p>{p2}</p>{b}</article>{b}",
    "{b}<main>{b}<div><h1>Title</h1><p>{p1}</p>{b}<p>{p2}</p></div></main>",
    "<div id=page>{b}<div class='post-content'><h1>Title</h1><p>{p1}<p>{p2}</div>{b}</div>",
    "<div><h1>Title</h1>{b}<div><p>{p1}</p><p>{p2}</p></div>{b}</div>",
    "<div><div><h1>Title</h1><p>{p1}</p></div>{b}<div><p>{p2}</p></div></div>",
])
def test_what_stands_around_the_article_goes(around, shell):
    page = "<html><head><title>Title | Site</title><body>" + shell.format(b=around, p1=P1, p2=P2)
    assert main_blocks(page) == ["Title", P1, T2]


def test_wrappers_that_only_sound_like_noise_stay():
    for wrapper in ("<form>{}</form>", "<div class='main with-sidebar'>{}</div>", "<div class='widget'><article>{}</article></div>",
                    "<body class='has-cookie-banner'>{}", "<div class='content sidebar-right'>{}</div>"):
        assert main_blocks(wrapper.format(f"<h1>Title</h1><p>{P1}</p><p>{P2}</p>")) == ["Title", P1, T2]
    assert main_blocks(f"<article><header><h1>Title</h1><p>By somebody</p></header><p>{P1}</p></article>") == ["Title", P1]


def test_markup_as_browsers_read_it():
    same = {
        "<p>a<p>b": ["a", "b"], "<ul><li>one<li>two</ul>": ["one", "two"], "a<b>b</b>c": ["abc"], "one<br>two": ["one two"],
        "<p>a &amp; b&nbsp;&#99;&#x64; &lt;p&gt; &am</p>": ["a & b cd <p> &am"], "<p> a\n\t b </p> c": ["a b", "c"],
        "a < b <3 c": ["a < b <3 c"], "<p>x</i></b></p>y": ["x", "y"], "<table><tr><td>1<td>2<tr><td>3</table>": ["1", "2", "3"],
        "<p title='a > b'>x": ["x"], "<P CLASS=q>x</P>": ["x"], "x<p class=\"y>z": ["x", "z"], "x<p class='": ["x"], "x<!-- y": ["x"],
        "x<script>y": ["x"], "<p>&#xD800;&#0;z": ["��z"], "<pre>a\n  b</pre>": ["a b"], "<p>a<span class=ad>b</span>c": ["ac"],
        "": [], "  \n ": [], "<nav>x</nav>": [], "<head><title>t</title><p>x": ["x"], "<dl><dt>a<dd>b</dl>": ["a", "b"],
        "<![CDATA[x]]>y": ["y"], "<a href=1>x</a>": ["x"], "<p>1, 2</p><p>1, 2</p>": ["1, 2", "1, 2"],
    }
    for page, want in same.items():
        assert main_blocks(page) == want, page


def test_long_deep_and_odd_pages():
    deep = "<div>" * 20_000 + f"<p>{P1}</p>" + "</div>" * 20_000
    assert main_blocks(deep) == [P1]
    many = "<article>" + "".join(f"<p>Paragraph {i}, of a very long page, is here.</p>" for i in range(30_000)) + "</article>"
    assert len(main_blocks(many)) == 30_000
    assert len(main_blocks("<b><i>" * 30_000 + "x" + "</p>" * 30_000)) == 1
    assert main_blocks("<" * 50_000 + " x") == ["<" * 50_000 + " x"]
    assert main_blocks("<p a='" * 20_000) == []


def test_nulls_repeats_extra_columns_and_no_rows(spark):
    rows = [(1, "u", f"<p>{P1}</p>", "x"), (1, "u", f"<p>{P1}</p>", "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", "plain  text", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(((r.page_id or -1, r.url or "", r.text, r.n_chars) for r in extract(df).collect()))
    assert got == [(-1, "v", "", 0), (1, "u", P1, len(P1)), (1, "u", P1, len(P1)), (2, "", "", 0), (3, "w", "plain text", 10)]
    assert extract(df.where("false")).collect() == []
