from __future__ import annotations

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm import html_text

ARTICLE = "<h1>Ti&shy;tle</h1><p>One, two, three words that go on for a while, yes.</p><p>And <b>a</b>nother&nbsp;one, it is &lt;here&gt;.</p>"
TEXT = "Ti\xadtle One, two, three words that go on for a while, yes. And another one, it is <here>."


@pytest.mark.parametrize(
    "page",
    [
        f"<article>{ARTICLE}</article>",
        f"<html><body><nav><a href=/>Home, page</a></nav><main>{ARTICLE}</main><footer>x, y</footer>",
        f"<div class='page with-sidebar'><div class=content>{ARTICLE}</div><div class=sidebar><p>a, b, c, d, e, f</p></div></div>",
        f"<div id=top-menu><ul><li><a href=a>A</a></ul></div><div>{ARTICLE}</div><div class='post-comments'><p>I, for one, comment, and more than the article says, at length, here.</p></div>",
        f"<body><div class=cookie-notice><p>We use cookies, yes.</p></div><article>{ARTICLE}<form><p>Sign, up, here</p></form><aside>see, also</aside></article>",
        f"<article><script>var p='<p>no, no</p>';</script><style>p{{}}</style><!-- <p>no</p> -->{ARTICLE}<div class=ad>Buy, now</div></article>",
        f"<ARTICLE>{ARTICLE.replace('</p>', '')}",
        f"<div role=navigation>a, b</div><section>{ARTICLE}</section><div hidden>secret, text</div><div style='display:none'>x, y, z</div>",
        f"<article>{ARTICLE}</article><section id=comments><article class=comment><p>As a reader, I think, this is it, yes.</p></article></section>",
    ],
)
def test_article_alone(page):
    assert html_text.main_text(page) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words only", "plain words only"),
        ("<p>a<p>b<p>", "a b"),
        ("<div>a<br>b</div>", "a b"),
        ("<b>x</b>y", "xy"),
        ("<p>1 < 2 &amp; 3 &bogus; &#233;&#x41;</p>", "1 < 2 & 3 &bogus; éA"),
        ("<table><tr><td>cell a<td>cell b</table>", "cell a cell b"),
        ("<ul><li>one<li>two<ul><li>three</ul></ul>", "one two three"),
        ("<script>only", ""),
        ("<p>cut off <a href='x", "cut off <a href='x"),
        ("</div></p>text</nav>", "text"),
        ("<p>a\n\t b\u2003c</p>", "a b c"),
    ],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + "deep, text") == "deep, text"
    long = "word, " * 200_000
    assert html_text.main_text(f"<article><p>{long}</p></article>") == long.strip()
    paragraphs = "<p>Some words, and more.</p>" * 5000
    assert html_text.main_text(f"<article>{paragraphs}</article>").count("Some") == 5000


def plain_close(node, tag):
    """The element that an end tag leaves open, by walking up."""
    if tag in ("html", "body"):
        return node
    at = node
    while at.parent is not None and at.tag != tag:
        if at.tag in html_text.SCOPES and tag not in html_text.BLOCK:
            return node
        at = at.parent
    return node if at.parent is None else at.parent


def plain_open(node, tag):
    """The element that a new one is put into, by walking up."""
    at = node
    while at.parent is not None:
        if tag in html_text.ENDS.get(at.tag, ()):
            return at.parent if at.tag == "p" else plain_open(at.parent, tag)
        inner = at.tag in html_text.BLOCK and at.tag != "p" and at.tag not in html_text.ENDS
        if at.tag in html_text.SCOPES or inner:
            break
        at = at.parent
    return node


def plain_tree(tokens):
    root = node = html_text.Node("html", "", None)
    for kind, value in tokens:
        if kind == "text":
            node.parts.append(value)
        elif kind == "end":
            node = plain_close(node, value)
        else:
            node = plain_open(node, value)
            child = html_text.Node(value, "", node)
            node.parts.append(child)
            node = child if value not in html_text.VOID else node
    return root


def shape(node):
    parts = [p if isinstance(p, str) else shape(p) for p in node.parts]
    return node.tag, "|".join(map(str, parts))


tags = st.sampled_from("div p b i ul li table tr td th dl dt dd tbody span body head h1 br section".split())
token = st.one_of(
    st.tuples(st.just("open"), tags), st.tuples(st.just("end"), tags), st.just(("text", "x"))
)


@settings(max_examples=400, deadline=None)
@given(st.lists(token, max_size=40))
def test_trees_match_a_plain_walk(tokens):
    shown = {"open": "<{}>", "end": "</{}>", "text": "{}"}
    page = "".join(shown[kind].format(value) + "<!---->" for kind, value in tokens)
    assert shape(html_text.parse(page)) == shape(plain_tree(tokens))


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000,
        "<div>" * 100_000 + "</b>" * 130_000,
        "<div>" * 25_000 + "<p>Some words, and more.</p>" * 25_000,
        "<div><p>Some words, and more.</p>" * 20_000,
        "<a \"" * 250_000 + ">",
        "<a 'x' \"" * 120_000 + ">",
        "<b>" * 100_000 + "<div></div>" * 60_000,
        "<b><table>" + "<i>" * 150_000 + "</b>" * 100_000,
        "<a" * 500_000 + " \">",
        "<ul>" + "<li><b>" * 100_000,
    ],
    ids=range(10),
)
def test_time_grows_with_the_page(page):
    """A megabyte of what is hard to read takes seconds."""
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 10


def test_sections_and_siblings_stay_together():
    parts = "".join(f"<section><h2>H{i}</h2><p>Text {i}, with, commas, and some length to it.</p></section>" for i in range(6))
    got = html_text.main_text(f"<body><div class=wrap>{parts}</div><ul class=menu><li>x</ul></body>")
    assert all(f"H{i} Text {i}," in got for i in range(6)) and "x" not in got.split()


def test_every_row(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>"), (1, "u", f"<article>{ARTICLE}</article>"), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, text int")
    got = [tuple(r) for r in html_text.extract(pages).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str
    )
    assert html_text.extract(pages.filter("false")).collect() == []
