"""Main texts of pages of several make-ups."""

from __future__ import annotations

import random
import time

import pytest

from leadmill.llm import html_text
from leadmill.llm.html_text import Tokens, extract, main_text

LONG = "Words of a paragraph that is long enough to count as running text, with a second clause at its end."
MORE = "Another paragraph of the same kind, again with more than eighty-six characters of plain running text."


def test_article_element_bounds_the_text():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
    <header><h1>Site</h1><p>{LONG}</p></header><nav><ul><li><a href="/a">One</a></li></ul></nav>
    <!-- <p>gone</p> --><div class="ad">{MORE}</div>
    <article><h1>Title &amp; more</h1><p>{LONG}<p>Short.<br>Line</p>
    <script>var t = "</p><p>no</p>";</script><aside>{MORE}</aside>
    <ul><li>One</li><li>Two <b>b</b>old</li></ul><form><input>{MORE}</form></article>
    <section id="comments"><article class="comment"><p>{MORE}</p></article></section>
    <footer>&copy; {MORE}</footer></body></html>"""
    assert main_text(page).split("\n\n") == [
        "Title & more",
        LONG,
        "Short. Line",
        "One",
        "Two bold",
    ]


def test_surge_and_dive_without_an_article_element():
    page = f"""<body class="has-sidebar"><div id="top"><a href="/">Home</a> <a href="/x">News</a></div>
    <div><p><a href="a">{LONG}</a></p></div>
    <div class="text"><h2>Title</h2><p>{LONG}</p><p>Yes.</p><div class="newsletter"><p>{MORE}</p></div>
    <p>{MORE}</p></div><div class="related-links"><p>{LONG}</p></div><p><a href="#">up</a></p></body>"""
    assert main_text(page).split("\n\n") == ["Title", LONG, "Yes.", MORE]


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<p>short</p>", ""),
        ("<nav>" + LONG + "</nav>", ""),
        (LONG, LONG),
        ("<article>a&lt;b&gt;&nbsp;c &#233;&eacute;&#x1F600;</article>", "a<b> c éé😀"),
        ("<article><p>a\n\t b</p></article>", "a b"),
        ("<article><p>one<p>two<div>three", "one\n\ntwo\n\nthree"),
        ("<article>x < y and a <b>b</article>", "x < y and a b"),
        ("<article><p hidden>a</p><p style='display: none'>b</p><p>c</p></article>", "c"),
        ("<article><p class='ad'>buy<p>c</article>", "c"),
        ("<article><p>a</p></div></span><p>b</p></article>", "a\n\nb"),
        ("<main><header><h1>H</h1></header><p>x</p></main>", "H\n\nx"),
        ("<article><p>a</p><script>unclosed <p>b", "a"),
        ("<article><p title='>'>a</p><!-- <b> --></article>", "a"),
        ("<ARTICLE><P>A</P></ARTICLE>", "A"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"),
        ("<article><pre>a\n  b</pre><hr>c</article>", "a b\n\nc"),
    ],
)
def test_pieces(page, text):
    assert main_text(page) == text


def test_surges_choose_among_articles():
    card = "<article class='card'><p>Read on.</p></article>"
    assert main_text(f"{card}<article><p>Oh.</p><p>{LONG}</p></article>{card}") == f"Oh.\n\n{LONG}"
    assert main_text(f"<main>{card}<p>{LONG}</p></main>") == f"Read on.\n\n{LONG}"
    assert main_text(f"<article><p>{LONG}</p></article><article><p>{MORE}</p></article>") == (
        f"{LONG}\n\n{MORE}"
    )
    # Without any surge no article is preferred, and short lines at an end stay.
    assert main_text(card + card) == "Read on.\n\nRead on."
    ends = "".join(f"<p>{n}.</p><div class=ad>{MORE}</div>" for n in range(5))
    assert main_text(f"<article><p>{LONG}</p>{ends}</article>").endswith("\n\n3.\n\n4.")


def _plain_surges(sizes, width, bar):
    """Every line walked by itself, as the method is told."""
    found, inside = set(), False
    for n, size in enumerate(sizes):
        ahead = sum(sizes[n : n + width])
        if inside and not ahead:
            inside = False
        elif not inside and size and ahead > bar:
            inside = True
        if inside and size:
            found.add(n)
    return found


@pytest.mark.parametrize("width, bar", [(1, 0), (3, 86), (3, 20), (5, 150)])
def test_surges_equal_a_plain_walk(width, bar):
    rng = random.Random(width)
    for _ in range(300):
        sizes = [rng.choice([0, 0, 0, 5, 30, 60, 120]) for _ in range(rng.randint(0, 40))]
        assert html_text._surges(sizes, width, bar) == _plain_surges(sizes, width, bar)


def test_long_pages_and_deep_nesting():
    page = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    assert main_text(page) == "\n\n".join([LONG] * 5000)
    assert main_text("<article>" + "<div>" * 3000 + "x") == "x"
    assert main_text("<" * 20_000) == "<" * 20_000


def test_rows(spark):
    rows = [(1, "u", "<article>é</article>", "x", 1), (1, "u", "<article>é</article>", "x", 1)]
    rows += [(None, None, None, None, None), (3, "", "", "", 0)]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, text STRING, id INT")
    found = sorted(tuple(r) for r in extract(pages).collect() if r.page_id)
    assert found == [(1, "u", "é", 1), (1, "u", "é", 1), (3, "", "", 0)]
    assert extract(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert extract(pages).where("page_id IS NULL").first().text == ""
    assert extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='layout has-sidebar'><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='no-sidebar with-nav'><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='layout sidebar-right'><main><p>{LONG}</p></main></div>", LONG),
        (f"<article class='post comments-open'><p>{LONG}</p></article>", LONG),
        (f"<article class='post social'><p>{LONG}</p></article><p>{'x ' * 9}</p>", LONG),
        (f"<main><h1>T</h1><article class='social'><p>{LONG}</p></article></main>", f"T\n\n{LONG}"),
        (f"<form id='f'><article><p>{LONG}</p><form>Mail</form></article></form>", LONG),
        (f"<body><form><div><p>{LONG}</p><p>{MORE}</p></div></form></body>", f"{LONG}\n\n{MORE}"),
        (
            f"<article><section id='related-work'><p>{LONG}</p></section><section id='search'>"
            "<p>s</p></section><section id='notice-period'><p>n</p></section></article>",
            f"{LONG}\n\ns\n\nn",
        ),
        # Still something else:
        (f"<article><p>{MORE}</p><div class='sidebar'><article>{LONG}</article></div></article>", MORE),
        (f"<main><p>x</p><div id='comments'><article>{MORE}</article></div></main>", "x"),
        (f"<article><p>{LONG}</p><section id='comments'><p>{MORE}</p></section></article>", LONG),
        (f"<article>x</article><aside><article>{MORE}</article></aside>", "x"),
        (f"<div hidden><article>{MORE}</article></div>", ""),
    ],
)
def test_words_around_the_article(page, text):
    assert main_text(page) == text


LINE = "A short closing line."
LINKED = "<p>See <a href='/x'>all that we have said before</a>.</p>"


@pytest.mark.parametrize(
    "page, blocks",
    [
        (f"<ul><li><a href='/'>Home</a></ul><div><p>{LINE}</p></div>", [LINE]),
        (f"<body><h1>T</h1><p>{LINE}</p><footer>{LONG}</footer></body>", ["T", LINE]),
        (f"<div><p>One two.</p><p>Three.</p><p>Four.</p><p>Five.</p><p>{LONG}</p></div>",
         ["One two.", "Three.", "Four.", "Five.", LONG]),
        (f"<p>One two.</p><p>Three.</p><p>Four.</p><p>Five.</p><p>{LONG}</p>",
         ["One two.", "Three.", "Four.", "Five.", LONG]),
        (f"<div><p>{LONG}</p><div class='ad'><p>a</p><p>b</p><p>c</p><p>d</p></div><p>{LINE}</p></div>",
         [LONG, LINE]),
        (f"<p>{LONG}</p><div class='newsletter'><p>a</p><p>b</p><p>c</p></div><p>{LINE}</p>",
         [LONG, LINE]),
        (f"<div><p>{LONG}</p>{LINKED}<p>{LINE}</p></div>",
         [LONG, "See all that we have said before.", LINE]),
        (f"<div><p>{LONG}</p></div><div><a href='/'>Home</a> <a href='/b'>News</a></div>", [LONG]),
        (f"<div><div><p>{LINE}</p></div><div><p>{LONG}</p></div></div>", [LINE, LONG]),
    ],
)
def test_nothing_of_the_container_is_lost(page, blocks):
    assert main_text(page).split("\n\n") == blocks


@pytest.mark.parametrize("broken", ["<a ", "<a b='", '<a b="', "<!", "<![CDATA[", "<![CDATA[>", "<!--", "</a ", "<"])
def test_a_megabyte_of_broken_markup_is_read_once(broken):
    page = f"<article><p>{LONG}</p></article>" + broken * (1_000_000 // len(broken))
    start = time.monotonic()
    assert LONG in main_text(page)
    assert time.monotonic() - start < 10


def _ends(page, at):
    """Where a tag ends, sign by sign."""
    quote = ""
    for n in range(at, len(page)):
        if quote:
            quote = "" if page[n] == quote else quote
        elif page[n] in "\"'":
            quote = page[n]
        elif page[n] == ">":
            return n
    return -1


def test_tags_end_where_a_plain_scan_says():
    rng = random.Random(5)
    for _ in range(500):
        page = "".join(rng.choice("<a>\"' =/") for _ in range(rng.randrange(40)))
        tokens = Tokens(page)
        assert [tokens._end(n) for n in range(len(page))] == [_ends(page, n) for n in range(len(page))]


def test_inline_names_and_formulas_stay_in_their_paragraph():
    page = f"<article><p>One <span class='search'>word</span> more</p><p>{LONG}</p></article>"
    assert main_text(page) == f"One word more\n\n{LONG}"
    page = f"<article><p>where <math><mi>x</mi><annotation>\\x</annotation></math> is.</p><p>{LONG}</p></article>"
    assert main_text(page) == f"where x is.\n\n{LONG}"
