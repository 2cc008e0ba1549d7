import pytest
from pyspark.sql import functions as F

from cohortlake.llm import html

ARTICLE = "".join(f"<p>Sentence {k}, with some words, and more of them.</p>" for k in range(6))
TEXT = " ".join(f"Sentence {k}, with some words, and more of them." for k in range(6))


def page(before="", after="", article=f"<h1>Head</h1>{ARTICLE}"):
    return f"<!DOCTYPE html><html><head><title>Title</title></head><body>{before}<article>{article}</article>{after}</body></html>"


@pytest.mark.parametrize(
    "noise",
    [
        "<nav><ul><li><a href='/a'>Home, sweet home.</a></li></ul></nav>",
        "<header><h1>Site name, long enough.</h1></header>",
        "<footer>&copy; somebody, all rights reserved. And more.</footer>",
        "<aside>Sidebar text, with a sentence. And another one.</aside>",
        "<div class='ad'>Buy this, now. It is cheap, really.</div>",
        "<div id='cookie-notice'>We use cookies, sorry. Accept them.</div>",
        "<div class='sidebar-left'><p>Other things, elsewhere. Indeed.</p></div>",
        "<form><p>Your name, please.</p><input></form>",
        "<script>var a = '<p>not text, at all.</p>';</script>",
        "<style>p { margin: 0 } /* a, b. */</style>",
        "<!-- a comment, <p>with markup.</p> -->",
        "<section class='comments'><p>I liked it, a lot. Thank you.</p><p>Me too, friend.</p></section>",
        "<div style='display: none'><p>Hidden words, not shown.</p></div>",
        "<div><a href='/x'>One more link, here</a> <a href='/y'>and one there, too</a></div>",
        "<div class='sideBar'><p>Other things, elsewhere. Indeed.</p></div>",
        "<div id='cookiebar'><p>We use cookies, sorry. Accept them.</p></div>",
        "<ol class='comment-list'><li>First, says a reader. Really.</li><li>Second, says another one.</li></ol>",
        "<noscript><p>Enable scripts, please.</p></noscript>",
    ],
)
def test_noise_around_and_inside_the_article_is_left_out(noise):
    assert html.main_text(page(before=noise, after=noise)) == f"Head {TEXT}"
    if not noise.startswith("<header"):
        assert html.main_text(page(article=f"<h1>Head</h1>{ARTICLE}{noise}")) == f"Head {TEXT}"


def test_blocks_inline_elements_references_and_open_ends():
    body = "<h1>A &amp; B&nbsp;C</h1><p>x<b>y</b> z<br>w &lt;i&gt; &#233;&#x4e2d;<p>open <i>end<p>caf&eacute;\n\t last &amp&quot"
    assert html.main_text(page(article=body + ARTICLE)) == 'A & B C xy z w <i> é中 open end café last &" ' + TEXT


@pytest.mark.parametrize("odd", [None, "", "   ", "<html></html>", "<p", "<p></p>", "<!-- <p>x</p>", "<script>a"])
def test_pages_without_text(odd):
    assert html.main_text(odd) in ("", "<p")


def test_plain_text_long_pages_and_wrapping_forms():
    assert html.main_text("just some words, no markup.") == "just some words, no markup."
    assert html.main_text(f"<body><form action='/'>{ARTICLE}</form></body>") == TEXT
    long = "".join(f"<p>Line {k}, of a very long page.</p>" for k in range(20_000))
    assert html.main_text(page(article=long)).endswith("Line 19999, of a very long page.")
    deep = "<div>" * 3000 + "<p>Deep text, in there.</p>"
    assert html.main_text(deep) == "Deep text, in there."


def test_headers_of_the_article_belong_to_it():
    assert html.main_text(page(article=f"<header><h1>Head</h1></header>{ARTICLE}")) == f"Head {TEXT}"
    post = f"<div class='post'><div class='post-header'><h1>Head</h1></div>{ARTICLE}</div>"
    assert html.main_text(f"<body><div class='header'>Site, a fine one.</div>{post}</body>") == f"Head {TEXT}"


def test_layout_remarks_in_names_are_no_noise():
    assert html.main_text(f"<body><div class='page with-sidebar no-comments'>{ARTICLE}</div></body>") == TEXT


def test_table_of_odd_pages(spark):
    rows = [(1, "u", page()), (1, "u", page()), (None, None, page()), (2, "v", None), (3, "w", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("x")})
    found = sorted(html.extract(frame).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    assert [r.n_chars for r in found] == [len(f"Head {TEXT}")] * 2 + [0, 0] + [len(f"Head {TEXT}")]
    assert html.extract(frame.limit(0)).columns == ["page_id", "url", "text", "n_chars"]
    assert html.extract(frame.limit(0)).count() == 0


LONG = "A long sentence of the article, with many words, and with more of them than the others have. " * 6


@pytest.mark.parametrize(
    "article",
    [
        f"<header><h1>Head</h1></header><div class='body'><p>{LONG}</p><p>{LONG}</p></div>",
        f"<section><h2>One</h2><p>{LONG}</p><p>{LONG}</p></section><section><h2>Two</h2><p>Short end, as it is.</p></section>",
        f"<h1>Head</h1><p>An introduction, not long.</p><ul><li>{LONG}</li><li>{LONG}</li></ul>",
        f"<h1>Head</h1><p>An introduction, not long.</p><blockquote><p>{LONG}</p></blockquote>",
        f"<h1>Head</h1><p>An introduction, not long.</p><pre>{LONG}</pre>",
        f"<h1>Head</h1><p>An introduction, not long.</p><table><tr><td>{LONG}</td></tr></table>",
    ],
)
@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_nothing_beside_the_largest_part_is_lost(article, holder):
    import re

    expected = " ".join(re.sub("<[^>]*>", " ", article).split())
    if holder == "div" and article.startswith("<header"):
        expected = expected.removeprefix("Head ")  # a page's header
    assert html.main_text(f"<html><body><{holder}>{article}</{holder}></body></html>") == expected


def test_boxes_below_the_threshold_are_left_out():
    body = f"<div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div>Hi</div><div>Go</div><div>Up</div><div>Ok</div><div>By</div>"
    text = " ".join([LONG.strip()] * 4)
    assert "By" not in html.main_text(f"<body>{body}<p>The end, of a page, it is.</p></body>").replace(text, "")


def test_linked_headings_paragraphs_and_references_are_text():
    article = (
        f"<h1><a href='/a'>Head</a></h1>{ARTICLE}<h2>Part <a href='#part'>permanent link</a></h2>"
        "<p><a href='/b'>One linked phrase</a></p><ol>"
        + "".join(f"<li><a href='/{k}'>Author, A. Title number {k} of the journal. 2001.</a></li>" for k in range(5))
        + "</ol>"
    )
    references = " ".join(f"Author, A. Title number {k} of the journal. 2001." for k in range(5))
    assert html.main_text(page(article=article)) == f"Head {TEXT} Part permanent link One linked phrase {references}"


@pytest.mark.parametrize("tag", ["li", "p", "td"])
def test_runs_of_short_links_are_menus(tag):
    menu = "".join(f"<{tag}><a href='/{k}'>Place {k}</a></{tag}>" for k in range(5))
    menu = {"li": f"<ul>{menu}</ul>", "p": menu, "td": f"<table><tr>{menu}</tr></table>"}[tag]
    assert html.main_text(page(article=f"<h1>Head</h1>{menu}{ARTICLE}")) == f"Head {TEXT}"


PROSE = "".join(f"<p>{'This is a sentence of the article, with some words in it. ' * 4}</p>" for _ in range(3))
SAID = " ".join(["This is a sentence of the article, with some words in it. " * 3 + "This is a sentence of the article, with some words in it."] * 3)


@pytest.mark.parametrize(
    "page",
    [
        f'<body><div class="sidebar-right">{PROSE}</div></body>',
        f'<div class="l-sidebar-wrap"><div class="sidebar"><a href=x>menu</a></div><article>{PROSE}</article></div>',
        f'<article class="post category-social tag-search">{PROSE}</article>',
        f'<main class="with-widget-area ad-supported">{PROSE}<div class="share"><a href=x>share this</a></div></main>',
        f'<form id=aspnet><div class="banner-page">{PROSE}</div></form>',
    ],
)
def test_names_do_not_remove_the_article(page):
    assert html.main_text(page) == SAID


def test_names_still_remove_parts_of_a_page_and_what_readers_wrote():
    assert html.main_text(f'<div>{PROSE}</div><div class="sidebar"><p>An aside. It says a little, not much.</p></div>') == SAID
    assert html.main_text(f'<div>{PROSE}</div><section class="comments">{PROSE * 9}</section>') == SAID
    assert html.main_text(f'<article>{PROSE}</article><div id="respond"><article class="comment">{PROSE * 9}</article></div>') == SAID


@pytest.mark.parametrize(
    "page",
    [
        "<a " + '"x" ' * 250_000,
        '<a "x" "x" ' * 90_000,
        "<a b " * 200_000,
        "<a '" * 100_001 + ">",
        "<div>x " * 20_000,
        "<div>" * 20_000 + "</x>" * 20_000 + "text",
        "<!--" * 200_000,
        "<![CDATA[" * 100_000,
    ],
)
def test_bad_markup_takes_linear_time(page):
    import time

    began = time.process_time()
    html.main_text(page)
    assert time.process_time() - began < 5


def test_open_ends():
    assert html.main_text(f"{PROSE}<!-- open <p>gone</p>") == SAID
    assert html.main_text(f"{PROSE} tail < 3 <!-- open") == SAID + " tail < 3"
    assert html.main_text(f'{PROSE}<p class="a>lost</p>') == SAID + " lost"
