"""HTML extraction: pages put together from known articles, and odd pages."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from daybook.llm.html_text import extract, main_text
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"

GOOD = "It was the best of times and the worst of times for all of the people in the city of light."
MORE = "That is to say, the people of the city were not at all sure of what it was that they had seen."


def test_semantic_page():
    page = f"""<html><head><title>no</title><style>p{{x}}</style><script>var a="</p><p>no</p>";</script></head>
    <body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><!-- no <p>no</p> -->
    <div class="ad">{GOOD}</div><article><header><h1>The &amp; title</h1></header>
    <p>{GOOD}<br>next&nbsp;line <b>bo</b>ld<p>Short.<div class="share-buttons"><a href=x>share</a></div>
    <ul><li>An item</li><li>Two</ul><form>Mail <input> <button>Go</button></form><p>{MORE}</p>
    <section id="comments"><article class="comment"><p>{GOOD} comment</p></article></section></article>
    <aside>{MORE}</aside><div class='cookie-notice'>{GOOD}</div><footer>&copy; {MORE}</footer></body></html>"""
    assert main_text(page) == f"The & title {GOOD} next line bold Short. An item Two {MORE}"


def test_page_without_article_tags():
    links = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(9))
    page = f"""<body><div id="nav"><ul>{links}</ul></div><ul>{links}</ul><div class="content"><h2>Title here</h2>
    <p>{GOOD}</p><p>Ja.</p><p>{MORE}</p></div><ul>{links}</ul><div class="footer">{GOOD}</div></body>"""
    assert main_text(page) == f"Title here {GOOD} Ja. {MORE}"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain &lt;b&gt; text", "plain <b> text"), ("<p>a < b</p>", "a < b"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>cut <b", "cut <b"), ("<article><p>one<p>two", "one two"),
    ("<script>never closed <p>x</p>", ""), ("</p></div><p>x</p>", "x"), ("<nav><p>only menu</p></nav>", ""),
    ('<article><p title="a > b">x</p>', "x"), ("<article>" + "<div>" * 2000 + "deep", "deep"),
])
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_long_page():
    assert main_text(f"<article><p>{'word ' * 400_000}</p></article>") == ("word " * 400_000).strip()
    assert main_text("<" * 100_000).startswith("<")


@pytest.mark.parametrize("piece", [
    "<a ", "</p>", "</div>", '<a "', "<!--", "<!x", "<p title='", '<a x="y', "<script", "<title>", "<b <i>", "<", "<div>",
])
def test_broken_markup_takes_linear_time(piece):
    began = time.process_time()
    main_text(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 5


def test_many_unmatched_ends_in_deep_pages():
    began = time.process_time()
    assert main_text("<article>" + "<div>" * 100_000 + "deep" + "</p>" * 100_000 + " end") == "deep end"
    assert time.process_time() - began < 5


PROSE = f"<p>{GOOD}</p><p>{MORE}</p><p>{GOOD} And so on.</p>"


@pytest.mark.parametrize("begin, end", [
    ('<div class="content-sidebar-wrap">', "</div>"), ('<div id="content" class="no-sidebar">', "</div>"),
    ('<section id="related-work">', "</section>"), ('<div class="notice-board-post">', "</div>"),
    ('<form action="/" method="post">', "</form>"), ('<div role="form">', "</div>"),
    ("<title-bar></title-bar><style-box>", "</style-box>"), ('<form><div class="has-sidebar">', "</div></form>"),
])
def test_a_container_of_the_whole_text_is_text(begin, end):
    page = f"<body><nav><a href=/>Home</a></nav>{begin}{PROSE}{end}<footer>{GOOD} {MORE} {GOOD} {MORE}</footer></body>"
    assert main_text(page) == f"{GOOD} {MORE} {GOOD} And so on."


@pytest.mark.parametrize("begin, end", [
    ('<div class="sidebar">', "</div>"), ('<form class="search">', "</form>"), ('<div id="comments">', "</div>"),
    ("<aside>", "</aside>"), ('<div class="cookie-notice">', "</div>"), ('<div style="display: none">', "</div>"),
])
def test_other_containers_are_not(begin, end):
    page = f"<body><div class=content>{PROSE}</div>{begin}<p>{MORE}</p><p>{GOOD}</p>{end}</body>"
    assert main_text(page) == f"{GOOD} {MORE} {GOOD} And so on."


def test_comments_are_never_text():
    page = f"<body><p>{GOOD}</p><div class=comments>{PROSE * 9}</div></body>"
    assert main_text(page) == GOOD


def test_languages_without_known_stop_words():
    text = "Пример текста на русском языке, который достаточно длинный. Он состоит из нескольких предложений! Да, это так."
    menu = "<ul>" + "<li><a href=x>Меню</a></li>" * 5 + "</ul>"
    assert len(text) < 120 and main_text(f"{menu}<div><p>{text * 2}</p><p>Да.</p></div>{menu}") == f"{text * 2} Да."


@pytest.mark.parametrize("page, text", [
    ("<article><p title='<b>'>x</p>", "x"), ("<article><p a=b <b>x</b>", "x"), ("<article><p>x<br/>y", "x y"),
    ("<article><p title=\"it's\">x</p>", "x"), ("<article><p title=it's>x</p><p>y</p>", "x y"),
    ("<article><title-bar>x</title-bar><p>y", "x y"), ("<article><script/>no</script><p>y", "y"),
    ("<article><STYLE>no</Style ><p>y", "y"), ("<article><!doctype x><?php y><p>z", "z"),
])
def test_tags(page, text):
    assert main_text(page) == text


def reference(page):
    """The contents of the one article of a generated page, by plain substitution."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    inner = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inner))
    return " ".join(html.unescape(inner).split())


def test_query_against_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = QUERIES["op1_html_extraction"](spark, SF_DIR).collect()
    assert len(found) == len(pages)
    for row in found:
        assert (row.url, row.text) == (pages[row.page_id].url, reference(pages[row.page_id].html))
        assert row.n_chars == len(row.text)


def test_rows_of_all_kinds(spark):
    rows = [(1, "u", f"<p>{GOOD}</p>"), (1, "u", f"<p>{GOOD}</p>"), (None, None, None), (2, "v", "")]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows],
                                  "page_id long, url string, html string, text string, n_chars int")
    found = [tuple(r) for r in extract(frame).collect()]
    expected = [(i, u, main_text(h), len(main_text(h))) for i, u, h in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert extract(frame.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("attributes", [
    'title="Hidden gems of Rome"', 'data-hidden="false"', 'aria-label="Hidden gems"', 'data-role="menu"',
    'data-src="/x?id=widget"', "data-x='a class=nav b'", "data-id=widget lang=en",
])
def test_attributes_of_other_names_are_no_chrome(attributes):
    assert main_text(f"<article {attributes}><p>{GOOD}</p></article>") == GOOD
    assert main_text(f"<section {attributes}><p>{GOOD}</p></section>") == GOOD


@pytest.mark.parametrize("attributes", ["hidden", 'lang="en" HIDDEN', "aria-hidden='true'", 'a="b"class="nav"', "id=sidebar"])
def test_attributes_that_make_chrome(attributes):
    assert main_text(f"<section {attributes}><p>{GOOD}</p></section><p>{MORE}</p>") == MORE


def test_text_outside_a_small_article():
    links = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(9))
    card = "<article><h3>Teaser</h3><p>See also.</p></article>"
    page = f"<ul>{links}</ul><div id=content><p>{GOOD}</p><p>{MORE}</p></div><ul>{links}</ul>{card}"
    found = main_text(page)
    assert f"{GOOD} {MORE}" in found and "Link" not in found
    large = f"<article><p>{GOOD}</p><p>{MORE}</p></article><div><p>{GOOD}</p></div>"
    assert main_text(large) == f"{GOOD} {MORE}"
