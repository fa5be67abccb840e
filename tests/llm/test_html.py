"""Main text of the test pages (their article element) and of made-up pages."""

import html
import re

import pytest

from sparecast.llm.html_text import extract, main_text

LONG = "This paragraph has some length, a few commas, and no links at all, so it should earn points."


def test_articles_of_the_test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    html_of = {r.page_id: r.html for r in pages.collect()}
    got = extract(pages).collect()
    assert len(got) == len(html_of)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", html_of[r.page_id], re.DOTALL).group(1)
        plain = re.sub(r"<[^>]*>", lambda m: "" if m.group() in ("<b>", "</b>") else " ", article)
        assert r.text == " ".join(html.unescape(plain).split()) and r.n_chars == len(r.text)


@pytest.mark.parametrize("extra", [
    f"<nav><ul><li>{LONG}</ul></nav>", f"<header><p>{LONG}</p></header>", f"<footer>{LONG}</footer>", f"<aside><p>{LONG}</p></aside>",
    f"<div class='cookie-notice'><p>{LONG}</p></div>", f"<div id=ad_1>{LONG}</div>", f"<form><p>{LONG}</p></form>",
    f"<section class=comments><article class='comment'><p>{LONG} {LONG}</p></article></section>", f"<script>var x = '<p>{LONG}</p>'</script>",
    f"<style>p {{}} {LONG}</style>", f"<!-- <p>{LONG}</p> -->", f"<article class=comment><p>{LONG}</p></article>",
    f"<div class=sidebar-right><p>{LONG}</div>", f"<div style='display: none'><p>{LONG}</p></div>", f"<noscript><p>{LONG}</p></noscript>",
    "<ul>" + "".join(f"<li><a href=x>Another page, of this site, number {i}</a>" for i in range(9)) + "</ul>",
])
@pytest.mark.parametrize("box", ["<article>{}</article>", "<div class=content>{}</div>", "<main><div><section>{}</section></div></main>"])
def test_what_is_left_out(extra, box):
    body = box.format("<h1>Head</h1><p>First, " + LONG + "<p>Second &amp; last,\n <b>" + LONG + "</b>")
    want = f"Head First, {LONG} Second & last, {LONG}"
    for page in (extra + body, body + extra, box.format(extra + "<h1>Head</h1><p>First, " + LONG + "</p><p>Second &amp; last, " + LONG + "</p>")):
        if extra.startswith("<ul>") and page.startswith(box[:5]) and not page.startswith(body):
            continue  # a list of links inside the article itself belongs to it
        assert main_text(f"<html><body class=has-sidebar>{page}</body></html>") == want


def test_sections_stay_together():
    sections = "".join(f"<div class=part><p>Part {i}, {LONG}</p><p>More, {LONG}</p></div>" for i in range(4))
    want = " ".join(f"Part {i}, {LONG} More, {LONG}" for i in range(4))
    assert main_text(f"<body><div id=story>{sections}</div></body>") == want


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p>", ""), ("no markup & nothing else", "no markup & nothing else"), ("<p>One</p>two", "One two"), ("<!-- x", ""),
    ("<script>", ""), ("<p title='a>b'>ok, fine</p>", "ok, fine"), ("</div></p><p>x", "x"), ("a<br>b<b>c</b>", "a bc"), ("5 < 6 &lt; 7", "5 < 6 < 7"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("&#x41;&#66;&eacute;&nbsp;&bogus;", "ABé &bogus;"),
])
def test_odd_pages(page, want):
    assert main_text(page) == want


def test_large_and_broken_pages_end():
    for page in ("<" * 50000, '<a b="' * 5000, "<div>" * 5000 + "x", "<p>word, word " * 20000):
        assert isinstance(main_text(page), str)


def test_rows(spark):
    rows = [(1, "u", "<p>a</p>", 5), (1, "u", "<p>a</p>", 5), (None, None, None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = sorted(map(tuple, extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)], key=str)
    assert extract(pages.filter("false")).count() == 0


@pytest.mark.parametrize("attribute, kept", [
    ('style="overflow:hidden"', True), ('class="overflow-hidden"', True), ('aria-hidden="false"', True), ('data-x="hidden"', True),
    ('title="display:none"', True), ('hidden="until-found"', True), ("hidden=until-found", True), ('style="display:none;display:block"', True),
    ('data-hidden', True), ('style="visibility:hidden"', True), ("data-role='menu'", True),
    ("hidden", False), ("HIDDEN=''", False), ('hidden="hidden"', False), ("aria-hidden=TRUE", False), ("style='color:red; Display : NONE !important'", False),
])
def test_hidden_elements(attribute, kept):
    for tag in ("div", "article", "section"):
        got = main_text(f"<body><p>Other, {LONG}</p><p>Other, {LONG}</p><{tag} {attribute}><p>{LONG} {LONG}</p></{tag}></body>")
        assert (f"{LONG} {LONG}" in got) == kept
    want = "See the coast, now." if kept else "See the , now."
    assert main_text(f"<article><p>See the <a href='/hidden-coast' {attribute}>coast</a>, now.</p></article>") == want


def test_words_in_other_attributes():
    assert main_text("<article><p>See the <a href='/hidden-coast?id=ad'>coast</a>, now.</p></article>") == "See the coast, now."


@pytest.mark.parametrize("page, want", [
    ("<article><p hidden>Cookies<p>First paragraph</p><p>Second</p></article>", "First paragraph Second"),
    ("<article><p class=notice>Cookies<p>First paragraph</p><p>Second</p></article>", "First paragraph Second"),
    ("<article><p hidden>Cookies<ul><li>One<li>Two</ul><p>Second</article>", "One Two Second"),
    ("<article><ul><li hidden>No<li>One<li>Two</ul></article>", "One Two"),
    ("<article><ul><li class=ad>No<ul><li>no<li>no</ul><li>One<li>Two</ul></article>", "One Two"),
    ("<article><dl><dt hidden>No<dd>One<dt class=ad>No<dd>Two</dl></article>", "One Two"),
    ("<article><table><tr hidden><td>No<td>no<tr><td hidden>No<td>One<tr><td>Two</table></article>", "One Two"),
    ("<article><p>One <button>no<p>no</button> and <svg><path/><g><text>no</svg>two</p><nav><li>no<p>no</nav>three</article>", "One and two three"),
    ("<article><ul><li>One<nav><li>no</nav> two<li>three</ul></article>", "One two three"),
    ("<article><p>One <span hidden>no</p><p>Two</p></article>", "One Two"),
])
def test_omitted_end_tags_of_what_is_left_out(page, want):
    assert main_text(f"<body>{page}</body>") == want


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "entry has-comments", "with-sidebar", "post social-share-on", "sidebar", "related"])
def test_wrappers_with_unwanted_words(name):
    text = f"<h1>Head</h1><p>First, {LONG}</p><p>Second, {LONG}</p>"
    want = f"Head First, {LONG} Second, {LONG}"
    for inner in (text, f"<article>{text}</article>", f"<div>{text}</div>"):
        assert main_text(f"<body><div class='{name}'>{inner}<div class=comments><p>No, {LONG}</p></div></div><p>Foot</p></body>").startswith(want)
        assert "No, " not in main_text(f"<body><div class='{name}'>{inner}<div class=comments><p>No, {LONG}</p></div></div><p>Foot</p></body>")


@pytest.mark.parametrize("tag", ["h2", "section", "p"])
@pytest.mark.parametrize("name", ["search-methods", "related-work", "form", "promotion-of-health", "notice"])
def test_anchors_with_unwanted_words(tag, name):
    page = f"<body><article><h1>Head</h1><p>First, {LONG}</p><{tag} id={name}>A part, of the text</{tag}><p>Second, {LONG}</p></article></body>"
    assert main_text(page) == f"Head First, {LONG} A part, of the text Second, {LONG}"


def test_long_comments_are_left_out_and_named_pages_read():
    comments = "<div class=comment-list>" + f"<div class=comment-body><p>{LONG} {LONG}</p></div>" * 30 + "</div>"
    assert main_text(f"<body><div><p>First, {LONG}</p><p>Second, {LONG}</p></div>{comments}</body>") == f"First, {LONG} Second, {LONG}"
    assert main_text(f"<body><p>Short</p>{comments}</body>").count(LONG) == 60


ITEM = "An item of the list, of about 40 signs."


@pytest.mark.parametrize("inner", [
    "<h1>Head</h1><p>{0} {0}</p><ul>" + f"<li>{ITEM}</li>" * 20 + "</ul><p>A last paragraph of some sixty characters, and no more.</p>",
    "<h1>Head</h1><p>{0}</p><table>" + f"<tr><td>{ITEM}<td>{ITEM}" * 20 + "</table><p>Last</p>",
    "<h1>Head</h1><p>{0}</p><table>" + f"<tr><td><p>{ITEM}</p><td><p>{ITEM}</p>" * 20 + "</table><p>Last</p>",
    "<h1>Head</h1><blockquote><p>{0} {0}</p><p>{0} {0}</p></blockquote><p>{0}</p>",
    "<h1>Head</h1><section><h2>Large</h2>" + "<p>{0} {0}</p>" * 20 + "</section><h2>Small</h2><section><div><p>{0}</p></div></section>",
    "<section><h2>Large</h2>" + "<p>{0} {0}</p>" * 20 + "</section>bare text<section><p>Short one.</p></section><section><div><p>{0}</p></div></section>",
])
def test_nothing_of_an_article_without_the_element_is_lost(inner):
    inner = inner.format(LONG)
    menu = "<ul>" + "".join(f"<li><a href=x>Another page, of this site, number {i}</a>" for i in range(9)) + "</ul>"
    want = " ".join(re.sub("<[^>]*>", " ", inner).split())
    for box in ("<div>{}</div>", "<main>{}</main>", "<div><div>{}</div></div>"):
        assert main_text(f"<body>{menu}{box.format(inner)}{menu}</body>") == want


def test_a_column_of_a_page_laid_out_as_a_table():
    menu = "".join(f"<a href=x>Another page, of this site, number {i}</a><br>" for i in range(9))
    for text in (f"<p>First, {LONG}</p><p>Second, {LONG}</p>", f"First, {LONG} {LONG} {LONG}<br><br>Second, {LONG} {LONG}"):
        want = " ".join(re.sub("<[^>]*>", " ", text).split())
        assert main_text(f"<body><table><tr><td>{menu}<td>{text}</table></body>") == want
