"""The page scanner on broken, hostile and doubtful markup."""

from __future__ import annotations

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import pages
from tallyhouse.llm.pages import extract

BODY = "<p>" + "The article goes on with many plain words of its own. " * 6 + "</p>"


def article(inside: str) -> str:
    return f"<html><body><nav><a href=x>Menu</a></nav><article><h1>Title</h1>{BODY}{inside}</article></body></html>"


@pytest.mark.parametrize(
    "part",
    [
        '<a "', "<p title='", '<a ="', "<div>", "</nav>", "<", "<!--", "<!", "</", "<script>", "<svg>", "<a b=c ", "&", "<p>x",
        "<div class=a>x", "<span hidden>", "<a b='>", "<title>", "a=", "<li><ul>", "<p " + "a" * 50, "<![CDATA[", "<svg><script/>",
    ],
)
def test_a_megabyte_of_unclosed_markup_is_read_in_seconds(part):
    page = part * (1_000_000 // len(part))
    start = time.process_time()
    extract(page, None)
    extract(f"<p {page.replace('<', '').replace('>', '')}>text</p>", None)
    assert time.process_time() - start < 8


def test_time_grows_with_the_page():
    def seconds(part: str, n: int) -> float:
        start = time.process_time()
        extract(part * n, None)
        return time.process_time() - start

    for part in ('<a "', "<p title='", "<div>", '<b x="'):
        assert seconds(part, 200_000) < 12 * max(seconds(part, 40_000), 0.02)


@pytest.mark.parametrize(
    "markup, text",
    [
        ("<p>it is <y and it's fine</p><p>MIDDLE</p><p>that's all</p>", ["it is", "MIDDLE", "that's all"]),
        ('<p>a<img alt="5" tall">b</p>', ["ab"]),
        ('<p><a title="Bob"s page" href="x">link</a> text</p>', ["link text"]),
        ("<p>1 < 2 and 3 > 2 & more</p>", ["1 < 2 and 3 > 2 & more"]),
        ("<p title='a > b'>kept</p>", ["kept"]),
        ("<p>x<!-- > -- > -->y</p>", ["xy"]),
        ("<p>x<!-->y</p>", ["xy"]),
        ("<p>x<script>if (a < b) '</p>'</script >y</p>", ["xy"]),
        ("<p>open <b>bold</p><p>next", ["open bold", "next"]),
        ("<p>cut off</p><a href='x", ["cut off"]),
        ("<p>a<span style='display:none'>hidden <span>more</span> still</span>b</p>", ["ab"]),
        ("<p>a<span hidden>hidden</p><p>b</p>", ["a", "b"]),
        ("<p>&lt;b&gt; &amp;amp; &#x41;</p>", ["<b> &amp; A"]),
    ],
)
def test_text_is_kept_and_markup_is_not(markup, text):
    found = extract(article(markup), None).split("\n")
    assert found[2:] == text


@pytest.mark.parametrize(
    "opening, closing",
    [
        ('<div class="side-by-side">', "</div>"), ('<section class="related-work">', "</section>"),
        ('<div class="ad-hoc">', "</div>"), ('<div class="alert-design">', "</div>"),
        ('<figure class="image-share">', "</figure>"), ('<div id="notice-period">', "</div>"),
        ('<div class="header-files">', "</div>"), ('<p class="skip-intro">', "</p>"),
    ],
)
def test_class_names_that_say_another_thing_keep_their_text(opening, closing):
    assert "KEPT" in extract(article(f"{opening}<span>KEPT</span>{closing}"), None)


@pytest.mark.parametrize(
    "furniture",
    [
        '<div class="share-buttons">GONE</div>', '<aside>GONE</aside>', '<div class="related-posts"><p>GONE</p></div>',
        '<div class="cookie-consent">GONE</div>', '<div class="sidebar">GONE</div>', '<p class="notice">GONE</p>',
        '<div id="comments"><div class="comment">GONE</div></div>', '<form><p>GONE</p></form>', '<div class="siteFooter">GONE</div>',
        '<div class="responses"><article><p>GONE</p></article></div>', '<ul class="breadcrumb-list"><li>GONE</li></ul>',
    ],
)
def test_furniture_goes(furniture):
    page = f"<html><body><main><article><h1>Title</h1>{BODY}</article>{furniture}</main></body></html>"
    assert extract(page, None).startswith("Title\nThe article")
    assert "GONE" not in extract(page, None)


def test_containers_beyond_the_deepest_lose_no_text():
    deep = "<div>" * 3000 + "<p>inside</p>" + "</div>" * 3000 + "<p>behind</p>"
    assert extract(article(deep), None).split("\n")[2:] == ["inside", "behind"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "/", "p", "a ", "=", '"', "'", "!--", "-->", "x", "<p>", "</p>", "<div>", "<script>", "</script>", "<svg/>", "&lt;", " "]), max_size=40))
def test_any_markup_is_read_to_its_end(parts):
    page = "".join(parts)
    tokens, at = pages._tokens(page), 0
    for token in tokens:
        assert at <= token.start < token.end <= len(page)
        at = token.end
    assert isinstance(extract(page, None), str)


def test_pages_of_any_kind(spark):
    schema = "page_id long, url string, html string, doc string, path string, text int"
    long = article("<p>more</p>" * 100_000)
    rows = [(1, "http://a.b/c", long, "x", "y", 1), (2, None, None, None, None, None), (3, "", "", "x", "y", 1), (3, "", "", "x", "y", 1),
            (None, "http://a.b/d", article("<p>two</p>"), "x", "y", 1), (4, "not a url", "plain text", "x", "y", 1)]
    got = pages.main_text(spark.createDataFrame(rows, schema)).collect()
    texts = {(r["doc"]["page_id"], r["doc"]["url"]): r["text"] for r in got}
    assert len(got) == len(rows) and texts[2, None] == texts[3, ""] == ""
    assert texts[1, "http://a.b/c"].endswith("more\nmore") and texts[1, "http://a.b/c"].count("\n") == 100_001
    assert texts[None, "http://a.b/d"].endswith("\ntwo") and texts[4, "not a url"] == "plain text"
    assert pages.main_text(spark.createDataFrame([], schema)).collect() == []


def test_no_markup_is_left(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        assert not re.search(r"</?(p|div|a|article|script)\b", extract(row["html"], None))
