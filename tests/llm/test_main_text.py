"""Main text of pages against texts read out of the known frame, and by hand."""

import html
import re
import time

import pytest

from tallymill.llm.main_text import extract, host_paths, main_texts, vote
from tallymill.llm.queries import op11_html_extraction

SCHEMA = "page_id bigint, url string, html string"


def article(page: str) -> str:
    """The article of the synthetic pages: headings and paragraphs, with character references decoded."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = (html.unescape(re.sub(r"<[^>]*>", " ", part)) for part in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(filter(None, (" ".join(block.split()) for block in blocks)))


def test_whole_table(spark, sf_dir):
    pages = {row["page_id"]: row for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = op11_html_extraction(spark, sf_dir).collect()
    assert len(found) == len(pages)
    for row in found:
        assert row["text"] == article(pages[row["page_id"]]["html"])
        assert row["n_chars"] == len(row["text"]) and row["url"] == pages[row["page_id"]]["url"]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two<br>three", "one\ntwo three"),
        ("<title>t</title><p>a&nbsp; b\n c</p><script>x('</p>')</script>", "a b c"),
        ("<article><header><h1>H</h1></header><p>x <b>y<p>z</article><footer>f</footer>", "H\nx y\nz"),
        ('<div class="cookie-notice">We use cookies</div><div class="text"><h2>A</h2><p>b</div>', "A\nb"),
        ('<div class="text"><p>Long enough.</div><div id="comments"><p>First comment!</p></div>', "Long enough."),
        ("<article><p>a</p><form><p>Sign up</p></form><aside>more</aside></article>", "a"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<p>x<!-- gone <p>y</p>", "x"),
        ("<p>a < b</p> & c", "a < b\n& c"),
        ('<a title="x > y">in</a>', "in"),
        ("<style>unclosed", ""),
    ],
)
def test_pages_by_hand(page, text):
    assert extract(page, []) == text


def test_short_page_is_read_like_its_host(spark):
    frame = '<div class="box-{0}"><p>{1}</p></div><div class="story s{0}"><h3>T</h3>{2}</div>'
    long = [(i, "https://a.example/x", frame.format(i, "Offer", "<p>words of a story, many of them</p>" * 9)) for i in range(9)]
    short = [(9, "http://u@A.example:80/y", frame.format(9, "Much longer than the story below it, and in a box", "<p>tiny</p>"))]
    other = [(10, "https://b.example/", frame.format(9, "Much longer than the story below it, and in a box", "<p>tiny</p>")), (11, None, "<p>x"), (None, "", None)]
    pages = spark.createDataFrame(long + short + other, SCHEMA)
    texts = {row["page_id"]: row["text"] for row in main_texts(pages).collect()}
    assert texts[9] == "T\ntiny"
    assert texts[10] != texts[9]
    assert texts[11] == "x" and texts[None] == ""
    voted = {row["host"]: row["paths"] for row in host_paths(pages).collect()}
    assert voted["a.example"].split()[0] == "div.story"


def test_cold_hosts_are_joined_alike(spark, sf_dir, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    expected = sorted(map(tuple, main_texts(pages).collect()))
    monkeypatch.setattr("tallymill.llm.main_text.HOT_SHARE", 0.1)
    assert sorted(map(tuple, main_texts(pages).collect())) == expected


def test_clashing_columns_copies_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://h/", "<p>a", 5, 6), (1, "http://h/", "<p>a", 5, 6)], SCHEMA + ", host int, paths int")
    assert [tuple(row) for row in main_texts(pages).collect()] == [(1, "http://h/", "a", 1)] * 2
    assert main_texts(pages.limit(0)).collect() == []


@pytest.mark.parametrize("part", ["<div>", "<p>a", "<b>", '<a "', "<b '>x", "<!", "<!--", "&", "<span><div>", "</p>", "<a"])
def test_odd_long_pages_take_little_time(part):
    start = time.perf_counter()
    page = part * 50_000
    vote(page)
    extract(page, ["html/body"])
    assert time.perf_counter() - start < 20
