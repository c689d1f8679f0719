"""WARC archives and main text of pages."""

import gzip
import hashlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tabmill.llm import html_text as h
from tabmill.llm import warc as w
from tests.conftest import SF_SMALL


def read_back(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in w.read_archives(w.archive(df)).select(
        w.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        w.page_of(F.col("refers_to")).alias("refers_to")).collect()), key=repr)


def test_round_trip_and_revisits(spark):
    big, other = "é" * 500, "x" * 999
    rows = [(1, "http://a/ b\n", big), (2, None, big), (3, "u", big), (4, "u", other), (5, "u", other), (6, "u", None), (7, "u", ""),
            (None, "u", big), (3, "u", big), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    want = []
    for i, _, t in rows:
        body = (t or "").encode()
        revisit = t == big and i != 3
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert read_back(df) == sorted(want, key=repr)


def test_normalised_members_and_index(spark, monkeypatch):
    monkeypatch.setattr(w, "FILE_BYTES", 20_000)  # several files a task
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    manifest = w.archive(df)
    files = manifest.collect()
    assert len(files) > 1 and sum(f.records for f in files) == df.count()
    for f in files:
        data = open(w.opened(f.path)[1], "rb").read()
        lines = [line.split("\t") for line in open(w.opened(f["index"])[1]).read().splitlines()]
        assert sum(int(x[1]) for x in lines) == len(data)
        for offset, length, rid, _ in lines:
            one = gzip.decompress(data[int(offset):int(offset) + int(length)])
            assert one.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {rid}\r\n".encode() in one
    html = {r.page_id: r.html for r in df.collect()}
    got = w.read_archives(manifest).select(w.page_of(F.col("record_id")).alias("i"), "payload").collect()
    assert {r.i: bytes(r.payload).decode() for r in got} == html


def test_reader_of_streams_with_many_members():
    records = [w.record("warcinfo", f"<urn:x:{i}>", [], b"a" * i) for i in range(5)]
    data = b"".join(gzip.compress(r) for r in records[:3]) + gzip.compress(b"".join(records[3:]))
    got = [d for _, d in w.split_records(w.inflated(io.BytesIO(data)))]
    assert got == records
    with pytest.raises(ValueError):
        list(w.split_records(iter([records[2][:-6]])))


def test_empty_pages(spark):
    assert read_back(spark.createDataFrame([], "page_id long, url string, html string")) == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><article>";</script></head><body><header><h1>Site</h1></header>
<div id="cookie-notice">We use cookies on this site and many more words here to look like a paragraph of text</div>
<nav><ul><li><a href="/x>y">Home</a></li></ul></nav><!-- <p>hidden</p> -->
<main><article><header><h1>Real  title</h1></header><p>First <b>para</b> with <a href=y>link</a> &eacute;&nbsp;x &lt;b&gt; 1 < 2.
<div class="ad">Buy now</div><form><label>Mail</label><input></form><p>Second<br>para<style>p{}</style></p><p hidden>no</p>
<section class="comments"><article><p>Nice article, I liked it very much indeed, thanks</p></article></section></article></main>
<aside>Side text here</aside><footer>Foot &copy;</footer>"""


def test_main_text_of_a_page():
    tree = h.grow_tree(h.LABELLED)
    assert h.extract(PAGE, tree) == "Real title\nFirst para with link é x <b> 1 < 2.\nSecond para"


def test_page_without_article():
    tree = h.grow_tree(h.LABELLED)
    body = " ".join(["word"] * 60)
    page = f"<body><div><a href=x>Home</a> <a href=y>About</a></div><p>{body}</p><p>Short one.</p><p>{body}</p><div class=sidebar>{body}</div>"
    assert h.extract(page, tree) == f"{body}\nShort one.\n{body}"


@pytest.mark.parametrize("head, tail", [
    ('<body class="single right-sidebar">', ""), ('<html class="no-js cookies-not-set"><body class="cookies-not-set has-comments">', ""),
    ('<body><div id="page" class="has-sidebar with-comments no-ads has-header">', "</div>"), ('<body><div class="sidebar">', "</div>"),
    ('<body class="widget"><form id="aspnetForm"><div class="right-sidebar">', "</div></form>")])
def test_classes_of_holders_do_not_empty_a_page(head, tail):
    tree = h.grow_tree(h.LABELLED)
    inner = '<h1>Title</h1><p>One two three.</p><div class="share-buttons">Share</div><div class="comment-list"><article><p>Nice one</p></article></div>'
    page = f'{head}<nav>Home</nav><article class="post has-comments">{inner}</article><aside><article>Other</article></aside>{tail}<footer>Foot</footer>'
    assert h.extract(page, tree) == "Title\nOne two three."
    assert h.extract(page.replace("<article class", "<main class").replace("three.</p>", "three.</p><article>", 1), tree) == "Title\nOne two three."


def test_wrapper_classes_of_a_page_without_article():
    body = " ".join(["word"] * 60)
    page = f'<body class="has-sidebar"><div class="page-with-sidebar no-comments"><p>{body}</p><p>{body}</p></div><div class="site-footer">{body}</div>'
    assert h.extract(page, h.grow_tree(h.LABELLED)) == f"{body}\n{body}"


def test_unclosed_blocks_end_where_the_next_begins():
    page = "<article><p>One two three.<p class=ad>Buy it<p>Four five.<ul><li class=ad>x y<li>Six seven</ul><p class='notice'>n<h2>Head</h2></article>"
    assert h.extract(page, h.grow_tree(h.LABELLED)) == "One two three.\nFour five.\nSix seven\nHead"


TREE = h.grow_tree(h.LABELLED)


@pytest.mark.parametrize("name", [
    "article-comments", "user-comments", "fb-comments", "reader-comments", "entry-comments", "related-articles", "related-stories", "js-ad", "google-ad",
    "dfp-ad", "ad-300x250", "cookie-policy", "cookie-law-info", "newsletter-cta", "breaking-banner", "promo-teaser", "blog-sidebar", "notice-info",
    "adSlot", "commentsSection", "post__comments", "discussion", "site-search", "share-buttons"])
def test_names_of_furniture_in_an_article(name):
    inner = f'<p>One two three.</p><div class="{name}"><p>Not of the article, in many words that look like it.</p></div><p>Four five.</p>'
    assert h.extract(f"<body><article>{inner}</article></body>", TREE) == "One two three.\nFour five."
    assert h.extract(f"<body><article>{inner.replace('class', 'id')}</article></body>", TREE) == "One two three.\nFour five."


@pytest.mark.parametrize("name", ["has-sidebar", "no-ads", "with-comments", "cookies-not-set", "ad-free", "market-share", "job-search-tips", "restaurant-menu",
                                  "entry-content", "lively-discussion-of-results", "adventure", "commentary", "shared-history"])
def test_names_that_are_no_furniture(name):
    page = f'<body><article><p>One two three.</p><div class="{name}"><p>Part of the article.</p></div></article></body>'
    assert h.extract(page, TREE) == "One two three.\nPart of the article."


def test_links_formulas_buttons_and_hidden_words_of_an_article():
    cases = {
        "<p>See this.</p><p><a href=x>Read the full paper here</a></p>": "See this.\nRead the full paper here",
        "<p>Sources</p><ul><li><a href=x>First source</a></li><li><a href=y>Second source</a></li></ul>": "Sources\nFirst source\nSecond source",
        "<table><tr><td>Name</td><td><a href=x>Link</a></td></tr></table>": "Name\nLink",
        "<p>Let <math><mi>x</mi><annotation encoding=t>\\x</annotation></math> be five</p>": "Let x be five",
        "<p>Press <button>Start</button> to begin.</p><p><button>Subscribe now</button></p>": "Press Start to begin.",
        "<p>One <span hidden>secret</span> two <b style='display: none'>gone</b> three</p>": "One two three",
        "<p>One <span hidden>secret</p><p>two</p>": "One\ntwo",
        "<section id=responses><p>What they said.</p></section><section id=related><p>Kin.</p></section>": "What they said.\nKin.",
    }
    for inner, want in cases.items():
        assert h.extract(f"<body><nav><a href=z>Home</a></nav><article>{inner}</article><footer>Foot</footer></body>", TREE) == want


def test_pages_that_hold_nothing_else():
    assert h.extract("<body><nav><a href=x>Home</a></nav><p>Mix it well.</p><ul><li>2 eggs<li>flour<li>milk</ul><p>Bake.</p></body>", TREE) == (
        "Mix it well.\n2 eggs\nflour\nmilk\nBake.")
    words = " ".join(["word"] * 40)
    assert h.extract(f'<body><nav><a href=x>Home</a></nav><div class="discussion"><p>{words}</p></div></body>', TREE) == words
    assert h.extract(f'<body><div class="comments"><p>{words}</p></div></body>', TREE) == ""
    assert h.extract("<body><nav><a href=x>Home</a></nav><div><a href=y>About us</a></div></body>", TREE) == ""


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>x", "<a href='", "</p></div>", "<head><title>x", "&#xZZ; &amp"])
def test_broken_pages_do_not_fail(page):
    assert isinstance(h.extract(page, h.grow_tree(h.LABELLED)), str)


def test_tree_learns_its_table():
    tree = h.grow_tree(h.LABELLED)
    wrong = sum(h.decide(tree, r[:-1]) != r[-1] for r in h.LABELLED)
    assert wrong <= 0.03 * len(h.LABELLED)


def test_pages_table_against_its_markup(spark):
    import html

    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").withColumn("text", F.lit(1))
    got = {r.page_id: (r.text, r.n_chars) for r in h.main_text(rows).collect()}
    for r in rows.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in parts if x)
        assert got[r.page_id] == (want, len(want))
    assert h.main_text(rows.limit(0)).count() == 0
