"""HTML extraction: pages of many makes, linear work, and pass two against a brute-force labeller."""

import time

import pytest

from linestream.llm import catalog
from linestream.llm import html_extract as H

A = "<p>This is the first paragraph of the article, and it is long enough that it has many of the stop words that are in the language.</p>" * 2
TEXT = "This is the first paragraph of the article, and it is long enough that it has many of the stop words that are in the language."
POLISH = "<p>Ala ma kota, a kot ma Alę; rzecz w tym, że nikt nie wie, dlaczego tak się stało i kiedy to się skończy.</p>" * 3
CHINESE = "<p>今天的天气很好我们去公园散步然后回家吃饭大家都很高兴因为明天是假日</p>" * 3
NAV = "<ul>" + "".join(f"<li><a href=x>Link number {i} to a page</a></li>" for i in range(9)) + "</ul>"
READER = "<p>I am a reader and this is what I have to say about the article that was in the paper of the day.</p>"


@pytest.mark.parametrize("page, text", [
    (f"<div class='content no-sidebar'>{A}</div>", f"{TEXT} {TEXT}"),
    (f"<div id='search-results-page' class='page-with-footer'>{A}</div>", f"{TEXT} {TEXT}"),
    (f"<div class='sidebar'>{A}</div>", f"{TEXT} {TEXT}"),  # all there is
    (f"<div class='sidebar'>{A * 3}</div><main>{A}</main>", f"{TEXT} {TEXT}"),
    (f"<div>{A}</div><div class='comment-list'>{READER * 20}</div>", f"{TEXT} {TEXT}"),
    (f"<div>{A}</div><div id='siteFooter'>{READER}</div>", f"{TEXT} {TEXT}"),
    (f"<div>{A}</div><section class='social-share-buttons'>{READER}</section>", f"{TEXT} {TEXT}"),
    (f"<article>{A}<p class='advert'>Buy this now and you will have it for the rest of all your days.</p></article>", f"{TEXT} {TEXT}"),
    (f"<article>{A}<h3>Comments</h3>{READER}{READER}</article>", f"{TEXT} {TEXT}"),
    (f"<article>{A}<h3>12 Comments</h3>{READER}<h2>More of the story</h2>{A}</article>", f"{TEXT} {TEXT} More of the story {TEXT} {TEXT}"),
    (f"<div>{A}<div><h4>Kommentare (3)</h4>{READER}</div>{A}</div>", " ".join([TEXT] * 4)),
    (f"<div>{A}<p style='display:none'>This is hidden and it is long enough that it has many of the stop words.</p></div>", f"{TEXT} {TEXT}"),
])
def test_pages(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize("paragraphs", [POLISH, CHINESE])
def test_a_page_in_an_unknown_language_is_not_lost(paragraphs):
    want = " ".join(paragraphs.replace("</p>", "").split("<p>")[1:])
    assert H.main_text(f"<html><body>{NAV}<div>{paragraphs}</div><footer>© 2024</footer></body></html>") == want


@pytest.mark.parametrize("name, hint", [
    ("sidebar", "sidebar"), ("no-sidebar", None), ("site-footer", "footer"), ("page-with-footer", None), ("commentList", "comment"),
    ("search-results-page", None), ("search-box", "search"), ("ad-slot-3", "ad"), ("adventure", None), ("header-less-story", None),
    ("main-nav", "nav"), ("share_buttons", "share"), ("", None), ("42", None), ("without-ads", None)])
def test_names(name, hint):
    assert H._hint(name) == hint


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "</section>" * 20_000, ("<div>" * 10 + "</p></ul>") * 4000, "<h2>Comments</h2>" * 20_000,
                                  "<div class='" + "a-" * 100_000 + "'>x</div>", "<p>" * 60_000, "<a " * 60_000, "<" * 200_000,
                                  "<div><section>" * 15_000 + "</div>" * 15_000])
def test_hostile_pages_take_linear_time(page):
    began = time.process_time()
    H.main_text(page)
    assert time.process_time() - began < 2.0


def brute_labels(blocks):
    """Both passes by their definition: every undecided block looks at every other."""
    H._decide(blocks)
    decided = [b.label for b in blocks]
    out = []
    for i, b in enumerate(blocks):
        if decided[i] is not None:
            out.append(decided[i])
            continue
        own = [j for j, c in enumerate(blocks) if c.container == b.container]
        near = [(abs(own.index(j) - own.index(i)), not decided[j]) for j in own if decided[j] is not None]
        if near:
            out.append(not min(near)[1])
        elif b.main:
            out.append(True)
        else:
            near = [(abs(j - i), not decided[j]) for j in range(len(blocks)) if decided[j] is not None]
            out.append(not min(near)[1] if near else True)
    return out


def test_query_equals_the_brute_force_labeller(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in catalog.QUERIES["op5_html_extraction"](spark, sf).collect()}
    assert got.keys() == pages.keys()
    for page_id, html in pages.items():
        blocks = H.blocks_of(html or "")
        labels = brute_labels(blocks)
        assert got[page_id] == " ".join(b.text for b, good in zip(blocks, labels, strict=True) if good)
    assert min(map(len, got.values())) > 0
