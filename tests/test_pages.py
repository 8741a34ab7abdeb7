"""Hand-written pages of every layout, and result pages."""

import time

import pytest

from pressmill.config import JobConfig
from pressmill.functions.html_nodes import Page, Step
from pressmill.operators.layouts import LAYOUTS
from pressmill.operators.links import extract_links
from pressmill.plans.crawling import pages_to_articles, pages_to_links

PAGES = {
    "http://www.apnewsarchive.com/2014/a": """
        <h1 class="ap_headTitle">x<b><span>AP title </span></b></h1>
        <strong class="ap_dt_stmp"><span> Jun. 3, 2014 </span></strong>
        <div>out<div><p><span id="dateLine">PARIS (AP)</span> &mdash; One &amp; <i>two</i>.
        <p>Three<br>four.</div>after</div>""",
    "http://www.bbc.co.uk/news/1": """
        <h1 class="story-header"> BBC title </h1><span class="date"> 3 June 2014 </span>
        <p class="caption">Please turn on JavaScript. Media</p>
        <div class="story-body"><noscript><p>Hidden</p></noscript><p>One <strong>two</strong> three
        <a href="/x">link</a></p><div><p>Four</p></div></div><span class="cross-head">Head</span>""",
    "http://www.bbc.co.uk/news/2": """
        <div class="story-inner"><h1> Inner title</h1><p>One <b>lost</b> two</p><p>Three</p></div>
        <p class="date2"><strong>13 May 2014</strong></p><h2 class="heading">Head</h2>""",
    "http://www.bbc.co.uk/news/3": """
        <h1 class="story">Single</h1><span class="date">3 June 2014</span>
        <div class="story-body">Only "one" <em>text</em></div>""",
    "http://news.bbc.co.uk/2/hi/4.stm": """
        <div class="mxb"><h1>Old title</h1></div>
        <div class="ds">17:09 GMT, Tuesday, 3 June 2014 18:09 UK</div>
        <table><tr><td class="storybody"><p><b>Lead.</b></p><p>Body "x".</p></table>""",
    "http://www.reuters.com/article/5": """
        <div class="column1 gridPanel grid8"><h1>Reuters title</h1></div>
        <span class="timestamp">Tue Jun 3, 2014 4:05pm EDT</span><span class="timestamp">no</span>
        <span id="articleText"><p>PARIS (Reuters) - War talks.</p><p>End.</p></span>""",
    "http://www.reuters.com/article/6": """
        <div class="column1 gridPanel grid8"><h1>Off topic</h1></div>
        <span class="timestamp">Tue Jun 3, 2014 4:05pm EDT</span>
        <span id="articleText">PARIS (Reuters) - Sport.</span>""",
    "http://www.upi.com/news/7": """
        <div id="c_story"><h1>UPI title</h1></div>
        <div class="meta grey"><b>By</b> A B <i>x</i> | Updated June 3, 2014 at 3:45 PM <a>y</a> z</div>
        <div class="st_text_c"><p>PARIS, June 3 (UPI) -- One "two".</p><p>Three</p></div>""",
    "http://www.upi.com/news/8": """
        <div id="c_story"><h1>No marker</h1></div><div class="meta grey">Sept. 3, 2014 at 3:45 PM</div>
        <div class="st_text_c">Text.</div>""",
    "http://www.voanews.com/content/9": """
        <div id="article"><h1> VOA title </h1></div>
        <p class="article_date"> Last updated on: June 3, 2014 15:45 PM</p>
        <div class="zoomMe"><p>One <b>two</b></p><ul><li>Three<li>Four</ul></div>""",
    "http://news.xinhuanet.com/english/10": """
        <html><head><title>Page_ Xinhua</title></head><body><div><a href="/">Home: a - b, and the rest of it</a></div>
        <div id="Title">XNA <b>lost</b>title</div><span>2014-06-03 01:02:03</span>
        <div id="c"><p>BEIJING, June 3 -- Talks "began", they say. </p><p>More of it -- ended.</p></div>
        <td><a href="/1">Some other long linked headline, one of many</a></td></body></html>""",
    "http://news.xinhuanet.com/english/11": """
        <title>From page_ Xinhua</title><span>2014-06-03 01:02:03</span>
        <div><p>No dash in this paragraph, which is "long" enough.</p></div>""",
    "http://news.xinhuanet.com/english/12": "<div id='Title'>No date</div><p>BEIJING -- x",
    "http://elsewhere.example.com/13": "<h1 class='story'>Not ours</h1>",
    "http://www.bbc.co.uk/news/14": None,
}

WANT = {
    "http://www.apnewsarchive.com/2014/a": (
        "AP", "AP title ", "20140603", "PARIS (AP) — One & _two_. Three four. "
    ),
    "http://www.bbc.co.uk/news/1": ("BBC", "BBC title", "20140603", "One two three link Four Head"),
    "http://www.bbc.co.uk/news/2": ("BBC", "Inner title", "20140513", "One two Three Head"),
    "http://www.bbc.co.uk/news/3": ("BBC", "Single", "20140603", "Only  one  _text_  "),
    "http://news.bbc.co.uk/2/hi/4.stm": ("BBC", "Old title", "20140603", 'Lead. Body "x".'),
    "http://www.reuters.com/article/5": ("Reuters", "Reuters title", "20140603", " War talks. End. "),
    "http://www.upi.com/news/7": ("UPI", "UPI title", "20140603", "One  two .  Three"),
    "http://www.voanews.com/content/9": (
        "Voice of America", "VOA title", "20140603", "One  two  Three  Four "
    ),
    "http://news.xinhuanet.com/english/10": (
        "XNA", "XNA title", "20140603", "Talks  began , they say.  More of it"
    ),
    "http://news.xinhuanet.com/english/11": (
        "XNA", "From page", "20140603", 'No dash in this paragraph, which is "long" enough.\n\n'
    ),
}
REASONS = {
    "http://www.reuters.com/article/6": "no content",
    "http://www.upi.com/news/8": "no content",
    "http://news.xinhuanet.com/english/12": "no date",
    "http://www.bbc.co.uk/news/14": "no title",
}


def test_article_pages(spark):
    pages = spark.createDataFrame(list(PAGES.items()), "url string, html string").repartition(5)
    found = pages_to_articles(pages, JobConfig(keywords=("peace", "War")))
    got = {r.url: (r.source, r.title, r.date, r.content) for r in found.articles.collect()}
    assert got == WANT
    assert {r.url: r.reason for r in found.rejects.collect()} == REASONS


def test_keywords_are_needed_for_one_source_only(spark):
    pages = spark.createDataFrame(list(PAGES.items()), "url string, html string")
    got = {r.source for r in pages_to_articles(pages).articles.collect()}
    assert got == {"AP", "BBC", "UPI", "Voice of America", "XNA"}


RESULTS = {
    "http://www.apnewsarchive.com/s?1": '<a class="pgLnk">2</a><span class="refTxt">http://www.apnewsarchive.com/2014/x</span><span class="refTxt">http://www.apnewsarchive.com/2010/x</span><span class="refTxt">http://www.apnewsarchive.com/none</span>',
    "http://www.apnewsarchive.com/s?2": '<span class="refTxt">http://www.apnewsarchive.com/2014/y</span>',
    "http://www.bbc.co.uk/search/?q=x": '<div id="news-content"><p><a class="title-1" href="http://www.bbc.co.uk/news/1">a</a><a class="title" href="http://www.bbc.co.uk/school_report/1">a</a><a class="title" href="http://www.bbc.co.uk/news/magazine-1">a</a><a href="http://www.bbc.co.uk/no">a</a><a class="title" href="http://other.com/1">a</a></p></div><a class="title" href="/out">x</a><a id="next" href="?q=x&amp;page=2">n</a>',
    "http://www.reuters.com/resources/archive/us/2014.html": '<div class="moduleBody"><div><p><a href="/resources/archive/us/20140603.html">1</a><a href="/about">2</a></p></div><a href="/resources/archive/us/20140604.html">not in p</a></div><div class="headlineMed"><a href="http://www.reuters.com/article/2014/06/03/a">a</a></div><div class="headlineMed"><a href="http://www.reuters.com/video/2014/06/03/b">b</a></div><div class="headlineMed"><a href="http://www.reuters.com/article/2014/07/03/c">c</a></div><div class="headlineMed"><a href="http://www.reuters.com/article/nodate">d</a></div>',
    "http://www.upi.com/search/": '<p class="hl"><a href="http://www.upi.com/2014/06/30/a">a</a></p><p class="hl"><b><a href="http://www.upi.com/2014/06/29/b">b</a></b></p><p class="hl"><a href="http://www.upi.com/2014/06/01/c">c</a></p><p class="hl"><a href="http://www.upi.com/2014/06/01/c">c</a></p>',
    "http://www.voanews.com/search/": '<div id="search-results"><div><h3><a href="/content/a">a</a></h3><h4><a href="/content/b">b</a></h4></div></div>',
    "http://search.news.cn/x": '<span class="style1a"><a href="http://news.xinhuanet.com/a">a</a></span><span class="style1a"><a href="http://news.xinhuanet.com/video/b">b</a></span>',
}
WANT_LINKS = {
    ("AP", "http://www.apnewsarchive.com/2014/x"),
    ("BBC", "http://www.bbc.co.uk/news/1"),
    ("BBC", "http://www.bbc.co.uk/search/?q=x&page=2"),
    ("Reuters", "http://www.reuters.com/resources/archive/us/20140603.html"),
    ("Reuters", "http://www.reuters.com/article/2014/06/03/a"),
    ("UPI", "http://www.upi.com/2014/06/30/a"),
    ("UPI", "http://www.upi.com/2014/06/01/c"),
    ("VOA", "http://www.voanews.com/content/a"),
    ("XNA", "http://news.xinhuanet.com/a"),
}


def test_result_pages(spark):
    pages = spark.createDataFrame(list(RESULTS.items()), "url string, html string")
    cfg = JobConfig(start="2014-06-01", end="2014-06-30")
    rows = pages_to_links(pages, cfg).collect()
    assert {tuple(r) for r in rows} == WANT_LINKS and len(rows) == len(WANT_LINKS)
    seen = spark.createDataFrame(
        [("UPI", "http://www.upi.com/2014/06/30/a")] * 3 + [("BBC", "http://news.xinhuanet.com/a")],
        "source string, url string",
    )
    again = {tuple(r) for r in pages_to_links(pages, cfg, seen).collect()}
    assert again == WANT_LINKS - {("UPI", "http://www.upi.com/2014/06/30/a")}
    all_seen = spark.createDataFrame(sorted(WANT_LINKS), "source string, url string")
    assert pages_to_links(pages, cfg, all_seen).count() == 0


def test_links_keep_page_order(spark):
    pages = spark.createDataFrame(list(RESULTS.items()), "url string, html string")
    rows = extract_links(pages).where("source = 'Reuters' and link_kind = 'article'").collect()
    assert [r.url[-1] for r in sorted(rows, key=lambda r: r.pos)] == ["a", "b", "c", "e"]


def test_reader_survives_deep_and_broken_pages():
    deep = Page("<b>" * 20_000 + "<p class=x>text" + "</i></div>")
    assert deep.texts((Step("//", ("b",)), Step("//", ("p",), "class", "=", "x"))) == ["text"]
    assert deep.plain_text(0).strip("*\n ") == "text"
    assert Page("<p>a<p>b</p></p>c<![bad <x").texts((Step("//", ("p",)),)) == ["a", "b"]
    assert Page("").main_node() == 0
    nested = Page("<div><p>Twenty-five letters, and more of them." + "<b><p>x" * 20_000)
    assert nested.tag[nested.main_node()] in ("div", "p", "b")


@pytest.mark.parametrize(
    "html, want",
    [
        ("<div>a<p>b</p>c</div>", "a\n\nb\n\nc\n\n"),
        ("<div><h2>T</h2>x <em>y</em><script>no</script></div>", "## T\n\nx _y_\n\n"),
        ("<div>a&nbsp;&lt;&#233;\n  b</div>", "a\xa0<é b\n\n"),
        ("<div><ul><li>a<li>b</ul></div>", "* a\n\n* b\n\n"),
    ],
)
def test_plain_text(html, want):
    page = Page(html)
    assert page.plain_text(1) == want


def _seconds(n):
    html = "<div>" * n + "<p>x</p>" * n + "</span>" * n
    paths = [p for layout in LAYOUTS["BBC"] for p in layout.body]
    best = 1e9
    for _ in range(3):
        start = time.perf_counter()
        Page(html).find(*paths)
        best = min(best, time.perf_counter() - start)
    return best


def test_selecting_is_linear_in_the_depth():
    assert _seconds(64_000) < 40 * _seconds(4_000)


def test_selectors_on_nested_nodes():
    page = Page('<div id=a><p><b>1</b></p><div id=a><p>2</p></div></div><p>3</p><div><p>4</p></div>')
    below = (Step("//", ("div",), "id", "=", "a"), Step("//", ("p",)))
    inside = (Step("//", ("div",)), Step("/", ("p",)))
    assert page.texts(below) == ["2"] and len(page.find(below)) == 2
    assert page.texts(inside) == ["2", "4"]
    assert page.texts((Step("//", (), "id", "=", "a"), Step("//", ("b",)))) == ["1"]
