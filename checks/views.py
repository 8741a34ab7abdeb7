"""Article, page and URL views over the driver tables, in Spark and as SQL.

The tables hold no news markers, so each view puts hits and near misses of every
rule around whole texts, chosen by row id. Both forms share the constants here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.session import computed_once
from pressmill.sources.tables import read_table

SOURCES = ("AP", "BBC", "Reuters", "UPI", "XNA", "Voice of America")

TITLE_MARKS = (
    "",
    "UPDATE 1-Talks resume ",
    "UPDATED talks ",
    "DIARY - Africa ",
    "REG Notice ",
    "NBA scores ",
    "Flash: quake ",
    "World News for Schools ",
    "China's talks - Xinhua | English ",
    "REFILE-* #1 ",
    "RCS Notice ",
)
URL_MARKS = ("", "a-MW-b/", "idMW2014/", "news/magazine-1/", "x/BW/")
CONTENT_MARKS = (
    "",
    "LONDON (Reuters) - ",
    "PARIS Reuters - The a Reuters - end. ",
    "(Reuters Life!) - ",
    "So Reuters Life!x ",
    "PRNewswire says ",
    "BC-X TYPE: CN ))Body TYPE: CN ",
    "AP (new lede,  12))",
    "Rafael Nadal won. ",
    "Best of the NBA — ",
    "_WikiLeaks_ said… “smart” quotes for £5. ",
    "X, June 3 (UPI) -- One. (UPI) -- ",
    "BEIJING -- Talks began -- ended. ",
    "'Yes,' he said to all of the others. ",
    '"Go" now to the other side of the river. ',
    "View the slide show here and now. ",
    "NEW YORK (Hollywood Reporter) - ",
    "He met Mr. Jones and A. Brown of the U.S. State Department. Mr. Smith stayed on. ",
    'He said "Stop. Go now." Then the crowd left. The deal (made in 1999. It held) was kept. ',
    "The treaty (signed in 1999. It was never ratified. ",
    'He called it "over. Nobody agreed. ',
    "It ended in may. Thé Café in Straße #1 was *closed* then? Yes! 42 left. +1 (Really.) ",
    "Keep\r\n\r\nthis. ",
)
TAIL_MARKS = (
    "",
    "\n_NEW: tail\nmore",
    " _NEW:",
    " _SOME information for this report came\nfrom x",
    " Please turn on javascript. Media requires JavaScript to play. ",
    "\n\n\n  ",
    " The end.",
)


#: The driver's tables are one row group each, and text work costs more than moving them.
PARTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", PARTS)


def pick(values: tuple[str, ...], i: Column) -> Column:
    """The value at ``i`` modulo their number."""
    return F.get(F.array(*map(F.lit, values)), (i % len(values)).cast("int"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick_sql(values: tuple[str, ...], i: str) -> str:
    listed = ", ".join(map(quoted, values))
    return f"([{listed}])[CAST({i} % {len(values)} AS INTEGER) + 1]"


def documents_as_articles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Every document as an article. The rows stand for stored ones, so what derives
    them is computed once; name the ``columns`` wanted to read no others."""
    doc_id = F.col("doc_id")
    source = pick(SOURCES, doc_id)
    day = F.date_add(F.lit("2014-05-01").cast("date"), (doc_id % 61).cast("int"))
    articles = table(spark, sf_dir, "documents").select(
        "doc_id",
        source.alias("source"),
        F.lit("talks").alias("query"),
        F.date_format(day, "yyyyMMdd").alias("date"),
        doc_id.alias("pos"),
        F.concat(
            F.lit("http://example.com/"), source, F.lit("/"), pick(URL_MARKS, doc_id), doc_id
        ).alias("url"),
        F.concat(pick(TITLE_MARKS, doc_id), F.substring_index("text", "\n", 1)).alias("title"),
        F.concat(pick(CONTENT_MARKS, doc_id), F.col("text"), pick(TAIL_MARKS, doc_id)).alias("content"),
    )
    return computed_once(articles.select(*columns) if columns else articles)


ARTICLES_SQL = f"""
articles AS (
  SELECT doc_id, {pick_sql(SOURCES, 'doc_id')} AS source, 'talks' AS query,
         strftime(DATE '2014-05-01' + CAST(doc_id % 61 AS INTEGER), '%Y%m%d') AS date,
         'http://example.com/' || {pick_sql(SOURCES, 'doc_id')} || '/'
           || {pick_sql(URL_MARKS, 'doc_id')} || doc_id AS url,
         {pick_sql(TITLE_MARKS, 'doc_id')} || string_split(text, chr(10))[1] AS title,
         {pick_sql(CONTENT_MARKS, 'doc_id')} || text || {pick_sql(TAIL_MARKS, 'doc_id')} AS content
  FROM documents
)"""

# -- pages in the sources' layouts -------------------------------------------

PAGE_SOURCES = (
    "AP", "BBC", "BBC inner", "BBC old", "Reuters", "UPI", "VOA", "XNA", "BBC loose", "XNA untitled",
)
PAGE_LABELS = (
    "AP", "BBC", "BBC", "BBC", "Reuters", "UPI", "Voice of America", "XNA", "BBC", "XNA",
)
PAGE_HOSTS = (
    "http://www.apnewsarchive.com/",
    "http://www.bbc.co.uk/news/",
    "http://www.bbc.co.uk/sport/",
    "http://news.bbc.co.uk/2/hi/",
    "http://www.reuters.com/article/",
    "http://www.upi.com/news/",
    "http://www.voanews.com/content/",
    "http://news.xinhuanet.com/english/",
    "http://www.bbc.co.uk/loose/",
    "http://news.xinhuanet.com/untitled/",
)
KEYWORDS = ("tion ", "que l")

#: Pieces that are cut from each benchmark text as keywords, and how far apart.
KEYWORD_PIECES, KEYWORD_STEP = 240, 1


def keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of 9 to 11 characters of all benchmark texts, and the names of all parts."""
    last = (KEYWORD_PIECES - 1) * KEYWORD_STEP + 1
    start = F.explode(F.sequence(F.lit(1), F.lit(last), F.lit(KEYWORD_STEP)))
    items = read_table(spark, f"{sf_dir}/benchmark.parquet").select("text", "item_id", start.alias("start"))
    piece = F.substring("text", F.col("start"), (9 + F.col("item_id") % 3).cast("int"))
    parts = read_table(spark, f"{sf_dir}/part.parquet").select(F.col("p_name").alias("keyword"))
    return items.select(piece.alias("keyword")).where("keyword <> ''").unionByName(parts)


KEYWORDS_SQL = (
    f"listed AS (SELECT DISTINCT substr(text, CAST(i * {KEYWORD_STEP} + 1 AS BIGINT), 9 + item_id % 3) AS keyword "
    f"FROM benchmark, range(0, {KEYWORD_PIECES}) r(i) UNION SELECT p_name FROM part)"
)

_NAV = (
    '<html><head><script>var t="</p>";track("2014-01-01 00:00:00 is a stamp");</script></head>'
    '<body><div class="nav"><ul><li><a href="/a">One<li><a href="/b">Two</ul></div>'
)
_END = '<div class="foot"><a href="/c">Contact</a></div></body></html>'

#: Before the title, between title and date, between date and body, after the body.
PAGE_PARTS = {
    "AP": (
        '<h1 class="ap_headTitle"><span>',
        '</span></h1><strong class="ap_dt_stmp"><span> ',
        '</span></strong><div class="body"><div><p><span id="dateLine">PARIS</span> ',
        "</div></div>",
    ),
    "BBC": (
        '<h1 class="story-header"> ',
        ' </h1><span class="date">',
        '</span><p class="caption">Please turn on JavaScript</p><div class="story-body">'
        "<noscript>Old <b>notice</b></noscript><p>Lead one.</p><p>",
        "</div>",
    ),
    "BBC inner": (
        '<div class="story-inner"><h1>',
        '</h1><p class="date-line"><strong>',
        '</strong></p><h2 class="heading">Heading</h2><p>',
        "</div>",
    ),
    "BBC old": (
        '<div class="mxb"><h1>',
        '</h1></div><div class="ds">',
        '</div><table><tr><td class="storybody"><p><b>Lead.</b></p><p>',
        "</td></tr></table>",
    ),
    "Reuters": (
        '<div class="column1 gridPanel grid8"><h1>',
        '</h1></div><span class="timestamp">',
        '</span><span class="timestamp">later</span><span id="articleText"><p>PARIS (Reuters) - ',
        "</span>",
    ),
    "UPI": (
        '<div id="c_story"><h1>',
        '</h1></div><div class="meta grey"><b>By</b> someone <i>|</i>',
        ' | <a href="/p">print</a> share</div><div class="st_text_c"><p>PARIS, June 3 (UPI) -- ',
        "</div>",
    ),
    "VOA": (
        '<div id="article"><h1> ',
        '</h1></div><p class="article_date">',
        '</p><div class="zoomMe"><div><p>',
        "</div></div>",
    ),
    "XNA": (
        '<div id="Title"> ',
        '</div><span id="pubtime">',
        '</span><div id="Content"><p>BEIJING, June 3 (Xinhua) -- ',
        "</div>",
    ),
    "BBC loose": (
        '<h1 class="story">',
        '</h1><span class="date">',
        '</span><div class="story-body">',
        "</div>",
    ),
    "XNA untitled": (
        "<title> ",
        '_ News_ World</title><span id="pubtime">',
        '</span><div id="Content"><p>BEIJING, June 3 (Xinhua) -- ',
        "</div>",
    ),
}

#: How each layout writes the moment of publication: Spark pattern, SQL format.
DATE_STYLES = {
    "AP": ("MMM'.' d, yyyy", "%b. %-d, %Y"),
    "BBC": ("d MMMM yyyy", "%-d %B %Y"),
    "BBC inner": ("d MMMM yyyy", "%-d %B %Y"),
    "BBC old": ("HH:mm 'GMT', EEEE, d MMMM yyyy HH:mm 'UK'", "%H:%M GMT, %A, %-d %B %Y %H:%M UK"),
    "Reuters": ("EEE MMM d, yyyy h:mma 'EDT'", "%a %b %-d, %Y %-I:%M%p EDT"),
    "UPI": ("'Updated 'MMMM d, yyyy' at 'h:mm a", "Updated %B %-d, %Y at %-I:%M %p"),
    "UPI short": ("'| 'MMM'.' d, yyyy' at 'h:mm a", "| %b. %-d, %Y at %-I:%M %p"),
    "VOA": ("'Last updated on: 'MMMM d, yyyy HH:mm a", "Last updated on: %B %-d, %Y %H:%M %p"),
    "XNA": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
}


def date_style(layout: str) -> tuple[str, str]:
    return DATE_STYLES[layout.removesuffix(" loose").removesuffix(" untitled")]


def _escaped(c: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def _moment(doc_id: Column) -> Column:
    day = F.date_add(F.lit("2014-05-01").cast("date"), (doc_id % 61).cast("int"))
    return day.cast("timestamp") + F.make_dt_interval(
        hours=(doc_id % 24).cast("int"), mins=(doc_id % 60).cast("int")
    )


MOMENT_SQL = (
    "(DATE '2014-05-01' + CAST(doc_id % 61 AS INTEGER) + to_hours(CAST(doc_id % 24 AS INTEGER))"
    " + to_minutes(CAST(doc_id % 60 AS INTEGER)))"
)


def documents_as_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page of one of the sources: ``doc_id, url, html``."""
    doc_id, text = F.col("doc_id"), F.col("text")
    headline = _escaped(F.substring_index(text, "\n", 1))
    paragraphs = F.replace(_escaped(text), F.lit("\n"), F.lit("</p>\n<p>"))
    html = F.lit(None).cast("string")
    for i, name in enumerate(PAGE_SOURCES):
        parts = [F.lit(p) for p in PAGE_PARTS[name]]
        page = F.concat(
            F.lit(_NAV),
            parts[0],
            headline,
            parts[1],
            F.date_format(_moment(doc_id), date_style(name)[0]),
            parts[2],
            paragraphs,
            parts[3],
            F.lit(_END),
        )
        html = F.when(doc_id % len(PAGE_SOURCES) == i, page).otherwise(html)
    return computed_once(
        table(spark, sf_dir, "documents").select(
            "doc_id", F.concat(pick(PAGE_HOSTS, doc_id), doc_id).alias("url"), html.alias("html")
        )
    )


# -- result pages ------------------------------------------------------------

LIST_SOURCES = ("AP", "BBC", "Reuters", "UPI", "VOA", "XNA")
LIST_HOSTS = (
    "http://www.apnewsarchive.com",
    "http://www.bbc.co.uk",
    "http://www.reuters.com",
    "http://www.upi.com",
    "http://www.voanews.com",
    "http://news.xinhuanet.com",
)
#: Before the links, before a link, between its URL and its end, after the links.
LIST_PARTS = {
    "AP": ("<body>", '<span class="refTxt">', "</span><br>", '<a class="pgLnk" href="/2">2</a>'),
    "BBC": (
        '<div id="news-content"><ul>',
        '<li><a class="title linktrack" href="',
        '">x</a><a href="/other">y</a>',
        '</ul></div><a id="next" href="?page=2&amp;q=x">next</a>',
    ),
    "Reuters": (
        '<div class="moduleBody"><p><a href="../archive/20140501.html">1</a>'
        '<a href="/archive/about.htm">2</a></div>',
        '<div class="headlineMed"><a href="',
        '">x</a></div>',
        "",
    ),
    "UPI": ("", '<p class="hl"><a href="', '">x</a>', "</p>"),
    "VOA": ('<div id="search-results">', '<div><h3><a href="', '">x</a></h3></div>', "</div>"),
    "XNA": ("", '<span class="style1a"><a href="', '">x</a></span>', ""),
}
SECTIONS = ("news", "magazine", "video", "school_report", "world")
_HREF = r'<a href="/([^"]*)"'


def pages_as_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a source's result page listing one link per link it has."""
    page_id = F.col("page_id")

    def link(i: int):
        def build(slug: Column, at: Column) -> Column:
            day = F.lpad(((page_id + at) % 28 + 1).cast("string"), 2, "0")
            path = F.concat(
                F.lit("/"), pick(SECTIONS, page_id + at), F.lit("/2014/05/"), day, F.lit("/"), slug
            )
            _, before, after, _ = LIST_PARTS[LIST_SOURCES[i]]
            host = F.lit(LIST_HOSTS[i] if LIST_SOURCES[i] != "VOA" else "")
            return F.concat(F.lit(before), host, path, F.lit(after))

        return build

    html = F.lit(None).cast("string")
    for i, name in enumerate(LIST_SOURCES):
        slugs = F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))
        page = F.concat(
            F.lit(LIST_PARTS[name][0]),
            F.array_join(F.transform(slugs, link(i)), "\n"),
            # Every other page of this source shows no pager.
            F.when((F.lit(name) != "AP") | (page_id % 12 == 0), F.lit(LIST_PARTS[name][3])).otherwise(""),
        )
        html = F.when(page_id % len(LIST_SOURCES) == i, page).otherwise(html)
    return computed_once(
        table(spark, sf_dir, "pages").select(
            "page_id",
            F.concat(pick(LIST_HOSTS, page_id), F.lit("/search/"), page_id, F.lit(".html?p=1")).alias(
                "url"
            ),
            html.alias("html"),
        )
    )


# -- stored archives -----------------------------------------------------------

#: Pages of a result list before it leads back to its first, and how far apart lists start.
LIST_LENGTH, LIST_STARTS = 40, 3


def pages_as_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a stored result page, its own markup included. Pages with even ids are BBC
    lists: each leads to the next, the last of a list back to its first. Those with odd ids are
    Reuters archives: each leads to two others, all of them to the first, and some to pages that
    are not stored."""
    page_id = F.col("page_id")
    step = 2 * LIST_LENGTH
    after = F.when(page_id % step == step - 2, page_id - (step - 2)).otherwise(page_id + 2)
    listed = F.concat(F.lit('<a id="next" href="?list='), after, F.lit('#top">next</a>'), "html")

    def day(target: Column) -> Column:
        return F.concat(F.lit('<a href="../us/'), target, F.lit('.html">day</a>'))

    archive = F.concat(
        F.lit('<div class="moduleBody"><p>'),
        day(2 * page_id + 3), day(3 * page_id), day(F.lit(1)),
        F.lit('<a href="/about.htm">about</a></p></div>'), "html",
    )
    even = page_id % 2 == 0
    return computed_once(
        table(spark, sf_dir, "pages").select(
            "page_id",
            F.when(even, F.concat(F.lit("http://www.bbc.co.uk/search?list="), page_id))
            .otherwise(F.concat(F.lit("http://www.reuters.com/us/"), page_id, F.lit(".html")))
            .alias("url"),
            F.when(even, listed).otherwise(archive).alias("html"),
        )
    )


def archive_starts(pages: DataFrame) -> DataFrame:
    """The first page of every third list, and one archive."""
    page_id = F.col("page_id")
    lists = page_id % (2 * LIST_LENGTH * LIST_STARTS) == 0
    return pages.where(lists | (page_id == 5)).select("url")


# -- whole sites ---------------------------------------------------------------

#: Blocks that every page of a site has, some of them longer than many stories.
SITE_MENU = (
    "Home and world and all the other sections of this site in one long line",
    "Sign in, subscribe, read the terms of use and the notes on privacy",
)
SITE_NOTE = "All rights reserved, and nothing of this may be published, broadcast or rewritten"
#: Share of its pages, in tenths, that carries the site's special notice.
SITE_SPECIAL = "A special notice that stands on some of the pages of this site only, for a while"
SITES = 20


def documents_as_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page of one of a few sites, each line a paragraph, between blocks that
    all pages of the site share. A notice stands on a tenth of them. Two documents have a site
    each of their own."""
    doc_id = F.col("doc_id")
    alone = doc_id < 2
    host = F.when(alone, F.concat(F.lit("alone"), doc_id)).otherwise(F.concat(F.lit("site"), doc_id % SITES))
    menu = "".join(f"<div><p>{m} " for m in SITE_MENU)
    special = F.when(F.floor(doc_id / SITES) % 10 == 0, F.lit(f"<p>{SITE_SPECIAL}</p>")).otherwise("")
    paragraphs = F.replace(_escaped(F.col("text")), F.lit("\n"), F.lit("</p><p>"))
    html = F.concat(
        F.lit("<html><body>"), F.lit(menu), F.lit("</div></div>"), special, F.lit('<div id="story"><p>'), paragraphs,
        F.lit(f"</p></div><p>{SITE_NOTE}</p></body></html>"),
    )
    return computed_once(
        table(spark, sf_dir, "documents").select(
            "doc_id", F.concat(F.lit("http://"), host, F.lit(".example.com/"), doc_id).alias("url"), html.alias("html")
        )
    )
