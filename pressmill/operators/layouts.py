"""Where each source keeps its fields: the selector tables of L1, L3, E1-E4, E9."""

from __future__ import annotations

from typing import NamedTuple

from pressmill.functions.html_nodes import Step

Path = tuple[Step, ...]

# Hosts, selectors and labels of the six sources.

#: L4: hosts each source may be read from.
DOMAINS = {
    "AP": ("www.apnewsarchive.com",),
    "BBC": ("www.bbc.co.uk", "news.bbc.co.uk"),
    "Reuters": ("www.reuters.com",),
    "UPI": ("www.upi.com",),
    "VOA": ("www.voanews.com",),
    "XNA": ("search.news.cn", "news.xinhuanet.com"),
}

#: Label written to articles where it differs from the source's short name.
LABELS = {"VOA": "Voice of America"}


class LinkRule(NamedTuple):
    """Result page selectors. ``attr`` None means the link is the node's text."""

    articles: Path
    attr: str | None = "href"
    follow: Path | None = None
    follow_pattern: str | None = None
    pager: str | None = None
    exclude: tuple[str, ...] = ()
    dated_by: str | None = None


LINK_RULES = {
    "AP": LinkRule(
        (Step("//", ("span",), "class", "=", "refTxt"),),
        attr=None,
        pager=r"""<a\b[^>]*\bclass\s*=\s*["']?pgLnk["'\s>]""",
        dated_by="year",
    ),
    "BBC": LinkRule(
        (Step("//", (), "id", "=", "news-content"), Step("//", ("a",), "class", "^=", "title")),
        follow=(Step("//", ("a",), "id", "=", "next"),),
        exclude=("/school_report/", "magazine"),
    ),
    "Reuters": LinkRule(
        (Step("//", ("div",), "class", "=", "headlineMed"), Step("/", ("a",))),
        follow=(
            Step("//", ("div",), "class", "=", "moduleBody"),
            Step("//", ("p",)),
            Step("//", ("a", "area")),
        ),
        follow_pattern=r"\d+\.html$",
        exclude=("video",),
        dated_by="date",
    ),
    "UPI": LinkRule(
        (Step("//", ("p",), "class", "=", "hl"), Step("/", ("a",))),
        dated_by="date",
    ),
    "VOA": LinkRule(
        (
            Step("//", ("div",), "id", "=", "search-results"),
            Step("/", ("div",)),
            Step("/", ("h3",)),
            Step("/", ("a",)),
        ),
    ),
    "XNA": LinkRule(
        (Step("//", ("span",), "class", "=", "style1a"), Step("/", ("a",))),
        exclude=("/video/",),
    ),
}


class Layout(NamedTuple):
    """Article page selectors.

    ``body`` are text selectors; ``fragment`` is read as a whole, from its nearest
    ``around`` ancestor if given; ``main`` reads the page's main content.
    """

    name: str
    title: tuple[Path, ...]
    date: tuple[Path, ...] = ()
    body: tuple[Path, ...] = ()
    fragment: Path | None = None
    around: str | None = None
    main: bool = False
    stamp: bool = False


def _one(tag: str, attr: str, value: str, how: str = "=") -> Step:
    return Step("//", (tag,), attr, how, value)


_STORY_BODY = _one("div", "class", "story-body")

#: Layouts of a source in the order they are tried; the first with a title wins.
LAYOUTS = {
    "AP": (
        Layout(
            "AP",
            title=((_one("h1", "class", "ap_headTitle"), Step("//", ("span",))),),
            date=((_one("strong", "class", "ap_dt_stmp"), Step("/", ("span",))),),
            fragment=(_one("span", "id", "dateLine"),),
            around="div",
        ),
    ),
    "BBC": (
        Layout(
            "BBC",
            title=((_one("h1", "class", "story", "^="),),),
            date=((_one("span", "class", "date"),),),
            body=(
                (_STORY_BODY, Step("//", ("p", "strong"))),
                (_one("span", "class", "cross-head"),),
                (_STORY_BODY, Step("/", ("p",)), Step("/", ("a",))),
            ),
            fragment=(_STORY_BODY,),
        ),
        Layout(
            "BBC inner",
            title=((_one("div", "class", "story-inner"), Step("/", ("h1",))),),
            date=((_one("p", "class", "date", "^="), Step("/", ("strong",))),),
            body=(
                (_one("div", "class", "story-inner"), Step("/", ("p",))),
                (_one("h2", "class", "heading"),),
            ),
        ),
    ),
    "BBC old": (
        Layout(
            "BBC old",
            title=((_one("div", "class", "mxb"), Step("/", ("h1",))),),
            date=((_one("div", "class", "ds"),),),
            body=(
                (_one("td", "class", "storybody"), Step("/", ("p",))),
                (_one("td", "class", "storybody"), Step("/", ("p",)), Step("/", ("b",))),
            ),
        ),
    ),
    "Reuters": (
        Layout(
            "Reuters",
            title=((_one("div", "class", "column1 gridPanel grid8"), Step("/", ("h1",))),),
            date=((_one("span", "class", "timestamp"),),),
            fragment=(_one("span", "id", "articleText"),),
        ),
    ),
    "UPI": (
        Layout(
            "UPI",
            title=((_one("div", "id", "c_story"), Step("/", ("h1",))),),
            date=((_one("div", "class", "meta grey"),),),
            fragment=(_one("div", "class", "st_text_c"),),
        ),
    ),
    "VOA": (
        Layout(
            "VOA",
            title=((_one("div", "id", "article"), Step("/", ("h1",))),),
            date=((_one("p", "class", "article_date"),),),
            fragment=(_one("div", "class", "zoomMe"),),
        ),
    ),
    "XNA": (
        Layout("XNA", title=((_one("div", "id", "Title"),),), main=True, stamp=True),
    ),
}
