"""Story and template of pages of whole sites."""

import pytest

from pressmill.functions.html_nodes import Page
from pressmill.operators import sites
from pressmill.operators.sites import page_blocks, site_articles

MENU = "".join(f"<li><a href='/{k}'>Section {k} of the paper, with a long and winding name</a>" for k in range(60))
NOTE = "<p>Do not copy any of this, or we will be rather sad about it.</p>"


def html(*paragraphs):
    story = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"<html><body><ul>{MENU}</ul><div>{story}</div>{NOTE}<script>x('<p>no</p>')</script></body></html>"


def said(k, part=0):
    return f"Report {k}.{part} is <b>short</b> &amp; plain, and found on one page."


def plain(k, part=0):
    return f"Report {k}.{part} is short & plain, and found on one page."


def stories(spark, rows):
    found = site_articles(spark.createDataFrame(rows, "url string, html string")).collect()
    return {r.url: (r.story, r.by_site) for r in found}


def test_blocks_of_a_page():
    page = Page("<div>a <b>b</b>c<p>d<br>e</p> <a href='/'>f g</a><script>no</script></div><td>h <td>i<style>x</style>")
    assert page.blocks() == [("a bc", 0), ("d", 0), ("e", 0), ("f g", 3), ("h", 0), ("i", 0)]
    assert Page("").blocks() == [] and Page("<p>open").blocks() == [("open", 0)]


def test_menus_longer_than_the_story(spark):
    rows = [(f"http://x.com/{k}", html(said(k), said(k, 1))) for k in range(6)]
    rows.append(("http://x.com/empty", html()))
    found = stories(spark, rows)
    for k in range(6):
        assert found[f"http://x.com/{k}"] == (f"{plain(k)}\n{plain(k, 1)}", True)
    assert found["http://x.com/empty"] == ("", True)


def test_sites_are_told_apart_and_small_ones_fall_back(spark):
    same = "One paragraph that two pages of a large site have in common."
    rows = [(f"http://big.com/{k}", html(said(k), *[same] * (k < 2))) for k in range(10)]
    rows += [(f"http://small.com/{k}", html(said(k), same)) for k in range(2)]
    rows += [("no url at all", html(said(1))), (None, html(said(2))), ("http://big.com/0#b", "<p>" + "x" * 30)]
    found = stories(spark, rows)
    assert found["http://big.com/0"] == (f"{plain(0)}\n{same}", True)  # two of eleven pages: no template
    assert found["http://big.com/9"] == (plain(9), True)
    assert found["http://big.com/0#b"] == ("x" * 30, True)
    story, by_site = found["http://small.com/1"]
    assert not by_site and story.startswith("Report 1.0 is **short** & plain")  # the page's own reading
    assert found["no url at all"][1] is False and found[None][0].startswith("Report 2.0 is")


def test_links_are_no_prose(spark):
    index = "".join(f'<p><a href="/a{{0}}{k}">Headline {{0}}.{k} that leads to another page</a></p>' for k in range(4))
    rows = [(f"http://x.com/{k}", html(said(k)) + index.format(k)) for k in range(4)]
    assert all(story == plain(int(u[-1])) for u, (story, _) in stories(spark, rows).items())


def test_large_sites_are_dealt_out(spark):
    """One site with most pages; equal rows are pages too."""
    rows = [(f"http://hot.com/{k}", html(said(k))) for k in range(300)] + [("http://hot.com/0", html(said(0)))] * 3
    found = site_articles(spark.createDataFrame(rows, "url string, html string").repartition(6)).collect()
    assert len(found) == 303
    assert all(r.story == plain(r.url.rsplit("/", 1)[1]) and r.by_site for r in found)


def test_odd_tables(spark):
    pages = spark.createDataFrame([("http://x.com/1", None, 1)] * 3, "url string, html string, story int")
    assert [(r.story, r.by_site) for r in site_articles(pages).collect()] == [("", True)] * 3
    assert site_articles(pages.limit(0)).count() == 0
    assert page_blocks(pages).columns == ["url", "own", "blocks"]


@pytest.mark.parametrize("share, kept", [(0.2, False), (0.5, True)])
def test_share_decides(spark, share, kept):
    notice = "A notice that stands on three of the ten pages of this site."
    rows = [(f"http://x.com/{k}", html(said(k), *[notice] * (k < 3))) for k in range(10)]
    found = sites.site_articles(spark.createDataFrame(rows, "url string, html string"), share=share).collect()
    assert [notice in r.story for r in sorted(found, key=lambda r: r.url)] == [kept] * 3 + [False] * 7
