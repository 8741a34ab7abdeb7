"""Follow-up links followed to the end over stored pages: L3.

The pages a crawl has stored are a graph: a page leads to the stored pages its follow-up links
name. Wanted are all pages that start pages lead to, directly or over others.

* Result lists are chains ("next page"). A page that only one page leads to, and that page to
  no other, is folded into the chain it belongs to: every link of a chain learns its head by
  pointer doubling, so a chain of n pages takes log2(n) rounds and not n.
* Between chains the search is semi-naive: only pages found in the last round are joined with
  the links, and only pages not found before go on. A cycle finds nothing new and ends.

All tables between rounds lie in the shared folder; each holds keys of pages only. Rounds are as
many as there are links between chains on the way to the farthest page.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.session import stored


def page_key(url: Column) -> Column:
    """What names a page: its URL without the fragment."""
    return F.regexp_replace(url, r"#.*", "")


def page_graph(pages: DataFrame, links: DataFrame) -> DataFrame:
    """``at, to``: stored pages and the stored pages they lead to, each pair once.

    ``links`` are rows of ``page_url, url``, of any kind.
    """
    known = pages.select(page_key(F.col("url")).alias("to")).distinct()
    pairs = links.select(page_key(F.col("page_url")).alias("at"), page_key(F.col("url")).alias("to"))
    return pairs.where(F.col("at") != F.col("to")).distinct().join(known, "to", "left_semi").select("at", "to")


def _chain_heads(inner: DataFrame) -> DataFrame:
    """``to, head`` for ``inner`` links ``at, to`` in which every page leads to one page at most
    and one page at most leads to it: the first page of the chain. Rings have no first page
    and are left out."""
    heads = stored(inner.select("to", F.col("at").alias("head")))
    # A round doubles how far a page looks back, so after these no chain is left open.
    for _ in range(heads.count().bit_length()):
        jump = heads.select(F.col("to").alias("head"), F.col("head").alias("further"))
        moved = stored(heads.join(jump, "head", "left").select("to", "head", "further"))
        heads = moved.select("to", F.coalesce("further", "head").alias("head"))
        if moved.where(F.col("further").isNotNull()).isEmpty():
            break
    return heads.join(heads.select(F.col("to").alias("head")), "head", "left_anti").select("to", "head")


def reachable_pages(pages: DataFrame, links: DataFrame, starts: DataFrame) -> DataFrame:
    """``url`` of all stored pages that ``starts`` (``url``) lead to, they themselves included if
    they are stored, without fragments.

    ``pages`` needs ``url``, ``links`` ``page_url`` and ``url``. Links to pages that are not stored
    lead nowhere; null URLs are left out; a page stored twice is one page.
    """
    graph = stored(page_graph(pages, links))
    known = pages.select(page_key(F.col("url")).alias("url")).where(F.col("url").isNotNull()).distinct()
    begin = stored(
        starts.select(page_key(F.col("url")).alias("url")).distinct().join(known, "url", "left_semi")
    )
    # Links inside chains: the only way out of one page and the only way into another that is
    # no start. All other links, and the starts, are what the search goes by.
    one_way = graph.groupBy("at").agg(F.count("*").alias("ways")).where(F.col("ways") == 1)
    one_entry = graph.groupBy("to").agg(F.count("*").alias("entries")).where(F.col("entries") == 1)
    inner = stored(
        graph.join(one_way, "at", "left_semi")
        .join(one_entry, "to", "left_semi")
        .join(begin.select(F.col("url").alias("to")), "to", "left_anti")
    )
    heads = stored(_chain_heads(inner))
    # A page inside a chain stands for the chain's head; a link out of it starts there.
    outer = graph.join(inner, ["at", "to"], "left_anti")
    home = heads.select(F.col("to").alias("at"), "head")
    steps = stored(
        outer.join(home, "at", "left").select(F.coalesce("head", "at").alias("at"), "to").distinct()
    )
    found, new = [begin], begin
    while not new.isEmpty():
        ahead = steps.join(new.select(F.col("url").alias("at")), "at", "left_semi").select(F.col("to").alias("url"))
        seen = reduce(DataFrame.unionByName, found)
        new = stored(ahead.distinct().join(seen, "url", "left_anti"))
        found.append(new)
        if len(found) > 16:  # keep the plan short however many rounds there are
            found = [stored(reduce(DataFrame.unionByName, found))]
    reached = reduce(DataFrame.unionByName, found)
    inside = heads.join(reached.select(F.col("url").alias("head")), "head", "left_semi")
    return reached.unionByName(inside.select(F.col("to").alias("url")))
