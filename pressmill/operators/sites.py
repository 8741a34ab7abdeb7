"""Main content told from whole sites: E12.

What a site repeats is its template. A page is cut into blocks, the texts of its paragraphs,
headings, list items and cells; a block that stands on a good share of a host's pages is template,
and the story is what is left of the prose. Nothing is scored on a page by itself, so menus longer
than the story don't matter.

* Pages are parsed once, in Arrow batches; blocks are known by 64-bit hashes from there on.
* Counts are of pages per host and block: rows are reduced map side, so a host with a third of
  all pages sends a block of its template once for each task.
* A host's template is one row: it has at most blocks-a-page / share entries. Pages meet it under
  host and salt, so a large host is dealt out; a small table of templates travels to the pages.
* A host with few pages has no template to see. Its pages are read by themselves, as before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pressmill.functions.html_nodes import Page
from pressmill.functions.urls import host_of
from pressmill.session import prepare_workers, stored

#: A block is template if this share of a host's pages have it, and so many pages at least.
SHARE, PAGES = 0.3, 3
#: Prose: characters of a block at least, and the share of them inside links at most.
PROSE, LINKED = 25, 0.5
#: Parts that the pages of every host are dealt into.
SALTS = 32
#: Pages held as Python objects at once.
_PAGES = 64

_BLOCKS = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("own", T.StringType()),
        T.StructField(
            "blocks",
            T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("linked", T.IntegerType())])),
        ),
    ]
)


def page_blocks(pages: DataFrame, own: bool = True) -> DataFrame:
    """``url``, ``blocks`` (text, characters inside links) in page order, and ``own``, the main
    content as far as the page by itself tells: null unless wanted. A page that cannot be read has
    neither."""
    prepare_workers(pages.sparkSession)
    arrow = to_arrow_schema(_BLOCKS)

    def one(url: str | None, html: str | None) -> dict:
        try:
            page = Page(html or "")
            blocks = [{"text": text, "linked": linked} for text, linked in page.blocks()]
            story = page.plain_text(page.main_node()).strip() if own else None
            return {"url": url, "own": story, "blocks": blocks}
        except Exception:  # noqa: BLE001 - a broken page has no content
            return {"url": url, "own": None, "blocks": []}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _PAGES):
                rows = batch.slice(k, _PAGES).to_pylist()
                yield pa.RecordBatch.from_pylist([one(r["url"], r["html"]) for r in rows], schema=arrow)

    return pages.select("url", "html").mapInArrow(read, _BLOCKS)


def _hashed(blocks: str) -> Column:
    return F.transform(blocks, lambda b: F.xxhash64(b["text"]))


def templates(blocks: DataFrame, share: float = SHARE, least: int = PAGES) -> DataFrame:
    """``host, seen, template``: hosts with at least ``least`` pages, how many, and the hashes of
    the blocks on ``share`` of them."""
    pages = blocks.select("host", F.array_distinct(_hashed("blocks")).alias("hashes"))
    # The page itself is counted as a block that no text has.
    each = F.explode(F.concat(F.array(F.lit(None).cast("long")), F.col("hashes"))).alias("block")
    counts = pages.select("host", each).groupBy("host", "block").agg(F.count("*").alias("times"))
    seen = counts.where(F.col("block").isNull()).select("host", F.col("times").alias("seen"))
    often = counts.where(F.col("block").isNotNull() & (F.col("times") >= least)).join(
        seen.where(F.col("seen") >= least), "host"
    )
    listed = (
        often.where(F.col("times") >= F.col("seen") * share)
        .groupBy("host")
        .agg(F.collect_list("block").alias("template"))
    )
    return seen.where(F.col("seen") >= least).join(listed, "host", "left")


def site_articles(pages: DataFrame, share: float = SHARE, least: int = PAGES) -> DataFrame:
    """``url, story, by_site``: each page's prose without its host's template, paragraphs on lines
    of their own; ``by_site`` is false where the host has too few pages to tell.

    Nothing is left of a page that is all template: its story is empty. A page without host, or
    that cannot be read, is taken by itself, and repeated rows count as pages of their own.
    """
    host = host_of(F.col("url"))
    blocks = stored(page_blocks(pages, own=False).withColumn("host", host))
    known = stored(templates(blocks.where(F.col("host").isNotNull()), share, least))
    salt = F.pmod(F.xxhash64("url"), F.lit(SALTS)).alias("salt")
    spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    met = blocks.select("*", salt).join(spread, ["host", "salt"])
    template = F.coalesce("template", F.array().cast("array<bigint>"))

    def prose(block: Column) -> Column:
        size = F.char_length(block["text"])
        return (size >= PROSE) & (block["linked"] <= size * LINKED) & ~F.array_contains(template, F.xxhash64(block["text"]))

    left = F.array_join(F.transform(F.filter("blocks", prose), lambda b: b["text"]), "\n")
    # Only the pages of hosts without a template are read a second time.
    alone = pages.select("url", "html", host.alias("host"), salt).join(spread, ["host", "salt"], "left_anti")
    story = F.coalesce("own", F.lit("")).alias("story")
    return met.select("url", left.alias("story"), F.lit(True).alias("by_site")).unionByName(
        page_blocks(alone).select("url", story, F.lit(False).alias("by_site"))
    )
