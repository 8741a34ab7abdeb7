"""Result pages to links: L1-L10."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pressmill.functions.html_nodes import Page
from pressmill.functions.urls import domain_of, host_of, resolve_url, url_date, url_year
from pressmill.operators.extraction import with_origin
from pressmill.operators.layouts import DOMAINS, LINK_RULES, LinkRule
from pressmill.session import computed_once

_HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""


def all_links(pages: DataFrame) -> DataFrame:
    """L1, L2, native form: every link of every page, resolved, in page order."""
    hrefs = F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))
    found = computed_once(pages.select(F.col("url").alias("page_url"), hrefs.alias("hrefs")))
    return found.select("page_url", F.posexplode("hrefs").alias("pos", "href")).select(
        "page_url", "pos", resolve_url(F.col("href"), F.col("page_url")).alias("url")
    )


def _page_links(rule: LinkRule, html: str) -> dict:
    try:
        page = Page(html)
    except Exception:  # noqa: BLE001 - an unreadable page has no links
        return {"article": [], "follow": []}
    found = page.values(rule.attr, rule.articles) if rule.attr else page.texts(rule.articles)
    return {
        "article": found,
        "follow": page.values("href", rule.follow) if rule.follow else [],
    }


def extract_links(
    pages: DataFrame, rules: dict[str, LinkRule] = LINK_RULES, kept: tuple[str, ...] = ()
) -> DataFrame:
    """Article and follow-up links by each source's selectors, with the ``kept``
    columns of their pages.

    Pages that must show a pager are checked before they are parsed.
    """
    tests = [
        (F.col("origin") == name) & F.col("html").rlike(rule.pager) if rule.pager
        else F.col("origin") == name
        for name, rule in rules.items()
    ]
    schema = T.StructType(
        [
            T.StructField("origin", T.StringType()),
            T.StructField("page_url", T.StringType()),
            T.StructField("article", T.ArrayType(T.StringType())),
            T.StructField("follow", T.ArrayType(T.StringType())),
            *(pages.schema[c] for c in kept),
        ]
    )
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {
                    "origin": row["origin"],
                    "page_url": row["url"],
                    **_page_links(rules[row["origin"]], row["html"] or ""),
                    **{c: row[c] for c in kept},
                }
                for row in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    read_pages = (
        with_origin(pages)
        .where(reduce(lambda a, b: a | b, tests))
        .select("origin", "url", "html", *kept)
        .mapInArrow(read, schema)
    )
    both = F.array(
        F.struct(F.lit("article").alias("link_kind"), F.col("article").alias("hrefs")),
        F.struct(F.lit("follow").alias("link_kind"), F.col("follow").alias("hrefs")),
    )
    links = computed_once(
        read_pages.select("origin", "page_url", *kept, F.inline(both))
        .select("origin", "page_url", *kept, "link_kind", F.posexplode("hrefs").alias("pos", "href"))
        .select(
            F.col("origin").alias("source"),
            "page_url",
            "pos",
            "link_kind",
            resolve_url(F.trim("href"), F.col("page_url")).alias("url"),
            *kept,
        )
    )
    patterns = {n: r.follow_pattern for n, r in rules.items() if r.follow_pattern}
    for name, pattern in patterns.items():
        links = links.where(
            ~((F.col("source") == name) & (F.col("link_kind") == "follow"))
            | F.col("url").rlike(pattern)
        )
    return links


def allow_domains(links: DataFrame, domains: dict[str, tuple[str, ...]] = DOMAINS) -> DataFrame:
    """L4: links that stay on their source's hosts or below them."""
    owner = F.create_map(*[F.lit(x) for s, ds in domains.items() for d in ds for x in (d, s)])
    hosts = tuple(d for ds in domains.values() for d in ds)
    return links.where(owner[domain_of(host_of(F.col("url")), hosts)] == F.col("source"))


def exclude_sections(links: DataFrame, rules: dict[str, LinkRule] = LINK_RULES) -> DataFrame:
    """Drop a source's article links into unwanted sections."""
    tests = [
        (F.col("source") == s) & F.contains(F.col("url"), F.lit(part))
        for s, rule in rules.items()
        for part in rule.exclude
    ]
    hit = reduce(lambda a, b: a | b, tests, F.lit(False))
    return links.where(~((F.col("link_kind") == "article") & hit))


def within_dates(links: DataFrame, start: str, end: str) -> DataFrame:
    """Add ``link_date`` and keep links dated in the window, ends included.

    A link without a date is dropped alone.
    """
    dated = links.withColumn("link_date", url_date(F.col("url")))
    return dated.where(
        F.col("link_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )


def within_years(links: DataFrame, first: int, last: int) -> DataFrame:
    """Keep links whose first four digits are a year in the range."""
    return links.where(url_year(F.col("url")).between(first, last))


def wanted_links(
    links: DataFrame, start: str, end: str, rules: dict[str, LinkRule] = LINK_RULES
) -> DataFrame:
    """L5-L8 together: each source's article links by its own date rule."""
    years = int(start[:4]), int(end[:4])
    by_date = [s for s, r in rules.items() if r.dated_by == "date"]
    by_year = [s for s, r in rules.items() if r.dated_by == "year"]
    link_date = url_date(F.col("url"))
    in_window = (
        F.when(F.col("link_kind") != "article", F.lit(True))
        .when(
            F.col("source").isin(by_date),
            F.coalesce(
                link_date.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False)
            ),
        )
        .when(
            F.col("source").isin(by_year),
            F.coalesce(url_year(F.col("url")).between(*years), F.lit(False)),
        )
        .otherwise(F.lit(True))
    )
    return exclude_sections(links, rules).withColumn("link_date", link_date).where(in_window)


def new_links(links: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Each URL of a source once, without those already ``seen``.

    Both sides are reduced to distinct keys first, map side, so a URL repeated on
    a third of all pages is one row before anything is shuffled.
    """
    fresh = links.select("source", "url").distinct()
    if seen is None:
        return fresh
    return fresh.join(seen.select("source", "url").distinct(), ["source", "url"], "left_anti")
