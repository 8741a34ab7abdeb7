"""Article pages to articles: E0-E24.

One Arrow step reads each page with its source's selectors (E0-E4, E9, E11, E12);
everything after that is column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pressmill.config import JobConfig
from pressmill.functions import dates, datelines
from pressmill.functions.html_nodes import Page, Step
from pressmill.functions.text import space_out, squeeze_marks, squeeze_ws, strip
from pressmill.functions.urls import domain_of, host_of
from pressmill.operators.layouts import DOMAINS, LABELS, LAYOUTS, Layout
from pressmill.schema import PAGE_FIELDS
from pressmill.session import computed_once

_STAMP_LENGTH = 30
#: Pages whose fields are held as Python objects at once.
_PAGES = 64


def with_origin(pages: DataFrame) -> DataFrame:
    """Add ``origin``, the short name of the page's source; other hosts drop out."""
    sources = {d: name for name, domains in DOMAINS.items() for d in domains}
    by_domain = F.create_map(*[F.lit(x) for pair in sources.items() for x in pair])
    origin = by_domain[domain_of(host_of(F.col("url")), tuple(sources))]
    return pages.withColumn("origin", origin).where(F.col("origin").isNotNull())


def label(origin: Column) -> Column:
    """The source label written to articles."""
    return F.coalesce(
        *[F.when(origin == name, F.lit(text)) for name, text in LABELS.items()], origin
    )


# What a page says when it carries script-only media, and what is
# then cut from it.
_NEEDS_SCRIPT = "Please turn on JavaScript"
_CAPTION = r'<p class="caption"[^<]+'
_NOSCRIPT = r"(?s)<noscript>.*?</noscript>"


def drop_captions(origin: Column, html: Column) -> Column:
    """Cut captions and noscript blocks from pages with script-only media."""
    return F.when(
        (origin == "BBC") & F.contains(html, F.lit(_NEEDS_SCRIPT)),
        F.regexp_replace(F.regexp_replace(html, _CAPTION, ""), _NOSCRIPT, ""),
    ).otherwise(html)


# -- E0: the Arrow step ------------------------------------------------------


def _stamps(page: Page) -> list[str]:
    """E4 for pages without a date field: short texts that look like a time stamp."""
    texts: dict[int, list[str]] = {}
    for node, text in page.events:
        if text is not None:
            texts.setdefault(node, []).append(text)
    return [
        own[0]
        for _, own in sorted(texts.items())
        if ":" in own[0] and "-" in own[0] and any(len(t) < _STAMP_LENGTH for t in own)
    ]


def _read(page: Page, layout: Layout, title: list[str]) -> dict:
    body = page.texts(*layout.body) if layout.body else []
    fields = {
        "layout": layout.name,
        "title_nodes": title,
        "date_nodes": _stamps(page) if layout.stamp else page.texts(*layout.date),
        "body_nodes": body,
        "body_text": None,
        "page_title": "".join(page.texts((Step("//", ("title",)),))),
        "reason": None,
    }
    node = None
    if layout.main:
        node = page.main_node()
    elif layout.fragment and len(body) < 2:  # else its text would not be used
        found = page.find(layout.fragment)
        node = found[0] if found else None
        if node is not None and layout.around:
            node = page.nearest(node, layout.around)
    if node is not None:
        fields["body_text"] = page.plain_text(node)
    return fields


def _read_page(source: str, html: str) -> dict:
    """Fields by the first layout with a title; a page that cannot be read
    is reported, not raised."""
    try:
        page = Page(html)
        for layout in LAYOUTS[source]:
            if title := page.texts(*layout.title):
                break
        return _read(page, layout, title)
    except Exception as e:  # noqa: BLE001 - any broken page is one rejected row
        return {"layout": source, "reason": f"{type(e).__name__}: {e}"}


def extract_fields(pages: DataFrame) -> DataFrame:
    """Raw field texts of every page with a known source.

    Only ``url``, ``query`` and ``fetched`` if there are any, and ``html`` travel to Python.
    """
    keep = [c for c in ("url", "query", "fetched") if c in pages.columns]
    source = F.when(
        (F.col("origin") == "BBC") & ~F.contains(F.col("url"), F.lit("www.bbc.co.uk")),
        F.lit("BBC old"),
    ).otherwise(F.col("origin"))
    narrow = with_origin(pages).select(
        *keep,
        "origin",
        source.alias("variant"),
        drop_captions(F.col("origin"), F.col("html")).alias("html"),
    )
    schema = T.StructType(
        [narrow.schema[c] for c in keep]
        + [T.StructField(c, T.StringType()) for c in ("origin", "layout")]
        + PAGE_FIELDS.fields
        + [T.StructField("reason", T.StringType())]
    )
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _PAGES):
                rows = [
                    {**{c: row[c] for c in [*keep, "origin"]}, **_read_page(row["variant"], row["html"] or "")}
                    for row in batch.slice(k, _PAGES).to_pylist()
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return narrow.mapInArrow(read, schema)


# -- fields to columns -------------------------------------------------------


def _first(nodes: str) -> Column:
    return F.get(F.col(nodes), F.lit(0))


def _title() -> Column:
    """agencies' titles stay as they are, the others are trimmed."""
    layout = F.col("layout")
    joined = strip(F.array_join("title_nodes", ""))
    from_page = strip(F.substring_index(F.col("page_title"), "_", 1))
    return (
        F.when(layout.isin("AP", "Reuters", "UPI"), _first("title_nodes"))
        .when(layout == "XNA", F.when(joined != "", joined).otherwise(from_page))
        .otherwise(strip(_first("title_nodes")))
    )


def _published() -> Column:
    """The page's date line as a timestamp."""
    layout = F.col("layout")
    nodes = F.col("date_nodes")
    first = strip(_first("date_nodes"))
    # The date is the last text but one, or the only one.
    before_last = F.when(F.size(nodes) == 1, F.get(nodes, F.lit(0))).otherwise(
        F.try_element_at(nodes, F.lit(-2))
    )
    out = dates.parse_date(dates.clean_date_text(first, "BBC"), "BBC")  # both new layouts
    for name in ("AP", "BBC old", "Reuters", "UPI", "VOA", "XNA"):
        text = before_last if name == "UPI" else first
        out = F.when(
            layout == name, dates.parse_date(dates.clean_date_text(text, name), name)
        ).otherwise(out)
    return out


def _content(keywords: tuple[str, ...]) -> Column:
    """Body text by the rules of its source."""
    layout = F.col("layout")
    nodes, text = F.col("body_nodes"), F.col("body_text")
    joined = squeeze_ws(F.array_join(nodes, "\n"))
    squeezed = squeeze_ws(text)
    return (
        F.when(layout == "AP", squeezed)
        .when(
            layout == "BBC",
            F.when(F.size(nodes) > 1, joined).otherwise(space_out(text)),
        )
        .when(layout.isin("BBC inner", "BBC old"), joined)
        .when(
            layout == "Reuters",
            F.when(datelines.has_keyword(squeezed, keywords), datelines.cut_reuters(squeezed)),
        )
        .when(layout == "UPI", datelines.cut_upi(text))
        .when(layout == "VOA", squeeze_marks(text))
        .when(layout == "XNA", datelines.cut_xna(text))
    )


def complete(df: DataFrame) -> DataFrame:
    """Rows with a title, a date and content. Reuters content may be empty."""
    return computed_once(df).where(missing_field().isNull())


def missing_field() -> Column:
    """What keeps a row from being an article, NULL if nothing does."""
    no_content = F.col("content").isNull() | (
        (F.col("content") == "") & (F.col("source") != "Reuters")
    )
    return (
        F.when(F.col("title").isNull() | (F.col("title") == ""), F.lit("no title"))
        .when(F.col("date").isNull(), F.lit("no date"))
        .when(no_content, F.lit("no content"))
    )


def articles_from_fields(fields: DataFrame, cfg: JobConfig) -> DataFrame:
    """E1-E22 on extracted fields: one row per page, incomplete ones with a reason."""
    keep = [c for c in ("query",) if c in fields.columns]
    fetched = F.col("fetched") if "fetched" in fields.columns else F.lit(None).cast("timestamp")
    drafts = computed_once(fields.select(
        "url",
        fetched.alias("fetched"),
        *keep,
        label(F.col("origin")).alias("source"),
        _title().alias("title"),
        _published().alias("published"),
        _content(cfg.keywords).alias("content"),
        "reason",
    ))
    return drafts.select(
        "url",
        "source",
        *keep,
        "title",
        dates.render_date(F.col("published"), cfg.date_format).alias("date"),
        F.coalesce(dates.scraped_at(F.col("fetched")), dates.scraped_at()).alias("dateScraped"),
        "content",
        F.to_date("published").alias("published"),
        "reason",
    ).withColumn("reason", F.coalesce("reason", missing_field()))


# -- native form for simple pages --------------------------------------------

_SKIP = r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->"


def first_inner(html: Column, tag: str) -> Column:
    """Inner HTML of the first ``tag`` element that does not nest."""
    return F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)


# The entities that occur in running text.
_ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def inner_text(html: Column) -> Column:
    """E11, native form: block ends become newlines, tags go, entities are decoded."""
    c = F.regexp_replace(html, r"(?i)<br\b[^>]*>|</?(?:p|div|h[1-6]|li|ul|ol|tr)\b[^>]*>", "\n")
    c = F.regexp_replace(c, r"<[^>]*>", "")
    for entity, text in _ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(text))
    return c


def simple_articles(pages: DataFrame) -> DataFrame:
    """E1, E9, E11, E14 for pages with one ``h1`` and one ``article``, without Python."""
    html = F.regexp_replace("html", _SKIP, "")
    return pages.select("url", html.alias("html")).select(
        "url",
        strip(squeeze_ws(inner_text(first_inner(F.col("html"), "h1")))).alias("title"),
        strip(squeeze_ws(inner_text(first_inner(F.col("html"), "article")))).alias("content"),
    )

