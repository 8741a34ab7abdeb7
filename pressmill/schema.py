"""Table schemas. Stored text is string typed; dates become typed on parsing."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


#: An article as stored in JSON.
ARTICLE = T.StructType(_strings("url", "source", "title", "date", "dateScraped", "content"))

#: Fields the formatter cannot do without.
REQUIRED = ("url", "source", "title", "date", "content")

#: A fetched page.
PAGE = T.StructType(_strings("url", "html"))

#: A fetched page with the time it was fetched.
FETCHED_PAGE = T.StructType([*PAGE.fields, T.StructField("fetched", T.TimestampType())])

#: A link found on a result page.
LINK = T.StructType(
    _strings("source", "page_url")
    + [T.StructField("pos", T.IntegerType())]
    + _strings("link_kind", "url")
)

#: A row that could not be used, with the step that refused it.
REJECT = T.StructType(_strings("stage", "reason", "source", "title", "url"))

#: What the HTML step hands back to column expressions, per page.
PAGE_FIELDS = T.StructType(
    [
        T.StructField("title_nodes", T.ArrayType(T.StringType())),
        T.StructField("date_nodes", T.ArrayType(T.StringType())),
        T.StructField("body_nodes", T.ArrayType(T.StringType())),
    ]
    + _strings("body_text", "page_title")
)
