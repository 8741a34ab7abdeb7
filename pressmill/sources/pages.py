"""Fetched pages: S2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressmill.sources.tables import read_table


def read_pages(spark: SparkSession, path: str, parts: int | None = None) -> DataFrame:
    """``url``, ``html``, and ``query`` and ``fetched`` (a timestamp) if stored;
    other columns are not read."""
    pages = read_table(spark, path, parts)
    return pages.select(*[c for c in ("url", "html", "query", "fetched") if c in pages.columns])
