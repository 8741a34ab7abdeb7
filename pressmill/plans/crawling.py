"""Fetched pages to links and to articles: the extraction jobs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.config import JobConfig
from pressmill.operators.extraction import articles_from_fields, extract_fields
from pressmill.operators.links import allow_domains, extract_links, new_links, wanted_links
from pressmill.schema import ARTICLE, REJECT
from pressmill.session import prepare_workers
from pressmill.sources.articles import write_articles
from pressmill.sources.pages import read_pages
from pressmill.sources.records import write_rejects


class Extracted(NamedTuple):
    articles: DataFrame
    rejects: DataFrame


def pages_to_links(
    pages: DataFrame, cfg: JobConfig = JobConfig(), seen: DataFrame | None = None
) -> DataFrame:
    """Links worth fetching: ``source`` and ``url``, each once, none already seen."""
    links = wanted_links(allow_domains(extract_links(pages)), cfg.start, cfg.end)
    return new_links(links, seen)


def split_complete(drafts: DataFrame) -> Extracted:
    """Finished articles on one side, rows with a reason on the other."""
    extra = [c for c in ("query",) if c in drafts.columns]
    return Extracted(
        drafts.where(F.col("reason").isNull()).select(*ARTICLE.names, *extra),
        drafts.where(F.col("reason").isNotNull())
        .withColumn("stage", F.lit("extract"))
        .select(*REJECT.names),
    )


def pages_to_articles(pages: DataFrame, cfg: JobConfig = JobConfig()) -> Extracted:
    """Articles of all known sources, and the pages that gave none."""
    return split_complete(articles_from_fields(extract_fields(pages), cfg))


def run_extraction(
    spark: SparkSession, path: str, out_dir: str, cfg: JobConfig = JobConfig()
) -> None:
    """Page table in, article JSON and reject files out.

    Pages are parsed once: the drafts are kept as a table that both outputs read.
    """
    prepare_workers(spark)
    drafts_path = f"{out_dir}/drafts"
    drafts = articles_from_fields(extract_fields(read_pages(spark, path)), cfg)
    drafts.write.mode("overwrite").parquet(drafts_path)
    articles, rejects = split_complete(spark.read.parquet(drafts_path))
    write_articles(articles, f"{out_dir}/articles", mode="overwrite")
    write_rejects(rejects, f"{out_dir}/rejects")
