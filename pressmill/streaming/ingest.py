"""Pages as they arrive: every extraction step is stateless, so the batch plan runs
unchanged on a stream. Only links need a memory, to be given out once. Numbering needs a whole
batch and stays a batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql import functions as F

from pressmill.config import JobConfig
from pressmill.operators.history import LinkHistory
from pressmill.operators.links import allow_domains, extract_links, wanted_links
from pressmill.plans.crawling import pages_to_articles
from pressmill.schema import FETCHED_PAGE, PAGE
from pressmill.session import prepare_workers


def stream_pages(spark: SparkSession, folder: str, fetched: bool = False) -> DataFrame:
    """S2 as a file stream, with the time of fetching if that is stored."""
    return spark.readStream.schema(FETCHED_PAGE if fetched else PAGE).parquet(folder)


def _links(pages: DataFrame, cfg: JobConfig, kept: tuple[str, ...] = ()) -> DataFrame:
    return wanted_links(allow_domains(extract_links(pages, kept=kept)), cfg.start, cfg.end)


def link_stream(
    pages: DataFrame, out_dir: str, checkpoint: str, cfg: JobConfig, remember: str = "30 days"
) -> DataStreamWriter:
    """L10 on a stream: links worth fetching, each given out once for as long as ``remember``.

    The state store holds the links of that time, by the pages' ``fetched``, and forgets
    them after it: its size is that of a window and not of the crawl. A page that comes later than
    that, by its own time, is not read. For a memory without end see :func:`history_stream`.
    """
    prepare_workers(pages.sparkSession)
    found = _links(pages.where(F.col("fetched").isNotNull()), cfg, ("fetched",))
    return (
        found.select("source", "url", "fetched")
        .withWatermark("fetched", remember)
        .dropDuplicatesWithinWatermark(["source", "url"])
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def history_stream(
    pages: DataFrame, history: LinkHistory, out_dir: str, checkpoint: str, cfg: JobConfig, name: str = "stream"
) -> DataStreamWriter:
    """L10 on a stream against a :class:`LinkHistory`: no link is given out twice, ever, and batch
    runs share the memory.

    Each batch is a run of the history, named after it, so a batch that is done again after a
    failure gives the links it gave before, and its output replaces itself.
    """
    prepare_workers(pages.sparkSession)

    def take(batch: DataFrame, number: int) -> None:
        fresh = history.admit(_links(batch, cfg), f"{name}-{number:09d}")
        fresh.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    return pages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)


def article_stream(pages: DataFrame, out_dir: str, checkpoint: str, cfg: JobConfig) -> DataStreamWriter:
    """S3 on a stream: complete articles appended as JSON per source and query."""
    prepare_workers(pages.sparkSession)
    articles = pages_to_articles(pages, cfg).articles
    if "query" not in articles.columns:
        articles = articles.withColumn("query", F.lit(""))
    return (
        articles.writeStream.format("json")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .partitionBy("source", "query")
        .outputMode("append")
    )


def reject_stream(pages: DataFrame, out_dir: str, checkpoint: str, cfg: JobConfig) -> DataStreamWriter:
    """S7 on a stream: pages that gave no article, with the reason. A query of its own,
    so that either can be restarted; it needs its own ``checkpoint``."""
    prepare_workers(pages.sparkSession)
    return (
        pages_to_articles(pages, cfg)
        .rejects.writeStream.format("csv")
        .option("sep", "\t")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
