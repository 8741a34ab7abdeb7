"""Articles to numbered records: the formatter job."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressmill.config import JobConfig
from pressmill.functions.rules import is_kept
from pressmill.operators.filters import clean_articles, keep_articles, split_articles
from pressmill.operators.layouts import DOMAINS
from pressmill.operators.numbering import number_ordered, order_articles
from pressmill.session import computed_once, stored
from pressmill.sources.articles import read_articles, rejects_of, unspelled_of, usable, usable_row
from pressmill.sources.published import OUTPUTS, Published
from pressmill.sources.records import (
    index_records,
    lead_records,
    sentence_records,
    write_all,
    write_rejects,
    write_text,
)


class Formatted(NamedTuple):
    numbered: DataFrame
    rejects: DataFrame


def numbered_articles(
    articles: DataFrame, cfg: JobConfig = JobConfig(), ledger: DataFrame | None = None
) -> DataFrame:
    """Kept articles with ``sentences`` and ``article_no``, in output order. Numbers go on from
    ``ledger``, if there is one.

    One shuffle, on the sort key; cleaning and splitting run after it inside the
    sorted partitions, and their result is written once for all outputs.
    """
    kept = keep_articles(articles).select(
        *dict.fromkeys(("source", "query", *cfg.batch, "date", "pos", "url", "title", "content"))
    )
    ordered = order_articles(kept, cfg.batch)
    return number_ordered(split_articles(clean_articles(ordered)), cfg.batch, ledger=ledger)


def format_articles(
    articles: DataFrame, cfg: JobConfig = JobConfig(), ledger: DataFrame | None = None
) -> Formatted:
    """Numbered articles, and the rows that could not be used or lost characters."""
    good = usable(articles)
    return Formatted(
        numbered_articles(good, cfg, ledger),
        rejects_of(articles, "read").unionByName(unspelled_of(keep_articles(good), "clean")),
    )


def run_formatter(
    spark: SparkSession,
    path: str,
    out_dir: str,
    cfg: JobConfig = JobConfig(),
    lines: bool = False,
) -> None:
    """JSON articles in, lead, sentence, index and reject files out.

    The JSON is parsed once, to a column table that everything else reads.
    """
    articles = stored(read_articles(spark, path, lines))
    write_all(*format_articles(articles, cfg), out_dir)


def _counted(df: DataFrame, /, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df``, and its counts once it was written. Nothing is read for them: tasks count what
    passes. The writer must follow without a shuffle, so that a task done again counts once."""
    seen = Observation()
    return df.observe(seen, *[count.alias(name) for name, count in counts.items()]), seen


def publish_articles(
    articles: DataFrame, store: Published, run: str, cfg: JobConfig = JobConfig()
) -> dict[str, int]:
    """Format ``articles`` as one run of ``store`` and publish its outputs together.

    Returns the run's counts, in all and for each known source (``kept AP``): ``read`` rows are
    ``unusable``, ``dropped`` by a source's rules or ``kept``; ``numbered`` are those of the kept that
    have a sentence. The counts come from the run itself, and what each output was given is held
    against them before anything is published. A run that was published before is left as it is.
    """
    store.refresh()
    if run in store.runs:
        return store.counts(run)
    kept = is_kept(*[F.col(c) for c in ("source", "url", "title", "content")])
    fate = F.when(~usable_row(articles), "unusable").when(kept, "kept").otherwise("dropped")
    each = {
        f"{kind} {source}".strip(): F.count_if(
            (F.col("_fate") == kind if kind != "read" else F.lit(True))
            & (F.col("source") == source if source else F.lit(True))
        )
        for kind in ("read", "unusable", "dropped", "kept")
        for source in ("", *DOMAINS)
    }
    seen, read = _counted(computed_once(articles.withColumn("_fate", fate)), **each)
    rows = stored(seen.drop("_fate"))
    numbered, rejects = format_articles(rows, cfg, store.ledger())
    folder, given = store.folder(run), {}
    for output, make in zip(OUTPUTS, (lead_records, sentence_records, index_records)):
        records, given[output] = _counted(make(numbered), rows=F.count("*"))
        write_text(records, f"{folder}/{output}")
    refused, given["rejects"] = _counted(rejects, rows=F.count_if(F.col("stage") == "read"))
    write_rejects(refused, f"{folder}/rejects")
    store.write_ledger(numbered, cfg.batch, run)

    counts = dict(read.get)
    written = {output: seen.get["rows"] for output, seen in given.items()}
    whole = counts["read"] == counts["unusable"] + counts["dropped"] + counts["kept"]
    if not whole or written["lead"] != written["index"] or written["rejects"] != counts["unusable"]:
        raise RuntimeError(f"run {run} lost rows: {counts}, {written}")
    counts |= {"numbered": written["lead"], "sentences": written["sentences"]}
    store.publish(run, counts)
    return counts


def run_published(
    spark: SparkSession, path: str, out_dir: str, run: str, cfg: JobConfig = JobConfig(), lines: bool = False
) -> dict[str, int]:
    """JSON articles in, one more run of the published records in ``out_dir``."""
    return publish_articles(read_articles(spark, path, lines), Published(spark, out_dir), run, cfg)
