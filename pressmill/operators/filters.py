"""Article filters: F2-F11."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.rules import is_kept, reject_rule
from pressmill.functions.sentences import (
    HOLLYWOOD,
    keep_sentences,
    split_sentences,
    strip_lead_dateline,
)
from pressmill.functions.text import strip_boilerplate, to_ascii
from pressmill.session import computed_once

_RAW = ("source", "url", "title", "content")


def keep_articles(articles: DataFrame) -> DataFrame:
    """Drop articles by their source's rules, on raw text."""
    return articles.where(is_kept(*[F.col(c) for c in _RAW]))


def rejection_counts(articles: DataFrame) -> DataFrame:
    """How many articles each rule drops; ``kept`` counts the rest."""
    rule = F.coalesce(reject_rule(*[F.col(c) for c in _RAW]), F.lit("kept"))
    return articles.groupBy("source", rule.alias("rule")).agg(F.count("*").alias("articles"))


def clean_articles(articles: DataFrame) -> DataFrame:
    """ASCII title and content, content without boilerplate."""
    return articles.withColumns(
        {
            "title": to_ascii(F.col("title")),
            "content": strip_boilerplate(to_ascii(F.col("content"))),
        }
    )


def split_articles(articles: DataFrame) -> DataFrame:
    """Replace ``content`` by the array ``sentences``.

    The filters below must not make Spark split twice.
    """
    rest = [c for c in articles.columns if c != "content"]
    sentences = keep_sentences(split_sentences(F.col("content")))
    return (
        computed_once(articles.select(*rest, sentences.alias("sentences")))
        .where(F.size("sentences") > 0)
        .where(~F.contains(F.get(F.col("sentences"), F.lit(0)), F.lit(HOLLYWOOD)))
        .withColumn("sentences", strip_lead_dateline(F.col("sentences")))
    )
