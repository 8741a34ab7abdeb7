"""The corpus pipeline: documents to packed training sequences.

Five stages, each over all that the one before kept. A stage gets the documents that were
written by its predecessor and returns a DataFrame; all but the last return the columns of
``documents``. Every stage takes null ids, languages and texts, repeated rows and empty
tables, as its operator describes.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm import exact_dedup, language_id, ngram_join, packing, substring_dedup
from pressmill.llm.common import BLANKS, StagedBy, row_key, table, text_or_empty
from pressmill.session import ensure_checkpoint_dir

#: An ambiguous document is rejected if its best language is no likelier than this. Texts in
#: two languages stay: each of the two is likelier.
DOUBTFUL = 0.35


def _only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` whose :func:`row_key` is in ``rows``; of rows that agree in everything, one."""
    keyed = docs.withColumn("_row", row_key(docs))
    chosen = keyed.join(rows.select(F.col("row").alias("_row")), "_row", "left_semi")
    return chosen.dropDuplicates(["_row"]).drop("_row")


_STEPS = StagedBy()


def _after_the_last(step):
    """``step``, which begins by deleting what the stage before it staged on its way: the
    result of that one has been written since. Other tables are left alone."""

    @functools.wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return _STEPS.step(spark, step, docs, sf_dir)

    return run_step


@_after_the_last
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    found = language_id.identify(docs, language_id.train(docs))
    known = F.col("lang_pred") != language_id.UNKNOWN
    doubtful = F.col("ambiguous") & (F.col("score") <= DOUBTFUL)
    return found.where(known & ~doubtful).select(*docs.columns)


@_after_the_last
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that stays of each group of equal texts."""
    found = exact_dedup.exact_dedup(docs.withColumn("_row", row_key(docs)), carried=("_row",))
    return _only(docs, found.where("kept").select(F.col("_row").alias("row")))


@_after_the_last
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of linked ones, and all without
    words."""
    found = ngram_join.representatives(docs, row_key(docs))
    blank = F.translate(text_or_empty(), BLANKS, "") == ""
    return _only(docs.where(~blank), found).unionByName(docs.where(blank))


@_after_the_last
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has."""
    cut = substring_dedup.cut_repeats(docs)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", length).select(*docs.columns)


@_after_the_last
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", keep_known_languages),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("best-fit packing", pack),
]

#: The classifier and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        step(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
