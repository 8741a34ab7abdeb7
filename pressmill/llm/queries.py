"""The registered queries of this subpackage. Each gives its operator a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressmill.llm.bpe import digests
from pressmill.llm.collocations import mine_phrases
from pressmill.llm.common import table
from pressmill.llm.exact_dedup import exact_dedup
from pressmill.llm.fingerprints import compare_edits
from pressmill.llm.language_id import predict
from pressmill.llm.line_dedup import remove_wide_lines
from pressmill.llm.ngram_join import ngram_components
from pressmill.llm.packing import pack_documents
from pressmill.llm.periodic_runs import run_digests
from pressmill.llm.sharding import shard_documents
from pressmill.llm.substring_dedup import removed_passages
from pressmill.llm.token_counts import count_tokens
from pressmill.llm.toxicity import predict as predict_toxicity


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_passages(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_wide_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_token_counts,
        op3_substring_dedup,
        op4_ngram_join,
        op5_line_dedup,
        op6_sharding,
        op7_fingerprints,
        op8_language_id,
        op9_packing,
        op10_bpe,
        op11_periodic_runs,
        op12_toxicity,
        op13_phrases,
    )
}
