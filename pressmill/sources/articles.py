"""Article readers and writers: S1, S3."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.functions.text import unspelled
from pressmill.schema import ARTICLE, REJECT, REQUIRED

_BROKEN = "_broken"


def read_articles(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Articles with ``pos``, their place in the input, and ``query``.

    ``path`` holds JSON arrays, one per file, or with ``lines`` one object per
    line as :func:`write_articles` leaves them. ``query`` is the partition folder
    or else the file name without its suffix. A file that is not JSON gives one
    row with ``reason`` set; it does not stop the run.
    """
    # Naming ``query`` here keeps a folder like query=007 text.
    schema = T.StructType(
        ARTICLE.fields
        + [T.StructField("query", T.StringType()), T.StructField(_BROKEN, T.StringType())]
    )
    rows = (
        spark.read.schema(schema)
        .option("multiLine", not lines)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN)
        .json(path)
    )
    in_folder = F.contains(F.col("_metadata.file_path"), F.lit("/query="))
    name = F.when(in_folder, F.lit("")).otherwise(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.json\z", "")
    )
    # A file's array is read by one task, front to back, and so is each split of a
    # line file: (file, split, row) is the input order whatever else the task reads.
    pos = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select(
        *[F.col(c) for c in ARTICLE.names],
        F.coalesce(F.col("query"), name).alias("query"),
        pos.alias("pos"),
        F.when(F.col(_BROKEN).isNotNull(), F.lit("not JSON")).alias("reason"),
    )


def missing_required() -> Column:
    """Name of the first required field a row lacks, NULL if it has all."""
    return F.coalesce(
        *[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in REQUIRED]
    )


def usable_row(articles: DataFrame) -> Column:
    """Whether the formatter can work on a row."""
    ok = missing_required().isNull()
    return ok & F.col("reason").isNull() if "reason" in articles.columns else ok


def usable(articles: DataFrame) -> DataFrame:
    """Rows the formatter can work on."""
    return articles.where(usable_row(articles))


def rejects_of(rows: DataFrame, stage: str) -> DataFrame:
    """Rows with a reason, in the shape of the reject table, with their place in the
    input where ``pos`` is known: file, start of its split, row."""
    reason = missing_required()
    if "reason" in rows.columns:
        reason = F.coalesce("reason", reason)
    known = "pos" in rows.columns and isinstance(rows.schema["pos"].dataType, T.StructType)
    place = F.concat_ws(":", "pos.file", "pos.split", "pos.row") if known else F.lit(None)
    out = rows.select(
        F.lit(stage).alias("stage"),
        reason.alias("reason"),
        *[F.col(c) for c in ("source", "title", "url")],
        place.cast("string").alias("place"),
    ).where(F.col("reason").isNotNull())
    return out.select(*REJECT.names, *(["place"] if known else []))


def unspelled_of(rows: DataFrame, stage: str) -> DataFrame:
    """Articles that lost characters nothing spells out, and how many."""
    lost = unspelled(F.col("title")) + unspelled(F.col("content"))
    reason = F.concat(lost.cast("string"), F.lit(" characters not spelled out"))
    return rejects_of(rows.withColumn("reason", F.when(lost > 0, reason)), stage)


def write_articles(articles: DataFrame, path: str, mode: str = "append") -> None:
    """S3: JSON objects, one folder per source and query.

    Rows are brought together by folder first, else every task would leave a small
    file in every folder. The hint lets Spark split a folder too large for a task.
    """
    if "query" not in articles.columns:
        articles = articles.withColumn("query", F.lit(""))
    (
        articles.select(*ARTICLE.names, "query")
        .hint("rebalance", "source", "query")
        .write.mode(mode)
        .partitionBy("source", "query")
        .json(path)
    )
