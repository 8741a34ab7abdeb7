"""Reading, staging and numbering shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.session import ensure_checkpoint_dir, prepare_workers

#: What the word-level contracts call white space: 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Paths staged so far.
_STAGED: list[str] = []
#: Whether Spark deletes a query's shuffle files as soon as the query has ended.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _target(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back.

    The files are marked for deletion when the application ends: a later read must find
    them after an executor was lost. The shuffles that led to them go at once, as nothing
    but this write reads them.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    path = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    freed = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREED, freed)
    target, files = _target(spark, path)
    files.deleteOnExit(target)
    _STAGED.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def drop_stage(staged: DataFrame) -> None:
    """Delete what :func:`stage` wrote, once nothing reads it any more."""
    target, files = _target(staged.sparkSession, staged._staged)
    files.delete(target, True)


def free_driver(spark: SparkSession) -> None:
    """Let the driver give up what it holds of queries that are done, such as the tables it
    broadcast: it does so only once it collects its garbage, which it puts off while its heap
    can grow."""
    spark.sparkContext._jvm.System.gc()


class StagedBy:
    """What a step stages, until the next step begins and deletes it."""

    def __init__(self) -> None:
        self._made: list[str] = []

    def step(self, spark: SparkSession, function, *args) -> DataFrame:
        while self._made:
            target, files = _target(spark, self._made.pop())
            files.delete(target, True)
        _STAGED.clear()
        out = function(spark, *args)
        self._made = list(_STAGED)
        return out


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def id_rank(column: str = "doc_id") -> Column:
    """Falls as the id grows; null stands behind every id. For ``max`` of a struct."""
    return F.struct(F.col(column).isNotNull(), F.bitwise_not(F.col(column)))


def row_key(docs: DataFrame) -> Column:
    """64 bits for all that a row says; rows that agree in everything have the same."""
    columns = [F.col(c) for c in docs.columns]
    return F.xxhash64(*(c.isNull() for c in columns), *columns)


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 inside every group of ``keys``, however large a group is.

    A group is cut into salts by the hash of what orders it. A salt is numbered by
    itself and starts where the salts before it end, so no task sees a whole group.
    """
    salts = 4 * shuffle_parts(df.sparkSession)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = salted.groupBy(*keys, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.select(
        *keys, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*keys, "_salt").orderBy(*order)
    return (
        salted.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(starts, [*keys, "_salt"])
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_salt", "_inside", "_start")
    )
