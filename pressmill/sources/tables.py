"""Column tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, parts: int | None = None) -> DataFrame:
    """A Parquet table in the splits Spark makes of it.

    ``spark.sql.files.maxPartitionBytes`` sets how large those are. A single row group
    cannot be split; for such a table ``parts`` deals the rows out evenly.
    """
    table = spark.read.parquet(path)
    return table.repartition(parts) if parts else table
