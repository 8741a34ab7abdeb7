"""Session helpers: the shared folder for cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, the one the cluster names if any.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would not be visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="run-")
    sc.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    Keeps partitions and their order, so row ids given before stay true when an
    executor is lost later.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, without its order.

    Later readers take only the columns they need. The files are marked for deletion
    when the application ends: a read must find them after an executor was lost.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed before any later filter.

    Spark pushes a filter below the projection that makes its column and then
    computes the column twice. It does not push below a generator, so the row
    passes through a one-element ``explode``, which moves no data.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.explode(F.array(row)).alias("_row")).select("_row.*")


def prepare_workers(spark: SparkSession) -> None:
    """Make this package importable in Python workers when it was not submitted with
    ``--py-files`` or installed, once per session.

    Arrow batches are bounded by ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    sc = spark.sparkContext
    if getattr(sc, "_pressmill_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):  # else it runs from a zip that was submitted
        target = os.path.join(tempfile.mkdtemp(prefix="run-"), "pressmill")
        sc.addPyFile(
            shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
        )
    sc._pressmill_shipped = True
