"""Links never seen before, with remembered history: L10 over many runs.

A history is a folder that grows by one version for every run:

    links/run=<run>     source, url by bucket, only the links that were new in this run
    bits/run=<run>      bitmaps of their hashes, in blocks, by bucket
    runs/<run>          written last: the version counts from here on

A run's links are first held against the bitmaps, which are joined block by block on the
cluster. A link whose bit is not set was never seen. Only links whose bit is set may have been,
and only for them the stored links are read, and only those of their buckets: most of the
history is never opened, and its bitmaps have one bit where a stored link has a whole URL.

A run is known by its name. Done again after a failure, it replaces what it left half done;
done again after it was finished, it gives the result it gave then. So it may be the batch of
a stream that is restarted.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.operators.links import new_links
from pressmill.session import stored

#: Positions of one bitmap of Spark's.
BLOCK_BITS = 1 << 15
_LINKS = "source string, url string, run string, bucket int"
_BITS = "block long, bits binary, run string, bucket int"


class HistoryShape(NamedTuple):
    """``buckets`` of stored links and ``bits`` in all. Fixed for a history: with 16 bits for each
    link that it will ever hold, some 6 of 100 new links are looked up in vain; with fewer, more."""

    buckets: int = 256
    bits: int = 1 << 32

    def place(self) -> Column:
        """Position of a link among all bits. Its hash is not cut from the one Spark deals rows by."""
        return F.pmod(F.xxhash64(F.lit("history"), "source", "url"), F.lit(self.bits))

    def bucket(self, place: Column) -> Column:
        return F.floor(place / F.lit(self.bits // self.buckets)).cast("int")


class LinkHistory:
    def __init__(self, spark: SparkSession, path: str, shape: HistoryShape = HistoryShape()) -> None:
        if shape.bits % (shape.buckets * BLOCK_BITS):
            raise ValueError("a bucket must hold whole blocks of bits")
        self.spark, self.path, self.shape = spark, path.rstrip("/"), shape

    # -- files ---------------------------------------------------------------

    def _at(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def runs(self) -> list[str]:
        """Names of the finished runs."""
        target, files = self._at("runs")
        if not files.exists(target):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(target))

    def _read(self, what: str, runs: list[str], schema: str) -> DataFrame:
        """The finished ``runs`` as one table. Runs and buckets are folders, so those that are not
        asked for are no input."""
        if not runs:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/{what}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/run={r}" for r in runs])

    def links(self, runs: list[str] | None = None) -> DataFrame:
        """All links seen in finished runs."""
        return self._read("links", self.runs() if runs is None else runs, _LINKS)

    # -- one run ---------------------------------------------------------------

    def maybe_seen(self, links: DataFrame, runs: list[str]) -> DataFrame:
        """``links`` (source, url) with ``place``, ``bucket`` and ``maybe``: its bit is set."""
        shape = self.shape
        placed = links.withColumn("place", shape.place()).withColumn("bucket", shape.bucket(F.col("place")))
        blocks = (
            self._read("bits", runs, _BITS)
            .groupBy("block")
            .agg(F.bitmap_or_agg("bits").alias("bits"))
        )
        at = F.pmod("place", F.lit(BLOCK_BITS)).cast("int")
        byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        isset = F.expr("getbit(octet, here)")
        return (
            placed.withColumn("block", F.floor(F.col("place") / BLOCK_BITS))
            .join(blocks, "block", "left")
            .withColumn("octet", byte)
            .withColumn("here", F.pmod(at, F.lit(8)))
            .withColumn("maybe", F.col("bits").isNotNull() & (isset == 1))
            .drop("bits", "block", "octet", "here")
        )

    def admit(self, links: DataFrame, run: str) -> DataFrame:
        """The links (``source``, ``url``) never seen in an earlier run, each once; the run
        remembers them. Rows without a source or URL are left out."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", run):
            raise ValueError("a run's name is a folder's name: letters, digits, _ and -")
        done = self.runs()
        if run not in done:
            known = links.where(F.col("source").isNotNull() & F.col("url").isNotNull())
            told = stored(self.maybe_seen(new_links(known), done))
            maybe = told.where("maybe").drop("maybe")
            # As many numbers as there are buckets at most. Named in the plan, they keep the
            # reader from the folders of all other buckets.
            buckets = [r.bucket for r in maybe.select("bucket").distinct().collect()]
            old = self.links(done).where(F.col("bucket").isin(buckets))
            fresh = told.where(~F.col("maybe")).drop("maybe").unionByName(
                maybe.join(old.select("source", "url"), ["source", "url"], "left_anti")
            )
            self._write(fresh, run)
        return self._read("links", [run], _LINKS).select("source", "url")

    def _write(self, fresh: DataFrame, run: str) -> None:
        def write(rows: DataFrame, what: str) -> None:
            by_bucket = rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
            by_bucket.parquet(f"{self.path}/{what}/run={run}")

        write(fresh.select("source", "url", "bucket"), "links")
        place = self.shape.place()
        written = self._read("links", [run], _LINKS).select(place.alias("place"), "bucket")
        # Spark's functions count positions from 1.
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits")
        write(written.groupBy("bucket", F.floor(F.col("place") / BLOCK_BITS).alias("block")).agg(bits), "bits")
        target, files = self._at(f"runs/{run}")
        files.create(target, True).close()
