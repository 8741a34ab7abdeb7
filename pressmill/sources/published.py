"""Record files of many runs, each published whole: S4-S8, with O2's numbers over all of them.

    runs/<run>/lead, sentences, index, rejects     what a run writes
    runs/<run>/ledger                              the last number of every batch so far
    published/<number>                             a run and its counts; written last, renamed into place

Only what a file in ``published`` names exists for a reader: a run that fails on its way leaves the
outputs of the runs before it as they were. The ledger is published with the records, so the numbers
of a failed run are given out again, and a run done again after it was finished changes nothing.

Two runs that publish at once both aim at the same number; the later one is refused and has to be
done again, as it could not see the numbers of the other. That takes a store whose rename keeps what
is there, as HDFS's does.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OUTPUTS = ("lead", "sentences", "index")


class Published:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        #: What is published: run names and their counts, the oldest first.
        self.manifests: list[dict] = []
        self.refresh()

    def _at(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def refresh(self) -> None:
        """See what other applications have published since."""
        target, files = self._at("published")
        self.manifests = []
        if files.exists(target):
            told = self.spark.read.text(f"{self.path}/published", wholetext=True)
            self.manifests = sorted((json.loads(r.value) for r in told.collect()), key=lambda m: m["number"])

    @property
    def runs(self) -> list[str]:
        return [m["run"] for m in self.manifests]

    def counts(self, run: str) -> dict[str, int]:
        return next(m["counts"] for m in self.manifests if m["run"] == run)

    def folder(self, run: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_-]+", run):
            raise ValueError("a run's name is a folder's name: letters, digits, _ and -")
        return f"{self.path}/runs/{run}"

    def records(self, output: str, runs: list[str] | None = None) -> DataFrame:
        """Lines of one of the ``OUTPUTS``: ``run, source, query, value``, of all published runs or
        those named."""
        schema, parts = "value string, source string, query string", []
        for run in self.runs if runs is None else runs:
            if run not in self.runs:
                raise ValueError(f"run {run} is not published")
            if self.counts(run)["numbered"]:  # else its files hold nothing and name no source
                parts.append((run, f"{self.folder(run)}/{output}"))
        out = self.spark.createDataFrame([], f"run string, {schema}").select("run", "source", "query", "value")
        for run, path in parts:
            lines = self.spark.read.schema(schema).option("lineSep", "\n").text(path)
            out = out.unionByName(lines.select(F.lit(run).alias("run"), "source", "query", "value"))
        return out

    def ledger(self) -> DataFrame | None:
        """The batch columns and ``last``, the last number given out in each batch."""
        return self.spark.read.parquet(f"{self.folder(self.runs[-1])}/ledger") if self.manifests else None

    def write_ledger(self, numbered: DataFrame, batch: tuple[str, ...], run: str) -> None:
        last = numbered.groupBy(*batch).agg(F.max("article_no").alias("last"))
        before = self.ledger()
        if before is not None:
            last = last.unionByName(before).groupBy(*batch).agg(F.max("last").alias("last"))
        last.write.mode("overwrite").parquet(f"{self.folder(run)}/ledger")

    def publish(self, run: str, counts: dict[str, int]) -> None:
        """From here on readers see the run."""
        number = len(self.manifests) + 1
        manifest = {"number": number, "run": run, "counts": counts}
        draft, files = self._at(f"published/.{run}")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target, _ = self._at(f"published/{number:010d}")
        if files.exists(target) or not files.rename(draft, target):
            raise RuntimeError(f"another run was published meanwhile; do {run} again")
        self.manifests.append(manifest)
