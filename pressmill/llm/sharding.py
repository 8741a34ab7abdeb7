"""Sharding by longest processing time: groups of equal texts, largest first, go to the
least loaded shard through a heap.

The heap sees a bounded number of items whatever the corpus holds. While there are more,
the items are cut into parts by hash and every part packs its own into bundles, again
longest first through a heap; the bundles are the next items. A part's smallest items
stay single, so the last choices of the final heap can still even out the loads.
Groups that alone are a noticeable share of a shard are never bundled: there can only be
``shards * giants`` of them.

Cases: a null text is empty and has size 1. Equal texts share a shard, so one group with
over a sixteenth of all bytes makes its shard that large; the others even out among
themselves. Repeated rows are documents of their own. An empty table gives an empty
result. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import numbered, stage, text_or_empty

SHARDS = 16


class Limits(NamedTuple):
    """Sizes of the work; they must make fewer items of many."""

    #: A group of at least a ``shards * giants``-th of all bytes goes to the last heap alone.
    giants: int = 1000
    #: Items in a part, bundles made of them, and smallest items that stay single.
    part_items: int = 50_000
    bundles: int = 1_000
    singles: int = 200
    #: Items that the last heap may see besides the giants.
    heap_items: int = 100_000


def longest_first(sizes: Iterable[int], bins: int) -> list[int]:
    """Bin of each size; ``sizes`` must fall. Ties go to the lower bin."""
    heap = [(0, k) for k in range(bins)]
    out = []
    for size in sizes:
        load, k = heap[0]
        heapq.heapreplace(heap, (load + size, k))
        out.append(k)
    return out


def _bundled(limits: Limits):
    def run(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["bytes", "item"], ascending=[False, True])
        many = max(0, len(items) - limits.singles)
        bundle = np.arange(len(items)) - many + limits.bundles
        bundle[:many] = longest_first(items["bytes"].head(many).tolist(), limits.bundles)
        name = [f"{p}-{b}" for p, b in zip(items["part"], bundle, strict=True)]
        return pd.DataFrame({"item": items["item"], "bundle": name, "bytes": items["bytes"]})

    return run


def assign_groups(items: DataFrame, shards: int = SHARDS, limits: Limits = Limits()) -> DataFrame:
    """``item string, bytes long`` with distinct items -> ``item, shard``."""
    spark = items.sparkSession
    items = stage(items)
    total = items.agg(F.sum("bytes")).first()[0] or 0
    giant = F.col("bytes") * (shards * limits.giants) >= F.lit(total)
    chain, heads, rest = [], items.where(giant), items.where(~giant)
    while (n := rest.count()) > limits.heap_items:
        parts = -(-n // limits.part_items)
        split = rest.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
        bundles = stage(
            split.groupBy("part").applyInPandas(
                _bundled(limits), "item string, bundle string, bytes long"
            )
        )
        chain.append(bundles.select("item", "bundle"))
        rest = stage(
            bundles.groupBy("bundle").agg(F.sum("bytes").alias("bytes"))
            .select(F.col("bundle").alias("item"), "bytes")
        )
    last = [(r["item"], r["bytes"]) for r in heads.unionByName(rest).collect()]  # bounded, see above
    last.sort(key=lambda x: (-x[1], x[0]))
    placed = longest_first((b for _, b in last), shards)
    out = _table(spark, [(i, s) for (i, _), s in zip(last, placed, strict=True)])
    for step in reversed(chain):
        below = step.join(out.withColumnRenamed("item", "bundle"), "bundle").select("item", "shard")
        out = below.unionByName(out.join(heads.select("item"), "item", "left_semi"))
    return out


def _table(spark: SparkSession, rows: list[tuple[str, int]]) -> DataFrame:
    frame = pd.DataFrame(rows, columns=["item", "shard"]).astype({"item": str, "shard": "int32"})
    return spark.createDataFrame(frame, "item string, shard int")


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, limits: Limits = Limits()
) -> DataFrame:
    """Every document with size, checksum, shard and gapless slot in its shard."""
    text = text_or_empty()
    rows = stage(
        docs.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.sha2(text, 256).alias("item"),
        )
    )
    groups = rows.groupBy("item").agg(F.sum("size").alias("bytes"))
    placed = stage(rows.join(assign_groups(groups, shards, limits), "item").drop("item"))
    return numbered(placed, ["shard"], [F.col("doc_id"), F.col("row")], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
