"""Order and numbers: O1-O3.

One source, search or day may hold a large part of all articles, so no step
gathers a group in one task. Articles are range partitioned on the whole sort key,
which splits even a single day evenly; each partition counts its own rows, and only
those counts are added up across partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.session import checkpointed

#: Counts that every task may be sent, of four short columns each.
_BROADCAST_ROWS = 500_000
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def order_articles(
    df: DataFrame,
    batch: tuple[str, ...] = ("source", "query"),
    date: str = "date",
    pos: str = "pos",
) -> DataFrame:
    """O1: articles of a batch by date text, ties in input order.

    The sort holds across partitions and inside them. It comes before the costly
    text work, which then runs on evenly sized partitions and is not repeated when
    the range bounds are sampled. The number of parts is the session's, and adaptive
    execution may join neighbours that came out small.
    """
    key = [*batch, date, pos]
    return df.repartitionByRange(*key).sortWithinPartitions(*key)


def number_ordered(
    df: DataFrame,
    batch: tuple[str, ...] = ("source", "query"),
    broadcast_rows: int = _BROADCAST_ROWS,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """O2: ``article_no`` 1.. within each batch of an ordered table, or on from ``last`` of its
    row in ``ledger``.

    Row ids are written down once, so the counts and the numbers taken from them
    always speak of the same partitions. Making the plan runs that much already: the
    range sampling, the rows and their counts, below ``spark.checkpoint.dir``.

    There are as many counts as partitions and batches. Where they are too many to be
    sent to every task, the join shuffles the rows, and they are put in order again.
    """
    rows = checkpointed(df.withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", _ROW_BITS)
    runs = rows.groupBy(*batch, part.alias("_part")).agg(
        F.min("_row").alias("_first"), F.count("*").alias("_n")
    )
    before = (
        Window.partitionBy(*batch).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most one row per batch and partition, written down so that it can be counted.
    earlier = F.coalesce(F.sum("_n").over(before), F.lit(0))
    runs = runs.select(
        *[F.col(c).alias(f"_{c}") for c in batch],
        "_part",
        (F.col("_first") - earlier - 1).alias("_base"),
    )
    if ledger is not None:
        given = ledger.select(*[F.col(c).alias(f"_of_{c}") for c in batch], F.col("last").alias("_last"))
        alike = reduce(Column.__and__, [F.col(f"_{c}").eqNullSafe(F.col(f"_of_{c}")) for c in batch])
        base = F.col("_base") - F.coalesce("_last", F.lit(0))
        runs = runs.join(given, alike, "left").select(*[f"_{c}" for c in batch], "_part", base.alias("_base"))
    runs = checkpointed(runs)
    stays = runs.count() <= broadcast_rows
    if stays:
        runs = F.broadcast(runs)
    same = F.col("_part") == part
    for c in batch:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = rows.join(runs, same).select(
        *df.columns, (F.col("_row") - F.col("_base")).alias("article_no")
    )
    order = [*batch, "article_no"]
    return out if stays else out.repartitionByRange(*order).sortWithinPartitions(*order)


def number_articles(
    df: DataFrame,
    batch: tuple[str, ...] = ("source", "query"),
    date: str = "date",
    pos: str = "pos",
) -> DataFrame:
    """O1, O2: order and number in one go."""
    return number_ordered(order_articles(df, batch, date, pos), batch)


def explode_sentences(df: DataFrame) -> DataFrame:
    """O3: one row per sentence, numbered from 1 within its article."""
    keep = [c for c in df.columns if c != "sentences"]
    return df.select(*keep, F.posexplode("sentences").alias("_at", "sentence")).select(
        *keep, (F.col("_at") + 1).alias("sentence_no"), "sentence"
    )
