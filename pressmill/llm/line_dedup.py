"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate and goes from every document. Its spread
is the number of distinct sites: HyperLogLog sketches per line hash, merged by
aggregation, so a line on every page is one sketch per task before it is shuffled. Where
the estimate is too near the threshold to trust, sites are counted exactly.

Cases: lines are compared without blanks at their ends; empty lines stay. A null site is
no site; a null text stays null. A document repeated with its id and text is treated alike
each time. An empty table gives an empty result. Columns of other names are kept, and
``n_lines`` and ``n_removed`` replace columns of that name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import BLANKS, stage

MIN_SITES = 10
#: Registers of a sketch are 2**LOG_REGISTERS; estimates within so many standard errors of
#: the threshold are counted again.
LOG_REGISTERS, DOUBT = 10, 4


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)))


def _keys(line: Column) -> list[Column]:
    """128 bits that stand for a line. The second hash starts from another seed: what follows the
    line would only hash the first once more."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit("line"), line).alias("k2")]


def wide_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Keys of the lines on at least ``min_sites`` sites."""
    lines = docs.select(F.col(site).alias("site"), F.explode(_lines(F.col("text"))).alias("line"))
    lines = lines.where("line <> '' AND site IS NOT NULL").select(*_keys(F.col("line")), "site")
    spread = lines.groupBy("k1", "k2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites")
    )
    doubt = DOUBT * 1.04 / math.sqrt(1 << LOG_REGISTERS) * min_sites
    spread = stage(spread.where(F.col("sites") >= min_sites - doubt))
    unsure = spread.where(F.abs(F.col("sites") - min_sites) <= doubt).select("k1", "k2")
    counted = (
        lines.join(unsure, ["k1", "k2"], "left_semi")
        .distinct()
        .groupBy("k1", "k2")
        .count()
        .where(F.col("count") >= min_sites)
    )
    sure = spread.where(F.col("sites") - min_sites > doubt)
    return stage(sure.select("k1", "k2").unionByName(counted.select("k1", "k2")))


def remove_wide_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` without boilerplate lines, and the numbers of lines before and removed."""
    docs = docs.drop("n_lines", "n_removed")
    wide = wide_lines(docs, site, min_sites)
    same = [F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")]
    at = docs.select(*same, F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    drops = (
        at.where("line <> ''")
        .select("id", "hash", "at", *_keys(F.col("line")))
        .join(wide, ["k1", "k2"], "left_semi")
        .groupBy("id", "hash")
        .agg(F.collect_set("at").alias("drops"))
    )
    # Told apart by their side: a document's own columns may have any name.
    here = F.col("doc.doc_id").eqNullSafe(F.col("gone.id")) & (F.xxhash64("doc.text") == F.col("gone.hash"))
    text, drop = F.col("doc.text"), F.col("gone.drops")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x, k: ~F.array_contains(drop, k))
    return docs.alias("doc").join(drops.alias("gone"), here, "left").select(
        *(F.col(f"doc.`{c}`") for c in docs.columns if c != "text"),
        F.when(drop.isNull(), text).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_removed"),
    )
