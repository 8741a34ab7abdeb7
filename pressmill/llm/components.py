"""Connected components by alternating large and small stars.

Edges are rewritten until every vertex hangs on the smallest one of its component. A
vertex with very many edges is never gathered: its smallest neighbour is a partial
aggregate, and the join that follows can be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import free_driver, stage


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges ``u, v`` with ``m``, the least of u and its neighbours."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    return edges.join(least, F.col("u") == F.col("_u")).select(
        "u", "v", F.least("u", "m").alias("m")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller vertex."""
    starred = _with_least(edges)
    return starred.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        starred.select("u", F.col("m").alias("v"))
    ).where("u <> v")


def _starred(edges: DataFrame) -> bool:
    """Whether every vertex hangs on one other, and that one on none."""
    ends = edges.select(F.col("u").alias("vertex"), F.lit(1).alias("hangs")).unionByName(
        edges.select(F.col("v").alias("vertex"), F.lit(0).alias("hangs"))
    )
    seen = ends.groupBy("vertex").agg(F.sum("hangs").alias("hangs"), F.count("*").alias("times"))
    return seen.where("hangs > 0 AND times > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links (u, v)`` -> ``vertex, component`` for every vertex but the least of its
    component."""
    down = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stage(down.distinct())
    while not _starred(edges):
        edges = stage(_small_star(_large_star(edges).distinct()).distinct())
        free_driver(edges.sparkSession)
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
