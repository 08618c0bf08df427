"""Connected components by large and small stars; no node's neighbours are gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rest_driver, written


def _lower(both: DataFrame, kept: str) -> DataFrame:
    """Each edge (u, v) with the least neighbour of u, itself included, as m, of those that are ``kept``.

    The least are written before they are joined: the edges then come by a plain shuffle, of which a hub is split.
    """
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), True)
    return both.join(least, "u").where(kept)


def components(edges: DataFrame) -> DataFrame:
    """(node, component), the least node reachable, for the nodes of ``edges`` (u, v)."""
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), True)
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lower(both, "v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _lower(large, "true")
        now = written(small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), True)
        # The stars no longer change once each node hangs from the least of its component.
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).head()
        if found == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = found
        rest_driver(now.sparkSession)
