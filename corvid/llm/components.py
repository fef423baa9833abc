"""Connected components of an undirected graph, in Spark.

Rounds of large-star and small-star steps: every round points each node's
larger neighbours, then its smaller ones, at the smallest node among them,
until each component is a star around its smallest node. A round is written
to the shared folder, so a lost executor costs one round at most; no edge or
label reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import written


def _digest(edges: DataFrame):
    """Count and order-free hash of an edge set (one row)."""
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def _smallest_neighbour(edges: DataFrame, label: str) -> DataFrame:
    # written, so that the join below is between two plain scans whose hot
    # nodes can be split at run time
    return written(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), label)


def star_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v; no nulls) to ``(node, root)`` rows, where root is the
    component's smallest node; nodes without edges don't appear."""
    edges = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    before = _digest(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_smallest_neighbour(both, "large"), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = written(large.where("u != v").distinct(), "large-star")
        found = _smallest_neighbour(large, "small")
        small = large.join(found, "u")
        edges = written(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(found.select("u", F.col("m").alias("v")))
                        .where("u != v").distinct(), "small-star")
        after = _digest(edges)
        if tuple(after) == tuple(before):
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
