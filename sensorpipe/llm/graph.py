"""Connected components of a graph of any size, by stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorpipe.llm.spread import attach
from sensorpipe.session import drop_staged, staged


def _to_smallest(arcs: DataFrame) -> DataFrame:
    """For arcs (u, v): adds m, the smallest of u and all its v."""
    smallest = arcs.groupBy("u").agg(F.min("v").alias("m"))
    return attach(arcs, smallest, ["u"], F.col("v")).withColumn("m", F.least("u", "m"))


def _step(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star operation; edges (u, v) have u > v."""
    both = staged(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    large = _to_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
    down = staged(large)
    drop_staged(both)
    found = _to_smallest(down)
    small = found.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
    out = staged(small.filter("u > v").distinct())
    drop_staged(down)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that can be reached, itself included.

    Nodes are whole numbers; edges may repeat, in both directions, and lead from a node to itself. Each round replaces
    edges by edges to smaller nodes (large-star, small-star); the number of rounds grows with the logarithm of the
    longest path. Every round is written to the shared folder, which cuts the lineage, and the one before is deleted.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before = staged(pairs), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        after, before = _step(now), state
        drop_staged(now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
