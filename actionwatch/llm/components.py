"""Connected components of a large edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _written_least(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node, written apart: the join with it then has an exchange on both sides, and Spark
    can split a node with very many edges over tasks."""
    return materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _written_least(both).select("u", F.least("m", "u").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _written_least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; the component is its least node.

    Each round is written to the shared folder, so lineage stays short and no executor's loss restarts the loop.
    Self-links and repeated edges are harmless. The number of rounds grows with the logarithm of the size.
    """
    edges = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges")
    state = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    # A node and its component, and the component's own node, from one scan and one exchange by node.
    both = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")), F.struct(F.col("v").alias("node"), F.col("v").alias("component")))
    return edges.select(F.explode(both).alias("member")).select("member.*").groupBy("node").agg(F.min("component").alias("component"))
