"""Connected components of an edge table, by alternating star contractions.

Each round hangs a node's larger neighbours on its smallest one (large star), then its smaller
neighbours and itself (small star); both are one window-free aggregation and one join on
the node.  The number of edges never grows, paths shrink by at least a constant factor, so
the rounds are logarithmic in the length of the longest path.  Every round is checkpointed in
the shared folder, and the one before it removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.operators.checkpoints import cut, drop


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v in, edges of the same kind out."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    hung = both.join(least, "u")
    if large:
        new = hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return new.where(F.col("u") > F.col("v")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b of one orderable type); the component is its least node.

    Loops and repeated edges are fine; null ends are left out; no edges give no rows.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    now = cut(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    sign = None
    for _ in range(max_rounds):
        before, now = now, cut(_star(_star(now, large=True), large=False))
        drop(before)
        new_sign = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20))).alias("s")).first()
        if new_sign == sign:
            break
        sign = new_sign
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
