"""Connected components of a graph given by its edges, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that can be reached.

    Each round sends every node to the least of itself and its neighbours and contracts the graph. The first round
    orders nodes by id, which ends stars at once; later rounds by a hash of their own, so that the nodes left fall by a
    constant factor whatever the shape. Every round's tables are written, so nothing is gathered and nothing is lost
    with an executor; joins on a node with many edges are left to adaptive execution, which splits them.
    """
    left = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        k = len(maps)
        rank = (lambda c: F.col(c)) if k == 0 else (lambda c, k=k: F.xxhash64(F.col(c), F.lit(k)))
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("b"))).alias("m"))
        own = F.struct(rank("a").alias("r"), F.col("a").alias("b"))
        parent = materialize(least.select(F.col("a").alias("node"), F.least("m", own)["b"].alias("up")), "parents")
        maps.append(parent)
        pa, pb = (parent.select(F.col("node").alias(c), F.col("up").alias(f"u{c}")) for c in "ab")
        moved = left.join(pa, "a").join(pb, "b").where("ua <> ub")
        left = materialize(moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = maps[-1].withColumnRenamed("up", "top")
    for m in reversed(maps[:-1]):
        root = m.join(root.select(F.col("node").alias("up"), "top"), "up", "left").select("node", F.coalesce("top", "up").alias("top"))
    root = materialize(root, "roots")
    least = root.groupBy("top").agg(F.min("node").alias("root"))
    return root.join(materialize(least, "least"), "top").select("node", "root")
