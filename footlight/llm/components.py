"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.operators.skew import lookup_join
from footlight.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over undirected edges (u, v).  Every node's lowest neighbour is a map-side combined minimum.

    Large-star hangs each larger neighbour of a node below the lowest of its neighbourhood; small-star does so for
    the node and its smaller neighbours.
    """
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    seen = edges.unionByName(back) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = materialise(
        seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"), F.count(F.lit(1)).alias("n")), "lowest"
    )
    hung = lookup_join(seen, lowest, ["u"], weight="n")
    if large:
        hung = hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        hung = hung.select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct(F.col("u").alias("u"), F.col("low").alias("v"))
        )))
    return hung.where(F.col("u") != F.col("v")).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from every node that has a link; other nodes are not listed.

    Null ends and loops are ignored.  The number of rounds grows with the logarithm of the longest path.  Each round's
    edges are written to the shared folder, so lineage stays short and a lost executor costs one round.
    """
    edges = links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where(F.col("u") > F.col("v")).select("u", "v")
    edges = materialise(edges.distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum("v")).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        edges = materialise(_star(materialise(_star(edges, True), "large_star"), False), "small_star")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
