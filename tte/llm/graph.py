"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.llm.common import drop_frame, small_side, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the edges (longs): ``root`` is the smallest node reachable.

    Each round gives every node the smallest of itself and its neighbours as parent, replaces the nodes
    of all edges by their parents and drops the edges that became loops; a parent that has a parent of its own
    stays connected by an edge to it. Only edges between different parents are left for the next round, so the
    table shrinks, and the rounds end when none is left: their number grows with the logarithm of the
    number of nodes. Then the parents of the rounds are followed, last round first. The minimum per
    node is pre-aggregated and joins of a node with many edges are split by the skew join. Tables are
    written between the rounds, so the lineage stays short and a lost executor costs one step."""
    now = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"), "cc-edges")
    rounds: list[DataFrame] = []
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")), "cc-parents")
        rounds.append(parent)
        of = small_side(parent)
        moved = now.join(of, "u").select(F.col("p").alias("x"), F.col("v").alias("u")).join(of, "u").select("x", F.col("p").alias("y"))
        above = parent.where("p <> u").select(F.col("p").alias("u")).distinct().join(of, "u").select(F.col("u").alias("x"), F.col("p").alias("y"))
        after = written(moved.unionByName(above).where("x <> y").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(), "cc-edges")
        drop_frame(now)
        now = after
    if not rounds:
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = rounds.pop()
    while rounds:
        later = small_side(written(found, "cc-roots")).select(F.col("u").alias("p"), F.col("p").alias("root"))
        found = rounds.pop().join(later, "p", "left").select("u", F.coalesce("root", "p").alias("p"))
    return found.select(F.col("u").alias("node"), F.col("p").alias("root"))
