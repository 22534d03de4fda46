"""Connected components by contraction, for graphs that fit no single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node that each node of an edge reaches.

    Every round gives each node its smallest neighbour as parent, shortens the way to it by one jump,
    and contracts the edges to parents, so each component loses half of its nodes or more. Minima are
    combined before the shuffle, so a node with very many edges is no task of its own. Rounds are cut
    by written tables. Loops and repeated edges do no harm, edges with a null end are left out, and no
    edges give an empty table.
    """
    ends = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    ends = cut_lineage(ends.where(F.col("a") < F.col("b")).distinct())
    labels = None
    while not ends.isEmpty():
        both = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")))
        far = near.select(F.col("a").alias("p"), F.col("p").alias("q"))
        parent = cut_lineage(near.join(far, "p").select("a", F.col("q").alias("p")))
        if labels is None:
            labels = parent.select(F.col("a").alias("node"), F.col("p").alias("component"))
        else:
            step = parent.select(F.col("a").alias("component"), "p")
            labels = cut_lineage(
                labels.join(step, "component", "left").select("node", F.coalesce("p", "component").alias("component"))
            )
        left = parent.select("a", F.col("p").alias("pa"))
        right = parent.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = ends.join(left, "a").join(right, "b").where("pa <> pb")
        ends = cut_lineage(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    if labels is None:
        kind = ends.schema["a"].dataType
        labels = ends.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("component"))
    return labels


class Forest:
    """Union-find over a few thousand items, with the edges that joined them."""

    def __init__(self, size: int):
        self.up = list(range(size))
        self.joined: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        self.joined.append((x, y))
        return True
