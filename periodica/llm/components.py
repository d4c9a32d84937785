"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import cut


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _joined(edges: DataFrame, lows: DataFrame) -> DataFrame:
    return edges.join(lows.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a")).drop("_a")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b): root is the smallest node it reaches.

    Each step links every neighbour to the smallest one: first neighbours larger
    than a node, then smaller ones. The table never exceeds the edges it began
    with, a hub is one joined row per neighbour, and each step is cut, so the
    driver sees only a count and a checksum.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e, last = cut(e), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == last:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        last = tuple(now)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = _joined(both, low).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = _joined(large, low).select(F.explode(F.array(
            F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        e = cut(small.select("e.*").filter("a <> b").distinct())
