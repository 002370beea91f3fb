"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of ``edges (a long, b long)``; a component is named by its smallest node.

    Alternates two steps until only stars are left: every node links its larger neighbours to its smallest
    neighbour, then every node links its smaller neighbours to the smallest. Both keep components and end in stars around
    the smallest node, in a number of rounds that grows with the logarithm of the longest path. Minima are
    combined before the shuffle and edges meet them in a join, which adaptive execution splits where a node has
    very many edges. Each round is written to the shared folder, so a lost executor costs its tasks only.
    Nulls and loops link nothing; repeated edges count once; without edges the result is empty.
    """
    now = scratch.store(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not _stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.store(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (
            joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .where("a != b")
            .distinct()
        )
        after = scratch.store(small)
        scratch.drop(now, large)
        now = after
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node at most, and that node none."""
    centres = edges.select(F.col("b").alias("a")).distinct()
    return (
        edges.join(centres, "a", "left_semi").isEmpty() and edges.groupBy("a").count().where("count > 1").isEmpty()
    )


class Forest:
    """Components of linked pairs of numbered rows, with as few pairs as hold them together."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            # Each component joins the smallest one next to it, if that is smaller, by one pair.
            high, low = np.maximum(la, lb), np.minimum(la, lb)
            order = np.lexsort((low, high))
            first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
            parent = np.arange(len(self.label))
            parent[high[first]] = low[first]
            while (parent[parent] != parent).any():
                parent = parent[parent]
            self.label = parent[self.label]
            self.edges.append((a[first], b[first]))
