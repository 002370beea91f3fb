"""The entity graph as stored tables: refreshed from silver, and walked without the tables it came from.

Nodes are partitioned by type, edges by relationship and bucketed by their source, so a hop reads the edges of one
relationship and does not shuffle them, however large they are; only the walk so far is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.plans.graph import ENERGY_GRAPH, EntityGraph, GraphSpec
from voltmark.sources.lake import Lake


def refresh_graph(lake: Lake, spec: GraphSpec = ENERGY_GRAPH) -> dict[str, int]:
    """Store all nodes and edges of the silver tables; returns the rows written by table.

    A refresh writes new versions and readers keep theirs, as with any table. Rows of a relationship and bucket are gathered
    for one writer; a bucket with much of the edges (a hub) is split over several. Nodes aren't shuffled: a task scans
    one table, and so has one type.
    """
    graph = EntityGraph(lake.bind(), spec)
    return {
        "graph_nodes": lake.overwrite("graph_nodes", graph.all_nodes(), gather=False),
        "graph_edges": lake.overwrite("graph_edges", graph.all_edges()),
    }


class StoredGraph:
    """The graph as the last refresh left it. Every call gives a lazy frame."""

    def __init__(self, lake: Lake, spec: GraphSpec = ENERGY_GRAPH):
        self.lake = lake
        self.spec = spec

    def nodes(self, *types: str) -> DataFrame:
        """``type, id, display_name`` of some types of entity (default: all)."""
        nodes = self.lake.read("graph_nodes")
        return nodes.filter(F.col("type").isin([self.spec.entity(t).name for t in types])) if types else nodes

    def edges(self, *rels: str) -> DataFrame:
        """``rel, src_type, src, dst_type, dst`` of some relationships (default: all)."""
        edges = self.lake.read("graph_edges")
        return edges.filter(F.col("rel").isin([self.spec.link(r).name for r in rels])) if rels else edges

    def sizes(self) -> DataFrame:
        """``kind, name, rows``: how many nodes of each type and edges of each relationship there are."""
        nodes = self.nodes().groupBy(F.lit("node").alias("kind"), F.col("type").alias("name"))
        edges = self.edges().groupBy(F.lit("edge").alias("kind"), F.col("rel").alias("name"))
        return nodes.agg(F.count(F.lit(1)).alias("rows")).unionByName(edges.agg(F.count(F.lit(1)).alias("rows")))

    def walk(self, path: Sequence[str], start: Sequence[str] | DataFrame | None = None) -> DataFrame:
        """Walks along relationships (``^name`` for the opposite direction): columns ``step_0``, ``step_1``, ... of ids.

        ``start`` gives the ids of the first entities, as values or as a frame of one column; ids that stand twice
        count once. Walks from few entities meet the edges in a broadcast join; others are shuffled by the id they have
        come to, into the buckets of the edges. The opposite direction has no buckets, so there edges are shuffled too.
        """
        if not path:
            raise ValueError("a walk needs at least one relationship")
        links = [self.spec.link(name) for name in path]
        for before, link in zip(links, links[1:], strict=False):
            if before.target != link.source:
                raise ValueError(f"{before.name} ends at {before.target}, {link.name} starts at {link.source}")
        walk = self._hop(links[0].name).toDF("step_0", "step_1")
        if start is not None:
            if not isinstance(start, DataFrame):
                start = self.lake.spark.createDataFrame([(i,) for i in start], "id string")
            # No distinct: its shuffle by another number of partitions would tempt Spark to shuffle the edges as well.
            walk = walk.join(start.toDF("start"), F.col("step_0") == F.col("start"), "left_semi")
        for k, link in enumerate(links[1:], start=2):
            hop = self._hop(link.name)
            walk = walk.join(hop, walk[f"step_{k - 1}"] == hop["src"]).select(*walk.columns, F.col("dst").alias(f"step_{k}"))
        return walk

    def _hop(self, name: str) -> DataFrame:
        edges = self.lake.read("graph_edges").filter(F.col("rel") == name.removeprefix("^"))
        ends = ("dst", "src") if name.startswith("^") else ("src", "dst")
        return edges.select(F.col(ends[0]).alias("src"), F.col(ends[1]).alias("dst"))
