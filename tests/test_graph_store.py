"""The materialised graph against the one over silver."""

import os

import pytest
from conftest import plan_of, rows_of
from test_plans import LARGE, session_settings

from voltmark import EntityGraph, Lake
from voltmark.plans.graph_store import StoredGraph, refresh_graph
from voltmark.registry import layer_tables


@pytest.fixture(scope="module")
def lake(spark, golden, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("graph")), buckets=3)
    for spec in layer_tables("silver"):
        lake.overwrite(spec.name, golden.read(spec.name))
    lake.counts = refresh_graph(lake)
    return lake


def test_what_is_stored(lake, golden):
    graph, stored = EntityGraph(golden.bind()), StoredGraph(lake)
    assert rows_of(stored.nodes()) == rows_of(graph.all_nodes())
    assert rows_of(stored.edges()) == rows_of(graph.all_edges())
    assert lake.counts == {"graph_nodes": graph.all_nodes().count(), "graph_edges": graph.all_edges().count()}
    assert rows_of(stored.nodes("Region", "Site")) == rows_of(graph.all_nodes().filter("type IN ('Region', 'Site')"))
    assert rows_of(stored.sizes())[0] == ("edge", "billedFor", 6)
    with pytest.raises(KeyError):
        stored.nodes("Nope")


def test_walks(lake, golden, spark):
    graph, stored = EntityGraph(golden.bind()), StoredGraph(lake)
    for path in (["hasDevice", "hasMaintenance", "performedBy"], ["^performedBy", "^hasMaintenance", "^hasDevice", "locatedIn"]):
        assert rows_of(stored.walk(path)) == rows_of(graph.traverse(path))
        starts = sorted({r[0] for r in rows_of(stored.walk(path))})[:1]
        assert rows_of(stored.walk(path, start=starts * 2)) == rows_of(graph.traverse(path, start=starts))
    frame = spark.createDataFrame([("mesa",), ("mesa",), (None,)], "x string")
    assert rows_of(stored.walk(["hasDevice"], start=frame)) == [("mesa", "m-4")]
    with pytest.raises(ValueError, match="ends at"):
        stored.walk(["hasDevice", "locatedIn"])
    with pytest.raises(ValueError, match="at least one"):
        stored.walk([])


def test_hops_shuffle_no_edges_and_read_one_relationship(lake, spark):
    with session_settings(spark, LARGE):
        plan = plan_of(StoredGraph(lake).walk(["hasDevice", "hasMaintenance"], start=["mesa"]))
        back = plan_of(StoredGraph(lake).walk(["^performedBy", "^hasMaintenance"]))
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    # The start is dealt into the buckets, and then the walk; the edges stay where they are.
    assert plan.count("Exchange hashpartitioning") == 2 and "hashpartitioning(src" not in plan
    assert "SelectedBucketsCount: 3 out of 3" in plan
    assert plan.count("PartitionFilters: [isnotnull(rel#") == 2 and "(rel#" in plan
    assert "Exchange hashpartitioning(src" in back  # the other direction has no buckets


def test_a_session_that_does_not_know_the_table_registers_it(lake, spark):
    expected = rows_of(StoredGraph(lake).edges())
    spark.sql(f"DROP TABLE {lake._catalog_name(lake.location('graph_edges'))}")
    assert rows_of(StoredGraph(lake).edges()) == expected
    with session_settings(spark, LARGE):
        assert "Bucketed: true" in plan_of(StoredGraph(lake).walk(["hasDevice", "hasMaintenance"]))


def test_refreshing_again(lake, spark):
    before = lake.location("graph_edges")
    lake.overwrite("dim_device", lake.read("dim_device").where("device_id <> 'm-4'"))
    reader = StoredGraph(lake).edges("hasDevice")
    assert refresh_graph(lake)["graph_edges"] == lake.counts["graph_edges"] - 1
    assert lake.location("graph_edges") != before and os.path.isdir(before)
    assert reader.count() == 6 and StoredGraph(lake).edges("hasDevice").count() == 5
    refresh_graph(lake)
    assert not os.path.isdir(before)
    with pytest.raises(ValueError, match="overwritten only"):
        lake.append("graph_edges", lake.read("graph_edges"))


def test_few_files(spark, golden, tmp_path):
    """A file for each relationship and bucket, however the rows were spread."""
    lake = Lake(spark, str(tmp_path), buckets=2)
    edges = EntityGraph(golden.bind()).all_edges()
    lake.overwrite("graph_edges", edges.repartition(11))
    files = [f for d, _, names in os.walk(lake.location("graph_edges")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 6


def test_nodes_are_stored_without_a_shuffle(spark, golden, tmp_path, monkeypatch):
    plans, save = {}, Lake._save

    def watched(lake, spec, rows, mode):
        plans[spec.name] = plan_of(rows)
        save(lake, spec, rows, mode)

    lake = Lake(spark, str(tmp_path), buckets=2)
    for spec in layer_tables("silver"):
        lake.overwrite(spec.name, golden.read(spec.name))
    monkeypatch.setattr(Lake, "_save", watched)
    counts = refresh_graph(lake)
    assert "Exchange" not in plans["graph_nodes"] and "Exchange" in plans["graph_edges"]
    assert counts["graph_nodes"] == StoredGraph(lake).nodes().count() == EntityGraph(golden.bind()).all_nodes().count()
    # A task has one type, so there is at most a file for each file of silver.
    written, silver = (
        [f for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
        for folder in (lake.location("graph_nodes"), f"{lake.root}/silver")
    )
    assert len(written) <= len(silver)
