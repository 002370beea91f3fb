import hashlib
import uuid

import pytest
from conftest import plan_of, rows_of

from voltmark import ENERGY_GRAPH, EntityGraph
from voltmark.plans.graph import Entity, GraphSpec, Link, type_ids


@pytest.fixture
def graph(golden):
    return EntityGraph(golden.bind())


def test_entities_have_their_bound_columns_and_a_name(graph):
    for name, e in ENERGY_GRAPH.entities.items():
        assert graph.entity(name).columns == [*e.properties, "display_name"]
    assert rows_of(graph.entity("Site"), "site_id", "display_name")[0] == ("mesa", "Mesa yard")
    assert rows_of(graph.entity("Device"), "device_id", "display_name")[0] == ("m-1", "m-1")
    with pytest.raises(KeyError):
        graph.entity("Nope")


def test_edges(graph):
    assert rows_of(graph.edges("hasDevice")) == [
        ("mesa", "m-4"),
        ("north-hall", "m-1"),
        ("north-hall", "m-2"),
        ("nowhere", "m-6"),
        ("quay", "m-3"),
        ("reef", "m-5"),
    ]
    assert rows_of(graph.edges("^hasDevice"))[0] == ("m-1", "north-hall")
    assert ("x4", None) not in rows_of(graph.edges("performedBy"))
    assert "Exchange" not in plan_of(graph.edges("produces"))  # distinct by the key of its table


def test_all_nodes(graph):
    nodes = rows_of(graph.all_nodes())
    assert len(nodes) == 3 + 5 + 6 + 9 + 6 + 2 + 5
    assert ("MaintenanceEvent", "x1", "relay") in nodes


def test_walk_to_suppliers(graph):
    walk = graph.traverse(["hasDevice", "hasMaintenance", "performedBy"], carry={"Supplier": ["supplier_name"]})
    assert walk.columns == ["site_id", "device_id", "event_id", "supplier_id", "supplier_name"]
    assert rows_of(walk) == [
        ("mesa", "m-4", "x3", "k7", "Kappa"),
        ("north-hall", "m-1", "x1", "k7", "Kappa"),
        ("north-hall", "m-1", "x2", "o2", "Omicron"),
    ]


def test_walks_from_some_entities(graph, spark):
    path = ["hasDevice", "hasMaintenance", "performedBy"]
    whole = graph.traverse(path).collect()
    assert len(whole) == 3
    for start in (["mesa", "quay", "gone"], spark.createDataFrame([("mesa",), ("quay",), ("mesa",), (None,)], "any string")):
        assert rows_of(graph.traverse(path, start=start)) == [("mesa", "m-4", "x3", "k7")]
    assert rows_of(graph.traverse(path, start=[])) == []
    where = {"Supplier": {"supplier_name": ["Omicron"]}}
    assert rows_of(graph.traverse(path, where=where)) == [("north-hall", "m-1", "x2", "o2")]
    assert rows_of(graph.traverse(path, start=["mesa"], where=where)) == []
    assert rows_of(graph.traverse(path, where={2: {"event_type": ["repair"]}}), "event_id") == [("x1",), ("x3",)]
    back = graph.traverse(["^hasDevice"], where={"Device": {"is_active": [None, False]}})
    assert rows_of(back, "device_id") == [("m-3",), ("m-5",)]
    # Both stops of a name that occurs twice, or one of them.
    twice = ["hasDevice", "^hasDevice", "hasDevice"]
    both = rows_of(graph.traverse(twice, where={"Device": {"device_type": ["water_meter"]}}), "device_id", "device_id_3")
    assert both == [("m-2", "m-2")]
    one = rows_of(graph.traverse(twice, where={3: {"device_type": ["water_meter"]}}), "device_id", "device_id_3")
    assert one == [("m-1", "m-2"), ("m-2", "m-2")]
    with pytest.raises(ValueError, match="not on the path"):
        graph.traverse(path, where={"Region": {"region_code": ["EMEA"]}})
    with pytest.raises(ValueError, match="no properties"):
        graph.traverse(path, where={"Supplier": {"nope": [1]}})
    with pytest.raises(ValueError, match="steps 0 to 3"):
        graph.traverse(path, where={4: {"supplier_name": ["x"]}})
    with pytest.raises(ValueError, match="one column"):
        graph.traverse(path, start=spark.createDataFrame([(1, 2)], "a int, b int"))


def test_walks_over_a_table_of_edges(spark):
    spec = GraphSpec(
        entities={n: Entity(n, n.lower(), "id", ("id", "kind")) for n in ("A", "B")},
        links={"to": Link("to", "A", "B", "ab", "a", "b")},
    )
    tables = {
        "a": spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, kind string"),
        "b": spark.createDataFrame([(7, "x"), (8, "y"), (9, None)], "id int, kind string"),
        "ab": spark.createDataFrame([(1, 7), (1, 8), (2, 8), (2, 8), (3, 9), (None, 9), (4, 7)], "a int, b int"),
    }
    graph = EntityGraph(tables, spec)
    assert rows_of(graph.traverse(["to"])) == [(1, 7), (1, 8), (2, 8), (3, 9)]
    assert rows_of(graph.traverse(["to"], start=[1, 4], where={"B": {"kind": ["y", None]}})) == [(1, 8)]
    assert rows_of(graph.traverse(["^to", "to"], start=[9], where={1: {"kind": [None]}})) == [(9, 3, 9)]


def test_walk_back_and_forth(graph):
    back = graph.traverse(["^performedBy", "^hasMaintenance", "^hasDevice", "locatedIn"], carry={"Region": ["region_code"]})
    assert rows_of(back, "supplier_id", "region_code") == [("k7", "AMER"), ("k7", "EMEA"), ("o2", "EMEA")]
    twice = graph.traverse(["hasDevice", "^hasDevice"])
    assert twice.columns == ["site_id", "device_id", "site_id_2"]
    assert len(rows_of(twice)) == 5 and all(r[0] == r[2] for r in rows_of(twice))


def test_a_hop_is_one_join(graph):
    plan = plan_of(graph.traverse(["hasDevice", "hasMaintenance", "performedBy"]))
    assert plan.count("Join ") == 3


def test_every_link_in_both_directions_equals_its_edges(graph):
    keys = {e.name: {r[0] for r in rows_of(graph.entity(e.name), e.key)} for e in ENERGY_GRAPH.entities.values()}
    for name, link in ENERGY_GRAPH.links.items():
        known = [e for e in rows_of(graph.edges(name)) if e[0] in keys[link.source] and e[1] in keys[link.target]]
        assert rows_of(graph.traverse([name])) == known
        assert rows_of(graph.traverse([f"^{name}"])) == sorted(((b, a) for a, b in known), key=repr)


def test_rollup(graph):
    by = {"EnergyReading": ["power_factor"], "Device": ["device_type"], "Region": ["region_code"]}
    got = graph.rollup(["^produces", "^hasDevice", "locatedIn"], {"n": None, "kwh": "energy_kwh"}, by)
    assert got.columns == ["power_factor", "device_type", "region_code", "n", "kwh"]
    assert rows_of(got.groupBy("region_code").agg({"n": "sum", "kwh": "sum"}).toDF("r", "n", "kwh"), "r", "n", "kwh") in (
        [("AMER", 1, 32.0), ("APAC", 1, 0.5), ("EMEA", 5, 36.0), (None, 2, 8.0)],
        [("AMER", 32.0, 1), ("APAC", 0.5, 1), ("EMEA", 36.0, 5), (None, 8.0, 2)],
    )
    with pytest.raises(ValueError, match="many to one"):
        graph.rollup(["hasDevice"], {"n": None}, {})


def test_a_rollup_sums_before_it_walks(graph):
    plan = plan_of(graph.rollup(["^produces", "^hasDevice", "locatedIn"], {"kwh": "energy_kwh"}, {"Region": ["region_name"]}))
    below = plan[plan.rindex("Join ") :]
    assert "partial_sum" in below and plan.count("energy_kwh:double") == 1


def test_bad_paths(graph):
    with pytest.raises(ValueError):
        graph.traverse([])
    with pytest.raises(ValueError, match="ends at"):
        graph.traverse(["hasDevice", "locatedIn"])
    with pytest.raises(ValueError, match="not on the path"):
        graph.traverse(["hasDevice"], carry={"Supplier": ["country"]})
    with pytest.raises(KeyError):
        graph.traverse(["nope"])


PEOPLE = GraphSpec(
    {"Person": Entity("Person", "person", "pid", ("pid", "name"), "name"), "Club": Entity("Club", "club", "cid", ("cid",))},
    {"memberOf": Link("memberOf", "Person", "Club", "membership", "p", "c")},
)


def test_link_in_a_table_of_its_own(spark):
    tables = {
        "person": spark.createDataFrame([(1, "a"), (2, "b")], "pid int, name string"),
        "club": spark.createDataFrame([("x",), ("y",)], "cid string"),
        "membership": spark.createDataFrame(
            [(1, "x"), (1, "x"), (2, "y"), (3, "x"), (1, None), (2, "z")], "p int, c string"
        ),
    }
    graph = EntityGraph(tables, PEOPLE)
    assert rows_of(graph.edges("memberOf")) == [(1, "x"), (2, "y"), (2, "z"), (3, "x")]
    assert rows_of(graph.traverse(["memberOf"], carry={"Person": ["name"]})) == [(1, "a", "x"), (2, "b", "y")]
    assert rows_of(graph.traverse(["^memberOf"], carry={"Person": ["name"]})) == [("x", 1, "a"), ("y", 2, "b")]


def test_spec_is_checked(golden):
    bad_key = GraphSpec({"A": Entity("A", "t", "id", ("other",))}, {})
    with pytest.raises(ValueError, match="not among its properties"):
        EntityGraph({}, bad_key)
    bad_end = GraphSpec({"A": Entity("A", "t", "id", ("id",))}, {"l": Link("l", "A", "B", "t", "id", "b")})
    with pytest.raises(KeyError):
        EntityGraph({}, bad_end)
    tables = golden.bind()
    tables["dim_site"] = tables["dim_site"].drop("site_name")
    with pytest.raises(ValueError, match="site_name"):
        EntityGraph(tables).entity("Site")


def test_type_ids(spark):
    rows = {(r.kind, r.name, r.part): r for r in type_ids(spark).collect()}
    properties = sum(len(e.properties) for e in ENERGY_GRAPH.entities.values())
    assert len(rows) == 7 + properties + 7 + 6 + 6
    digest = hashlib.sha256(b"prop::Site::country").digest()
    assert rows["prop", "Site", "country"].id == int.from_bytes(digest[:8], "big") & (2**63 - 1)
    assert rows["binding", "Site", "dim_site"].guid == str(uuid.uuid5(uuid.NAMESPACE_URL, "binding::Site::dim_site"))
    assert rows["ctx", "locatedIn", None].guid == str(uuid.uuid5(uuid.NAMESPACE_URL, "ctx::locatedIn"))
    assert len({r.id for r in rows.values() if r.id}) == 7 + properties + 6
