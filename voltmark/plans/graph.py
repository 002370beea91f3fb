"""Entity graph: typed nodes and edges bound to the silver tables, and traversals over them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmark.functions import has_value, stable_id63, stable_uuid5
from voltmark.registry import TABLES


@dataclass(frozen=True)
class Entity:
    """A node type: the ``properties`` columns of one table, identified by ``key``."""

    name: str
    table: str
    key: str
    properties: tuple[str, ...]
    display: str | None = None

    @property
    def display_property(self) -> str:
        return self.display or self.key


@dataclass(frozen=True)
class Link:
    """An edge type: two columns of a table, one holding source keys and one target keys."""

    name: str
    source: str
    target: str
    table: str
    source_column: str
    target_column: str

    @property
    def reversed(self) -> Link:
        return Link(f"^{self.name}", self.target, self.source, self.table, self.target_column, self.source_column)


@dataclass(frozen=True)
class GraphSpec:
    entities: Mapping[str, Entity]
    links: Mapping[str, Link]

    def entity(self, name: str) -> Entity:
        if name not in self.entities:
            raise KeyError(f"unknown entity {name!r}; known: {', '.join(self.entities)}")
        return self.entities[name]

    def link(self, name: str) -> Link:
        """A link by name; ``^name`` is the same link from target to source."""
        plain = name.removeprefix("^")
        if plain not in self.links:
            raise KeyError(f"unknown link {plain!r}; known: {', '.join(self.links)}")
        return self.links[plain].reversed if name.startswith("^") else self.links[plain]

    def validate(self) -> None:
        """Keys and display columns are properties, and both ends of each link are entities."""
        for e in self.entities.values():
            absent = [c for c in (e.key, e.display_property) if c not in e.properties]
            if absent:
                raise ValueError(f"entity {e.name}: {absent} are not among its properties")
        for link in self.links.values():
            self.entity(link.source)
            self.entity(link.target)


def _by_name(items):
    return {item.name: item for item in items}


# The entities and relationships of the energy graph.
ENERGY_GRAPH = GraphSpec(
    entities=_by_name(
        [
            Entity("Region", "dim_region", "region_id", ("region_id", "region_code", "region_name"), "region_name"),
            Entity(
                "Site",
                "dim_site",
                "site_id",
                (
                    "site_id",
                    "site_name",
                    "country",
                    "region_id",
                    "site_type",
                    "contracted_power_kw",
                    "total_energy_kwh",
                    "total_energy_cost",
                    "total_co2_kg",
                ),
                "site_name",
            ),
            Entity(
                "Device",
                "dim_device",
                "device_id",
                ("device_id", "site_id", "device_type", "model", "measurement_unit", "is_active"),
            ),
            Entity(
                "EnergyReading",
                "fact_energy_consumption",
                "reading_id",
                ("reading_id", "device_id", "site_id", "timestamp", "energy_kwh", "active_power_kw", "power_factor"),
            ),
            Entity(
                "BillingRecord",
                "fact_energy_cost",
                "cost_id",
                ("cost_id", "site_id", "billing_period", "energy_cost", "co2_emissions_kg", "currency"),
            ),
            Entity(
                "Supplier",
                "dim_supplier",
                "supplier_id",
                ("supplier_id", "supplier_name", "supplier_type", "country"),
                "supplier_name",
            ),
            Entity(
                "MaintenanceEvent",
                "maintenance_event",
                "event_id",
                (
                    "event_id",
                    "device_id",
                    "site_id",
                    "supplier_id",
                    "event_date",
                    "event_type",
                    "downtime_hours",
                    "cost",
                    "description",
                ),
                "description",
            ),
        ]
    ),
    links=_by_name(
        [
            Link("locatedIn", "Site", "Region", "dim_site", "site_id", "region_id"),
            Link("hasDevice", "Site", "Device", "dim_device", "site_id", "device_id"),
            Link("produces", "Device", "EnergyReading", "fact_energy_consumption", "device_id", "reading_id"),
            Link("billedFor", "Site", "BillingRecord", "fact_energy_cost", "site_id", "cost_id"),
            Link("hasMaintenance", "Device", "MaintenanceEvent", "maintenance_event", "device_id", "event_id"),
            Link("performedBy", "MaintenanceEvent", "Supplier", "maintenance_event", "event_id", "supplier_id"),
        ]
    ),
)


class EntityGraph:
    """The graph ``spec`` describes, over ``tables``. Nothing is copied: every call gives a lazy frame."""

    def __init__(self, tables: Mapping[str, DataFrame], spec: GraphSpec = ENERGY_GRAPH):
        spec.validate()
        self.tables = tables
        self.spec = spec

    def _table(self, name: str) -> DataFrame:
        """A table of the graph, once it is known to have every column the spec binds."""
        df = self.tables[name]
        bound = [c for e in self.spec.entities.values() if e.table == name for c in e.properties]
        for link in self.spec.links.values():
            if link.table == name:
                bound += [link.source_column, link.target_column]
        absent = [c for c in dict.fromkeys(bound) if c not in df.columns]
        if absent:
            raise ValueError(f"table {name} has no columns {absent}")
        return df

    def entity(self, name: str) -> DataFrame:
        """The bound columns of an entity and the name it is shown by."""
        e = self.spec.entity(name)
        shown = F.col(e.display_property).cast("string").alias("display_name")
        return self._table(e.table).select(*e.properties, shown)

    def edges(self, name: str) -> DataFrame:
        """Distinct ``src``, ``dst`` pairs of a link with both ends present."""
        link = self.spec.link(name)
        pairs = self._table(link.table).select(
            F.col(link.source_column).alias("src"), F.col(link.target_column).alias("dst")
        )
        pairs = pairs.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        if self._is_key(link.table, link.source_column) or self._is_key(link.table, link.target_column):
            return pairs  # one end is the table's key: already distinct, no shuffle
        return pairs.distinct()

    def _is_key(self, name: str, column: str) -> bool:
        """Whether the column is the table's registered key, or of an entity bound to the table."""
        keyed = any(e.table == name and e.key == column for e in self.spec.entities.values())
        return keyed or (name in TABLES and TABLES[name].key == (column,))

    def all_nodes(self) -> DataFrame:
        """Every node in one frame: ``type``, ``id``, ``display_name``."""
        return _union(
            self.entity(e.name).select(
                F.lit(e.name).alias("type"), F.col(e.key).cast("string").alias("id"), "display_name"
            )
            for e in self.spec.entities.values()
        )

    def all_edges(self) -> DataFrame:
        """Every edge in one frame: ``rel``, ``src_type``, ``src``, ``dst_type``, ``dst``."""
        return _union(
            self.edges(link.name).select(
                F.lit(link.name).alias("rel"),
                F.lit(link.source).alias("src_type"),
                F.col("src").cast("string").alias("src"),
                F.lit(link.target).alias("dst_type"),
                F.col("dst").cast("string").alias("dst"),
            )
            for link in self.spec.links.values()
        )

    def traverse(
        self,
        path: Sequence[str],
        carry: Mapping[str, Sequence[str]] | None = None,
        start: Sequence | DataFrame | None = None,
        where: Mapping[str | int, Mapping[str, Sequence]] | None = None,
    ) -> DataFrame:
        """Follow links (``^name`` for the opposite direction) and return one row per walk.

        The columns are the key of each entity on the way and, for entities in ``carry``, further
        properties of theirs. A name that occurs twice gets the number of the step as suffix.

        ``start`` gives the ids of the first entities, as values or as a frame of one column. ``where`` keeps entities
        whose properties have one of the values (None asks for null), by entity, for each stop of that name, or by number of step.
        Then tables are reduced before they are joined: from the last restricted stop back, each keeps the rows that lead on to
        a row that is left, and from the first one on, those that one leads to. So no walk is begun that isn't in the result.

        A link stored in the table of one of its entities needs no edge join: the target's own row
        names its source, or the source's own row its target. So each hop of the energy graph is
        one equi-join, and skewed keys in it are split by adaptive execution.
        """
        carry, where = carry or {}, where or {}
        links, stops = self._path(path, [*carry, *(w for w in where if isinstance(w, str))])
        beyond = [w for w in where if not isinstance(w, str) and not 0 <= w < len(stops)]
        if beyond:
            raise ValueError(f"the path has steps 0 to {len(stops) - 1}, not {beyond}")
        steps = _reduced(self._steps(links, stops, carry, start, where))
        walk = steps[0].rows
        for before, step in zip(steps, steps[1:], strict=False):
            walk = _equi(walk, before.onward, step.rows, step.back)
        return walk.select(*self._output(stops, carry))

    def _steps(self, links, stops, carry, start, where) -> list[_Step]:
        """The tables along a path, in the order they are joined."""
        steps = []
        for i, name in enumerate(stops):
            e = self.spec.entity(name)
            link, onward = links[i - 1] if i else None, links[i] if i < len(links) else None
            back = f"{i}|{link.source_column if link and self._held_by(link) == 'target' else e.key}"
            if link and self._held_by(link) == "neither":
                edges = self.edges(link.name).select(F.col("src").alias(f"{i}<"), F.col("dst").alias(f"{i}>"))
                steps.append(_Step(edges, f"{i}<", f"{i}>"))
            asked = {**where.get(name, {}), **where.get(i, {})}
            rows = self._stop(i, name, carry, onward, extra=back.split("|", 1)[1], where=asked)
            leads = onward.target_column if onward and self._held_by(onward) == "source" else e.key
            if i == 0 and start is not None:
                rows = _of_ids(rows, f"0|{e.key}", start)
            steps.append(_Step(rows, back, f"{i}|{leads}", restricted=bool(asked) or (i == 0 and start is not None)))
        return steps

    def rollup(
        self, path: Sequence[str], measures: Mapping[str, str | None], by: Mapping[str, Sequence[str]]
    ) -> DataFrame:
        """Sums over the first entity of a path, by properties of the entities along it.

        ``measures`` names the sums: a numeric column of the first entity's table, or None for the number of its rows.
        Every link must lead from many to one and be stored with its source. Rows whose link ends nowhere
        are counted under nulls, so the groups add up to all rows.

        The first table is summed per outgoing key (and own property) before any hop, so it is shuffled
        once as partial sums, and hops carry one row per key however many rows a key has.
        """
        links, stops = self._path(path, by)
        for link in links:
            if not self._stored_with(link, self.spec.entity(link.source), link.source_column):
                raise ValueError(f"{link.name} does not lead from many to one")
        first = self.spec.entity(links[0].source)
        grain = dict.fromkeys([links[0].target_column, *by.get(first.name, ())])
        sums = [(F.sum(c) if c else F.count(F.lit(1))).alias(f"sum|{name}") for name, c in measures.items()]
        walk = self._table(first.table).groupBy(*[F.col(c).alias(f"0|{c}") for c in grain]).agg(*sums)
        for i, link in enumerate(links, start=1):
            walk = self._hop(walk, i, link, by, links[i] if i < len(links) else None, how="left")
        groups, taken = [], set()
        for i, name in enumerate(stops):
            for c in by.get(name, ()):
                groups.append(F.col(f"`{i}|{c}`").alias(f"{c}_{i}" if c in taken else c))
                taken.add(c)
        return walk.groupBy(*groups).agg(*[F.sum(f"`sum|{name}`").alias(name) for name in measures])

    def _path(self, path: Sequence[str], named: Iterable[str]) -> tuple[list[Link], list[str]]:
        """The links of a path and the entities along it."""
        if not path:
            raise ValueError("a traversal needs at least one link")
        links = [self.spec.link(name) for name in path]
        for previous, following in zip(links, links[1:], strict=False):
            if previous.target != following.source:
                raise ValueError(
                    f"{previous.name} ends at {previous.target}, {following.name} starts at {following.source}"
                )
        stops = [links[0].source, *[link.target for link in links]]
        unknown = [name for name in named if name not in stops]
        if unknown:
            raise ValueError(f"{unknown} are not on the path {stops}")
        return links, stops

    # Columns on the way are named "{step}|{property}".

    def _stop(
        self, i: int, name: str, carry, onward: Link | None, extra: str | None = None, where: Mapping[str, Sequence] | None = None
    ) -> DataFrame:
        """Key, carried properties and the column the next hop starts from, of one entity."""
        e = self.spec.entity(name)
        unknown = [c for c in where or {} if c not in e.properties]
        if unknown:
            raise ValueError(f"{name} has no properties {unknown}")
        columns = [e.key, *carry.get(name, ())]
        if onward and self._stored_with(onward, e, onward.source_column):
            columns.append(onward.target_column)
        if extra:
            columns.append(extra)
        rows = self._table(e.table)
        for column, values in (where or {}).items():
            rows = rows.filter(has_value(F.col(column), values))
        return rows.select(*[F.col(c).alias(f"{i}|{c}") for c in dict.fromkeys(columns)])

    def _stored_with(self, link: Link, e: Entity, column: str) -> bool:
        """Whether the link's table is the entity's own and ``column`` is its key there."""
        return link.table == e.table and column == e.key

    def _held_by(self, link: Link) -> str:
        """Which end of a link has the other's key in its own table."""
        if self._stored_with(link, self.spec.entity(link.target), link.target_column):
            return "target"
        return "source" if self._stored_with(link, self.spec.entity(link.source), link.source_column) else "neither"

    def _hop(self, walk: DataFrame, i: int, link: Link, carry, onward: Link | None, how: str = "inner") -> DataFrame:
        source, target = self.spec.entity(link.source), self.spec.entity(link.target)
        here, there = f"{i - 1}|{source.key}", f"{i}|{target.key}"
        if self._stored_with(link, target, link.target_column):
            stop = self._stop(i, target.name, carry, onward, extra=link.source_column)
            return _equi(walk, here, stop, f"{i}|{link.source_column}")
        stop = self._stop(i, target.name, carry, onward)
        if self._stored_with(link, source, link.source_column):
            return _equi(walk, f"{i - 1}|{link.target_column}", stop, there, how)
        edges = self.edges(link.name)
        return _equi(_equi(walk, here, edges, "src"), "dst", stop, there).drop("src", "dst")

    def _output(self, stops, carry):
        columns = []
        taken = set()
        for i, name in enumerate(stops):
            for c in dict.fromkeys((self.spec.entity(name).key, *carry.get(name, ()))):
                columns.append(F.col(f"`{i}|{c}`").alias(f"{c}_{i}" if c in taken else c))
                taken.add(c)
        return columns


@dataclass(frozen=True)
class _Step:
    """A table of a path: the columns it is joined by to the step before and to the next, and whether rows of it were
    left out on purpose."""

    rows: DataFrame
    back: str
    onward: str
    restricted: bool = False


def _reduced(steps: list[_Step]) -> list[_Step]:
    """The steps without rows that a restricted step rules out: semi-joins from the last one back and from the first one on."""
    restricted = [k for k, step in enumerate(steps) if step.restricted]
    if not restricted:
        return steps
    steps = list(steps)
    for k in range(restricted[-1] - 1, -1, -1):
        rows = _equi(steps[k].rows, steps[k].onward, steps[k + 1].rows.select(f"`{steps[k + 1].back}`"), steps[k + 1].back, "left_semi")
        steps[k] = replace(steps[k], rows=rows)
    for k in range(restricted[0] + 1, len(steps)):
        rows = _equi(steps[k].rows, steps[k].back, steps[k - 1].rows.select(f"`{steps[k - 1].onward}`"), steps[k - 1].onward, "left_semi")
        steps[k] = replace(steps[k], rows=rows)
    return steps


def _of_ids(rows: DataFrame, key: str, ids: Sequence | DataFrame) -> DataFrame:
    if not isinstance(ids, DataFrame):
        return rows.filter(F.col(f"`{key}`").isin(list(ids)))
    if len(ids.columns) != 1:
        raise ValueError("start ids are one column")
    return _equi(rows, key, ids.toDF("start!"), "start!", "left_semi")


def type_ids(spark: SparkSession, spec: GraphSpec = ENERGY_GRAPH) -> DataFrame:
    """Stable ids of the entity, property and link types, and of the bindings to tables."""
    rows = []
    for e in spec.entities.values():
        rows.append(("entity", e.name, None))
        rows += [("prop", e.name, p) for p in e.properties]
        rows.append(("binding", e.name, e.table))
    for link in spec.links.values():
        rows += [("rel", link.name, None), ("ctx", link.name, None)]
    named = spark.createDataFrame(rows, "kind string, name string, part string")
    parts = (F.col("kind"), F.col("name"))
    by_guid = F.col("kind").isin("binding", "ctx")
    return named.select(
        *parts,
        "part",
        F.when(~by_guid, F.coalesce(stable_id63(*parts, F.col("part")), stable_id63(*parts))).alias("id"),
        F.when(by_guid, F.coalesce(stable_uuid5(*parts, F.col("part")), stable_uuid5(*parts))).alias("guid"),
    )


def _union(frames) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)


def _equi(left: DataFrame, left_key: str, right: DataFrame, right_key: str, how: str = "inner") -> DataFrame:
    return left.join(right, F.col(f"`{left_key}`") == F.col(f"`{right_key}`"), how)
