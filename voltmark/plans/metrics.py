"""Metric layer: declared measures over the star model, sliced by dimension columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmark.functions import display_number, has_value, safe_divide
from voltmark.registry import table

ColumnRef = tuple[str, str]  # (table, column)


@dataclass(frozen=True)
class ModelTable:
    """A table of the model. Hidden columns serve joins and measures but not reports."""

    name: str
    hidden: frozenset[str] = frozenset()
    categories: Mapping[str, str] | None = None

    @property
    def columns(self) -> list[str]:
        return table(self.name).columns


@dataclass(frozen=True)
class Relationship:
    """Many-to-one: ``many.many_column`` refers to ``one.one_column``, a key."""

    many: str
    many_column: str
    one: str
    one_column: str
    active: bool = True


@dataclass(frozen=True)
class Measure:
    """``kind`` is sum, avg or count over the rows of ``table``, or ratio of two other measures."""

    name: str
    table: str
    kind: str
    column: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    number_format: str = "#,##0.00"


@dataclass(frozen=True)
class StarModel:
    tables: Mapping[str, ModelTable]
    relationships: Sequence[Relationship]
    measures: Mapping[str, Measure]

    def measure(self, name: str) -> Measure:
        """Only declared measures can be asked for."""
        if name not in self.measures:
            raise ValueError(f"unknown measure {name!r}; declared: {', '.join(self.measures)}")
        return self.measures[name]

    def base_measures(self, name: str) -> list[Measure]:
        """The sums, averages and counts a measure is made of."""
        measure = self.measure(name)
        if measure.kind != "ratio":
            return [measure]
        return self.base_measures(measure.numerator) + self.base_measures(measure.denominator)

    def relationship(self, many: str, one: str) -> Relationship:
        """The declared relationship between two tables, active or not."""
        return next(r for r in self.relationships if (r.many, r.one) == (many, one))

    def path(self, start: str, target: str, use: Sequence[Relationship] = ()) -> list[Relationship] | None:
        """The relationships from ``start`` to ``target``, many side to one side; None if there are none.

        Active relationships count, and those in ``use``. With several paths, the one through a
        relationship in ``use`` is taken; still several is an error.
        """
        found = list(self._paths(start, target, use, ()))
        if len(found) > 1:
            found = [p for p in found if any(r in use for r in p)] or found
        if len(found) > 1:
            raise ValueError(f"ambiguous paths from {start} to {target}")
        return found[0] if found else None

    def _paths(self, start, target, use, seen):
        if start == target:
            yield []
            return
        for step in self.relationships:
            if step.many == start and step.one not in seen and (step.active or step in use):
                for rest in self._paths(step.one, target, use, (*seen, start)):
                    yield [step, *rest]


def _by_name(items):
    return {item.name: item for item in items}


# The tables, relationships and measures of the energy model.
ENERGY_MODEL = StarModel(
    tables=_by_name(
        [
            ModelTable("dim_region", frozenset({"region_id"})),
            ModelTable(
                "dim_site",
                frozenset(
                    {"site_id", "region_id", "region", "total_energy_kwh", "total_energy_cost", "total_co2_kg"}
                ),
                {"latitude": "Latitude", "longitude": "Longitude", "country": "Country"},
            ),
            ModelTable("dim_device", frozenset({"device_id", "site_id"})),
            ModelTable("fact_energy_consumption", frozenset({"reading_id", "device_id", "site_id"})),
            ModelTable("fact_energy_cost", frozenset({"cost_id", "site_id"})),
        ]
    ),
    relationships=(
        Relationship("dim_site", "region_id", "dim_region", "region_id"),
        # Inactive: readings reach their site directly, a second way would be ambiguous.
        Relationship("dim_device", "site_id", "dim_site", "site_id", active=False),
        Relationship("fact_energy_consumption", "site_id", "dim_site", "site_id"),
        Relationship("fact_energy_consumption", "device_id", "dim_device", "device_id"),
        Relationship("fact_energy_cost", "site_id", "dim_site", "site_id"),
    ),
    measures=_by_name(
        [
            Measure("Total Energy Cost", "fact_energy_cost", "sum", "energy_cost"),
            Measure("Total CO2 (kg)", "fact_energy_cost", "sum", "co2_emissions_kg", number_format="#,##0"),
            # Billed cost and emissions over metered energy.
            Measure(
                "Cost per kWh",
                "fact_energy_cost",
                "ratio",
                numerator="Total Energy Cost",
                denominator="Total Energy (kWh)",
                number_format="#,##0.000",
            ),
            Measure(
                "CO2 Intensity (kg/kWh)",
                "fact_energy_cost",
                "ratio",
                numerator="Total CO2 (kg)",
                denominator="Total Energy (kWh)",
                number_format="#,##0.000",
            ),
            Measure("Total Energy (kWh)", "fact_energy_consumption", "sum", "energy_kwh"),
            Measure("Avg Power Factor", "fact_energy_consumption", "avg", "power_factor"),
            Measure("Site Count", "dim_site", "count", number_format="#,##0"),
        ]
    ),
)


def report_table(tables: Mapping[str, DataFrame], name: str, model: StarModel = ENERGY_MODEL) -> DataFrame:
    """The columns of a table that reports may use, tagged with their geographic category if any."""
    spec = model.tables[name]
    categories = spec.categories or {}
    visible = [c for c in spec.columns if c not in spec.hidden]
    return tables[name].select(
        *[F.col(c).alias(c, metadata={"category": categories[c]} if c in categories else {}) for c in visible]
    )


def metrics(
    tables: Mapping[str, DataFrame],
    measures: Sequence[str],
    by: Sequence[ColumnRef] = (),
    where: Mapping[ColumnRef, Sequence] | None = None,
    use_relationship: Sequence[Relationship] = (),
    on_unreachable: str = "repeat",
    allow_hidden: bool = False,
    model: StarModel = ENERGY_MODEL,
) -> DataFrame:
    """Measures by ``by``, one row per group, over rows where each ``where`` column has one of its values.

    A column of a table that a measure's own table does not lead to cannot slice or filter the
    measure: its value repeats over that column (``on_unreachable="error"`` refuses instead). Rows
    that refer to no dimension member form a group of nulls, which ``where`` asks for with None. Groups
    where every measure is null are left out.

    Rows are the groups of the measures that reach all slicers. A measure that reaches some repeats over
    the groups that share them, and a group only it has is a row with nulls for the others. With a measure that
    reaches none, and so repeats its total, members of each sliced table that no row has are rows too, again with
    nulls for the others. Slicers on several tables need one measure that reaches them all.

    Each fact is first summed per foreign key, so joins carry one row per key instead of one per
    fact row and a key with a third of the rows is one row too. Facts meet in unions and one last
    ``groupBy``, never in a join with each other.
    """
    if on_unreachable not in ("repeat", "error"):
        raise ValueError("on_unreachable is 'repeat' or 'error'")
    if not measures:
        raise ValueError("no measures asked for")
    where = dict(where or {})
    names = _slicer_names(model, by, where, allow_hidden)
    base = list({m.name: m for name in measures for m in model.base_measures(name)}.values())
    homes = list(dict.fromkeys(m.table for m in base))
    reach = {home: [ref for ref in by if model.path(home, ref[0], use_relationship) is not None] for home in homes}
    if on_unreachable == "error":
        for home in homes:
            for ref in (*by, *where):
                if model.path(home, ref[0], use_relationship) is None:
                    raise ValueError(f"measures of {home} cannot be sliced by {ref[0]}.{ref[1]}")

    def measured(owners):
        return [m for m in base if m.table in owners]

    keys = [names[ref] for ref in by]
    sliced = list(dict.fromkeys(ref[0] for ref in by))
    together = _same_way(model, homes, reach, where, use_relationship)
    whole = [owners for owners in together if len(reach[owners[0]]) == len(by)]
    partial = [owners for owners in together if len(reach[owners[0]]) < len(by)]

    def branch(owners):
        return _branch(tables, model, owners, base, reach[owners[0]], where, names, use_relationship)

    def members(owner):
        own = [ref for ref in by if ref[0] == owner]
        return _members(tables, model, owner, own, where, names, use_relationship)

    if whole:
        rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), map(branch, whole))
        sums = [c for owners in whole for c in _partials(measured(owners))]
        groups = rows.groupBy(*keys).agg(*[F.sum(f"`{c}`").alias(c) for c in sums])
    elif len(sliced) == 1:
        groups = members(sliced[0])
    else:
        raise ValueError(f"no measure asked for relates {' and '.join(sliced)}; add one that does")
    some = [owners for owners in partial if reach[owners[0]]]
    none = [owners for owners in partial if not reach[owners[0]]]
    for owners in some:
        reached = [names[ref] for ref in reach[owners[0]]]
        groups = _attach(groups, branch(owners), _partials(measured(owners)), reached)
    for owner in sliced if none and whole else ():
        groups = _with_members(groups, members(owner))
    for owners in none:
        groups = _attach(groups, branch(owners), _partials(measured(owners)), [])

    result = groups.select(*keys, *[_value(model, name).alias(name) for name in measures])
    if not by:
        return result
    return result.filter(reduce(lambda a, b: a | b, [F.col(f"`{name}`").isNotNull() for name in measures]))


def formatted(result: DataFrame, model: StarModel = ENERGY_MODEL) -> DataFrame:
    """Measure columns of a result as display text."""
    return result.select(
        *[
            display_number(F.col(f"`{c}`"), model.measures[c].number_format).alias(c)
            if c in model.measures
            else F.col(f"`{c}`")
            for c in result.columns
        ]
    )


def _slicer_names(model, by, where, allow_hidden) -> dict[ColumnRef, str]:
    """Output name per slicer: the column's name, with its table's in front where two would clash."""
    refs = list(dict.fromkeys((*by, *where)))
    for owner, column in refs:
        if owner not in model.tables or column not in model.tables[owner].columns:
            raise ValueError(f"no column {owner}.{column} in the model")
        if column in model.tables[owner].hidden and not allow_hidden:
            raise ValueError(f"column {owner}.{column} is hidden; pass allow_hidden=True to use it")
    columns = [column for _, column in refs]
    return {
        (owner, column): column if columns.count(column) == 1 else f"{owner}_{column}" for owner, column in refs
    }


def _sum_column(measure: Measure) -> str:
    return f"{measure.name}|sum"


def _count_column(measure: Measure) -> str:
    return f"{measure.name}|count"


def _partials(measures: Sequence[Measure]) -> list[str]:
    """Columns that add up over rows and make the measures: a sum, a count, or both for averages."""
    columns = []
    for m in measures:
        if m.kind in ("sum", "avg"):
            columns.append(_sum_column(m))
        if m.kind in ("count", "avg"):
            columns.append(_count_column(m))
    return columns


def _aggregates(measures: Sequence[Measure]) -> list[Column]:
    """The same columns computed from rows. No row, or no value, gives null."""
    aggregates = {}
    for m in measures:
        if m.kind in ("sum", "avg"):
            aggregates[_sum_column(m)] = F.sum(m.column)
        if m.kind in ("count", "avg"):
            aggregates[_count_column(m)] = F.count(m.column if m.column else F.lit(1))
    return [aggregates[c].alias(c) for c in _partials(measures)]


def _value(model: StarModel, name: str) -> Column:
    m = model.measure(name)
    if m.kind == "ratio":
        return safe_divide(_value(model, m.numerator), _value(model, m.denominator))
    total = F.col(f"`{_sum_column(m)}`")
    count = F.col(f"`{_count_column(m)}`")
    if m.kind == "avg":
        return safe_divide(total, count)
    return total if m.kind == "sum" else F.when(count > 0, count)


def _filters(model, home, where, use) -> dict[ColumnRef, Sequence]:
    """The filters that reach a table; the others leave its measures alone."""
    return {ref: values for ref, values in where.items() if model.path(home, ref[0], use) is not None}


def _same_way(model, homes, reach, where, use) -> list[list[str]]:
    """Tables grouped so that each group reaches the same slicers and filters by the same dimensions.

    Their sums per foreign key can share one set of joins.
    """
    groups: dict[tuple, list[str]] = {}
    for home in homes:
        refs = (*reach[home], *_filters(model, home, where, use))
        own = home if any(ref[0] == home for ref in refs) else None
        ways = [tuple((s.one, s.one_column) for s in model.path(home, ref[0], use)) for ref in refs]
        groups.setdefault((own, refs, tuple(ways)), []).append(home)
    return list(groups.values())


def _branch(tables, model, homes, base, slicers, where, names, use) -> DataFrame:
    """Partial sums of some tables' measures with the slicers they reach, not yet one row per group.

    Filters come first, those by a dimension as a semi-join with its keys. Rows of each table are then summed per foreign
    key (and own slicer) before dimensions are joined, and tables that reach them the same way are joined as one.
    """
    lead = homes[0]
    remote = [ref for ref in slicers if ref[0] != lead]
    summed = []
    for home in homes:
        rows = tables[home]
        for (owner, column), values in _filters(model, home, where, use).items():
            if owner == home:
                rows = rows.filter(has_value(F.col(f"`{column}`"), values))
            else:
                rows = _of_members(rows, tables, model.path(home, owner, use), column, values)
        first_steps = [model.path(home, ref[0], use)[0] for ref in remote]
        grain = {names[ref]: ref[1] for ref in slicers if ref[0] == home}
        grain |= {_link(step, home): step.many_column for step in first_steps}
        summed.append(
            rows.groupBy(*[F.col(f"`{column}`").alias(name) for name, column in grain.items()]).agg(
                *_aggregates([m for m in base if m.table == home])
            )
        )
    together = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), summed)
    joined = _join_dimensions(together, tables, lead, [model.path(lead, ref[0], use) for ref in remote], remote, names)
    partials = _partials([m for m in base if m.table in homes])
    return joined.select(*[F.col(f"`{names[ref]}`") for ref in slicers], *[F.col(f"`{c}`") for c in partials])


def _of_members(rows: DataFrame, tables, path: Sequence[Relationship], column: str, values: Sequence) -> DataFrame:
    """The rows whose member at the end of ``path`` has one of the values, before anything is summed.

    The keys of the first dimension that lead there become a semi-join, which Spark broadcasts if they are few. Where None
    is asked for, rows without member belong too, so the keys that lead to other values are taken away instead.
    """
    first, *rest = path
    columns = [*[step.many_column for step in rest], column]
    members = tables[first.one].select(F.col(f"`{first.one_column}`").alias("|key"), F.col(f"`{columns[0]}`").alias("|at"))
    for step, onward in zip(rest, columns[1:], strict=True):
        further = tables[step.one].select(F.col(f"`{step.one_column}`").alias("|one"), F.col(f"`{onward}`").alias("|next"))
        members = members.join(further, F.col("`|at`") == F.col("`|one`"), "left").select("`|key`", F.col("`|next`").alias("|at"))
    asked = F.coalesce(has_value(F.col("`|at`"), values), F.lit(False))
    without = any(v is None for v in values)
    keys = members.filter(~asked if without else asked).select("`|key`")
    return rows.join(keys, F.col(f"`{first.many_column}`") == F.col("`|key`"), "left_anti" if without else "left_semi")


def _link(step: Relationship, home: str) -> str:
    """Internal name of a foreign key on its way to a join; the same from every measured table."""
    return f"->{step.one}" if step.many == home else f"->{step.many}.{step.many_column}>{step.one}"


def _join_dimensions(rows, tables, home, paths, refs, names) -> DataFrame:
    """Left joins along the paths, every dimension once, with the slicer columns and onward keys it has."""
    steps = list(dict.fromkeys(step for path in paths for step in path))
    for step in steps:
        onward = {_link(s, home): s.many_column for s in steps if s.many == step.one}
        sliced = {names[ref]: ref[1] for ref, path in zip(refs, paths, strict=True) if path[-1] == step}
        link = _link(step, home)
        member = tables[step.one].select(
            F.col(f"`{step.one_column}`").alias(f"{link}!"),
            *[F.col(f"`{column}`").alias(name) for name, column in {**onward, **sliced}.items()],
        )
        rows = rows.join(member, F.col(f"`{link}`") == F.col(f"`{link}!`"), "left")
    return rows


def _members(tables, model, owner, own, where, names, use) -> DataFrame:
    """The distinct slicer values of a table itself, filtered as a measure on it would be."""
    counted = [Measure("", owner, "count")]
    rows = _branch(tables, model, [owner], counted, own, where, names, use)
    return rows.select(*[f"`{names[ref]}`" for ref in own]).distinct()


def _with_members(groups: DataFrame, members: DataFrame) -> DataFrame:
    """``groups`` and a row for each member that none of them has."""
    renamed = members.toDF(*[f"{c}!" for c in members.columns])
    taken = groups.select(*[f"`{c}`" for c in members.columns]).distinct()
    same = reduce(lambda a, b: a & b, [taken[c].eqNullSafe(renamed[f"{c}!"]) for c in members.columns])
    return groups.unionByName(renamed.join(taken, same, "left_anti").toDF(*members.columns), allowMissingColumns=True)


def _attach(groups: DataFrame, branch: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Add the values of a measure that reaches only ``keys`` of the slicers."""
    sums = [F.sum(f"`{c}`").alias(c) for c in columns]
    kept = [F.col(f"`{c}`") for c in groups.columns]
    if not keys:
        # One row whatever the data, fetched once as a scalar subquery.
        total = branch.agg(*sums).select(F.struct(*[F.col(f"`{c}`") for c in columns])).scalar()
        held = groups.withColumn("|total", total)
        return held.select(*kept, *[F.col("`|total`").getField(c).alias(c) for c in columns])
    values = branch.groupBy(*keys).agg(*sums).select(
        *[F.col(k).alias(f"{k}!") for k in keys], *[F.col(f"`{c}`") for c in columns]
    )
    same = reduce(lambda a, b: a & b, [groups[k].eqNullSafe(values[f"{k}!"]) for k in keys])
    found = [F.coalesce(f"`{c}`", f"`{c}!`").alias(c) if c in keys else F.col(f"`{c}`") for c in groups.columns]
    return groups.join(values, same, "full_outer").select(*found, *[F.col(f"`{c}`") for c in columns])
