"""Runs that process what was landed since the last one, and leave the tables as a full run would.

A run knows how far the last one came: the last part of each bronze table it read, and the latest ingestion time
among the rows. It parses the new parts alone. Facts are merged by key: rows of a changed key go, wherever they lie, and the
surviving one comes. Of the readings, which are partitioned by day, only the days that lose or gain a row are read and written.

Sums are kept in small state tables: per site and day for readings, per site and period for bills, each with its
sum, the number of values and the number of rows. A group that changed is summed again from its facts, so that corrected and
moved rows, nulls and NaN need no subtraction. Site totals and gold are made of those sums, not of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.functions import safe_divide
from voltmark.plans import gold, silver
from voltmark.plans.medallion import bronze_to_silver
from voltmark.registry import INGESTED_AT, table
from voltmark.session import fine_scans
from voltmark.sources.lake import Lake

RAW = ("raw_site", "raw_device", "raw_meter_readings", "raw_billing")
#: Tables that a run must find as the last one left them.
_KEPT = (
    "dim_region",
    "dim_device",
    "dim_site",
    "fact_energy_consumption",
    "fact_energy_cost",
    "daily_state",
    "billing_state",
    "agg_daily_consumption_by_site",
    "kpi_co2_by_region",
)
#: Ingestion times as numbers, which compare alike in every time zone.
_MICROS = f"unix_micros({INGESTED_AT})"


def run_incremental(lake: Lake, labels: Mapping[str, str] = silver.REGION_LABELS) -> dict[str, int]:
    """Bring silver and gold up to date with bronze; returns the rows written by table, for tables that were written.

    Equal to :func:`~voltmark.plans.medallion.run_all` over the same bronze tables, up to the last digits of double
    sums, which depend on the order of addition in either. Rebuilds everything where there is no last run to go on from: at first, and
    when a bronze table was overwritten or truncated or another run replaced a table that this one relies on.

    A key's survivor is its last ingested row. New rows usually are later than all before, and then they win without a look
    at older ones. Where a new part holds rows that are no later (replays, late files), the changed keys are looked up in the
    whole bronze table instead: slower, and right in any case.

    An interrupted run is made good by the next, since how far it came is noted last: the same rows are merged again, which
    changes nothing where they had arrived, or all is rebuilt if a table was replaced that the notes don't know.
    """
    with fine_scans(lake.spark):
        return _run(lake, labels)


def _run(lake: Lake, labels: Mapping[str, str]) -> dict[str, int]:
    now = {name: lake.position(name) for name in RAW}
    last = _last_run(lake)
    if last is None or any(last[name].version != now[name][0] for name in RAW):
        return _rebuild(lake, now, labels)
    new = {name for name in RAW if now[name][1] > last[name].part}
    written: dict[str, int] = {}
    waters = {name: last[name].high_water for name in RAW}
    for name, merge in (("raw_meter_readings", _merge_readings), ("raw_billing", _merge_bills)):
        if name in new:
            changed, waters[name] = _changed(lake, name, last[name])
            written |= merge(lake, changed.persist())
            changed.unpersist()
    if "raw_device" in new:
        written["dim_device"] = lake.overwrite("dim_device", silver.dim_device(lake.read("raw_device")))
    if "raw_site" in new:
        written["dim_region"] = lake.overwrite("dim_region", silver.dim_region(lake.read("raw_site"), labels))
    if new & {"raw_site", "raw_meter_readings", "raw_billing"}:
        written["dim_site"] = lake.overwrite("dim_site", _sites(lake))
    written |= _gold(lake, daily="raw_meter_readings" in new, kpi=bool(new & {"raw_site", "raw_billing"}))
    if new:
        _note(lake, now, waters)
    return written


def _rebuild(lake: Lake, now: Mapping[str, tuple[str, int]], labels: Mapping[str, str]) -> dict[str, int]:
    written = bronze_to_silver(lake, labels)
    lake.overwrite("daily_state", daily_sums(lake.read("fact_energy_consumption")))
    lake.overwrite("billing_state", billing_sums(lake.read("fact_energy_cost")))
    written |= _gold(lake, daily=True, kpi=True)
    waters = {name: lake.read(name).agg(F.max(F.expr(_MICROS))).first()[0] for name in RAW}
    lake.overwrite("pending_days", _days(lake, []))
    _note(lake, now, waters)
    return written


# -- how far runs came ---------------------------------------------------------


def _last_run(lake: Lake) -> dict | None:
    """The notes of the last run by table; None if there are none, or a table isn't as they say."""
    if not lake.exists("run_state"):
        return None
    notes = {row.table_name: row for row in lake.read("run_state").collect()}  # a row for each table
    for name in _KEPT:
        if name not in notes or not lake.exists(name) or lake.position(name) != (notes[name].version, notes[name].part):
            return None
    return notes


def _note(lake: Lake, now: Mapping[str, tuple[str, int]], waters: Mapping) -> None:
    positions = {**{name: lake.position(name) for name in _KEPT}, **now}
    rows = [(name, version, part, waters.get(name)) for name, (version, part) in positions.items()]
    lake.overwrite("run_state", lake.spark.createDataFrame(rows, table("run_state").schema).coalesce(1))


def _changed(lake: Lake, name: str, last) -> tuple[DataFrame, object]:
    """The conformed rows that survive for every key in the new parts of a raw table, and the latest time now."""
    build = {"raw_meter_readings": silver.fact_energy_consumption, "raw_billing": silver.fact_energy_cost}[name]
    delta = lake.read(name, after=last.part)
    seen = delta.agg(
        F.min(F.expr(_MICROS)).alias("first"), F.max(F.expr(_MICROS)).alias("last"), F.count_if(F.expr(_MICROS).isNull()).alias("untimed")
    ).first()
    if seen.first is None and not seen.untimed:
        return build(delta), last.high_water
    waters = [w for w in (seen.last, last.high_water) if w is not None]
    water = max(waters) if waters else None
    later = not seen.untimed and (last.high_water is None or seen.first > last.high_water)
    if later and not _untimed_before(lake, name, last):
        return build(delta), water
    keys = build(delta).select(*table(name).key)
    return build(lake.read(name).join(keys, list(table(name).key), "left_semi")), water


def _untimed_before(lake: Lake, name: str, last) -> bool:
    """Whether the last run met no ingestion time at all, so that nothing says which rows are later."""
    return last.high_water is None and not lake.read(name).where(F.expr(_MICROS).isNull()).isEmpty()


# -- facts ---------------------------------------------------------------------


def _merge_readings(lake: Lake, changed: DataFrame) -> dict[str, int]:
    name, key = "fact_energy_consumption", "reading_id"
    fact = lake.read(name)
    keys = changed.select(key)
    days = changed.select("reading_date").union(fact.join(keys, key, "left_semi").select("reading_date")).distinct()
    # An interrupted run may have moved rows out of days whose sums it didn't reach.
    pending = days.union(lake.read("pending_days")).distinct()
    days = [row.reading_date for row in pending.collect()]  # at most one for each folder of the table
    if not days:
        return {}
    lake.overwrite("pending_days", _days(lake, days))
    kept = fact.where(F.col("reading_date").isin(days)).join(keys, key, "left_anti")
    written = {name: lake.replace_partitions(name, kept.unionByName(changed), days)}
    sums = daily_sums(lake.read(name).where(F.col("reading_date").isin(days)))
    lake.replace_partitions("daily_state", sums, days)
    lake.overwrite("pending_days", _days(lake, []))
    return written


def _days(lake: Lake, days: Sequence[date]) -> DataFrame:
    return lake.spark.createDataFrame([(d,) for d in days], table("pending_days").schema).coalesce(1)


def _merge_bills(lake: Lake, changed: DataFrame) -> dict[str, int]:
    name, key, group = "fact_energy_cost", "cost_id", ("site_id", "billing_period")
    fact = lake.read(name)  # the version before stays readable while the next is in use
    keys = changed.select(key)
    touched = changed.select(*group).union(fact.join(keys, key, "left_semi").select(*group)).distinct().persist()
    written = {name: lake.overwrite(name, fact.join(keys, key, "left_anti").unionByName(changed))}
    state = lake.read("billing_state")
    again = billing_sums(_matching(lake.read(name), touched, group, "left_semi"))
    lake.overwrite("billing_state", _matching(state, touched, group, "left_anti").unionByName(again))
    touched.unpersist()
    return written


def _matching(rows: DataFrame, groups: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Rows that are of the groups, or not, where null equals null."""
    other = groups.toDF(*[f"{c}!" for c in columns])
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(other[f"{c}!"]) for c in columns])
    return rows.join(other, same, how)


# -- sums and what is made of them ---------------------------------------------


def _sums(columns: Mapping[str, str], rows: str) -> list:
    made = []
    for name, column in columns.items():
        made += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    return [*made, F.count(F.lit(1)).alias(rows)]


def daily_sums(consumption: DataFrame) -> DataFrame:
    measures = {"energy": "energy_kwh", "power": "active_power_kw", "factor": "power_factor"}
    sums = consumption.groupBy("site_id", "reading_date").agg(*_sums(measures, "readings"))
    return sums.select(*table("daily_state").columns)


def billing_sums(cost: DataFrame) -> DataFrame:
    measures = {"energy": "energy_consumed_kwh", "cost": "energy_cost", "co2": "co2_emissions_kg"}
    return cost.groupBy("site_id", "billing_period").agg(*_sums(measures, "bills"))


def _sites(lake: Lake) -> DataFrame:
    energy = lake.read("daily_state").groupBy("site_id").agg(F.sum("energy_sum").alias("total_energy_kwh"))
    cost = lake.read("billing_state").groupBy("site_id").agg(
        F.sum("cost_sum").alias("total_energy_cost"), F.sum("co2_sum").alias("total_co2_kg")
    )
    return silver.sites_with_totals(lake.read("raw_site"), energy, cost)


def daily_from_sums(sums: DataFrame) -> DataFrame:
    """The daily aggregate, of which the sums have one row for each."""
    return sums.select(
        "site_id",
        "reading_date",
        F.col("energy_sum").alias("total_energy_kwh"),
        safe_divide(F.col("power_sum"), F.col("power_n")).alias("avg_active_power_kw"),
        safe_divide(F.col("factor_sum"), F.col("factor_n")).alias("avg_power_factor"),
        F.col("readings").alias("reading_count"),
    )


def _gold(lake: Lake, daily: bool, kpi: bool) -> dict[str, int]:
    written = {}
    if daily:
        name = "agg_daily_consumption_by_site"
        written[name] = lake.overwrite(name, daily_from_sums(lake.read("daily_state")))
    if kpi:
        sums = lake.read("billing_state").select(
            "site_id",
            "billing_period",
            F.col("co2_sum").alias("total_co2_kg"),
            F.col("energy_sum").alias("total_energy_kwh"),
            F.col("cost_sum").alias("total_cost"),
        )
        written["kpi_co2_by_region"] = lake.overwrite("kpi_co2_by_region", gold.kpi_from_sums(sums, lake.read("dim_site")))
    return written
