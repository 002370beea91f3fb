"""The business questions the lake is built for."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.operators import differing, top_k
from voltmark.plans.graph import EntityGraph
from voltmark.plans.metrics import metrics
from voltmark.plans.silver import TOTALS, cost_by_site, energy_by_site
from voltmark.registry import table

Tables = Mapping[str, DataFrame]


def cost_by_region(tables: Tables) -> DataFrame:
    """Total energy cost per region, from the bills. Bills without a region show as null."""
    return metrics(tables, ["Total Energy Cost"], by=[("dim_region", "region_name")])


def cost_by_region_from_sites(tables: Tables) -> DataFrame:
    """The same from the per-site totals, rolled up along the graph: sites in a region only."""
    walk = EntityGraph(tables).traverse(
        ["locatedIn"], carry={"Site": ["total_energy_cost"], "Region": ["region_name"]}
    )
    return walk.groupBy("region_name").agg(F.sum("total_energy_cost").alias("total_energy_cost"))


def top_emitting_sites(tables: Tables, k: int = 1) -> DataFrame:
    """The sites with the most CO2."""
    sites = tables["dim_site"].select("site_id", "site_name", "country", "total_co2_kg")
    return top_k(sites, by="total_co2_kg", k=k, key="site_id")


def co2_intensity_by_site(tables: Tables) -> DataFrame:
    """Kilograms of CO2 per metered kWh and site name."""
    return metrics(tables, ["CO2 Intensity (kg/kWh)"], by=[("dim_site", "site_name")])


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """The frame with its numbers rounded for reading."""
    return df.select(
        *[F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def supplier_downtime_by_region(tables: Tables) -> DataFrame:
    """Maintenance events, downtime and cost per region and supplier.

    Events of unknown devices, sites or regions stand under a null region, those without a supplier under a null
    one, so the rows add up to all events. Events are summed per device and supplier before they meet the
    devices, so a device or supplier with most of the events does not weigh on any join.
    """
    graph = EntityGraph(tables)
    per_region = graph.rollup(
        ["^hasMaintenance", "^hasDevice", "locatedIn"],
        measures={"events": None, "downtime_hours": "downtime_hours", "cost": "cost"},
        by={"MaintenanceEvent": ["supplier_id"], "Region": ["region_name"]},
    )
    suppliers = graph.entity("Supplier").select("supplier_id", "supplier_name")
    named = per_region.join(suppliers, "supplier_id", "left")
    return named.select("region_name", "supplier_id", "supplier_name", "events", "downtime_hours", "cost")


def energy_and_maintenance_by_region(tables: Tables) -> DataFrame:
    """Metered energy, emissions, downtime and maintenance cost side by side per region.

    Readings, bills and events hang off the same sites and devices. Each is summed on its own and
    only the sums meet, since joined row by row they would multiply each other. What belongs to no known
    region stands under a null one, so the rows add up to all facts.
    """
    graph = EntityGraph(tables)
    region = {"Region": ["region_name"]}
    parts = [
        graph.rollup(["^produces", "^hasDevice", "locatedIn"], {"energy_kwh": "energy_kwh"}, region),
        graph.rollup(["^billedFor", "locatedIn"], {"co2_kg": "co2_emissions_kg"}, region),
        graph.rollup(
            ["^hasMaintenance", "^hasDevice", "locatedIn"],
            {"downtime_hours": "downtime_hours", "maintenance_cost": "cost"},
            region,
        ),
    ]
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    measures = ["energy_kwh", "co2_kg", "downtime_hours", "maintenance_cost"]
    return rows.groupBy("region_name").agg(*[F.sum(m).alias(m) for m in measures])


def snapshot_drift(tables: Tables) -> DataFrame:
    """Sites whose stored totals differ from the facts as they are now: stored and live side by side."""
    sites = tables["dim_site"].select("site_id", *TOTALS)
    live = energy_by_site(tables["fact_energy_consumption"]).unionByName(
        cost_by_site(tables["fact_energy_cost"]), allowMissingColumns=True
    )
    live = live.groupBy("site_id").agg(*[F.sum(c).alias(f"live_{c}") for c in TOTALS])
    compared = sites.join(live, "site_id", "left").na.fill(0.0, [f"live_{c}" for c in TOTALS])
    drifted = F.lit(False)
    for c in TOTALS:
        # Sums of doubles depend on the order of addition in the last digits.
        drifted = drifted | (F.abs(F.col(c) - F.col(f"live_{c}")) > 1e-9 * F.greatest(F.abs(c), F.lit(1.0)))
    return compared.filter(drifted)


def drifted_site_months(stored: DataFrame, live: DataFrame) -> DataFrame:
    """Sites and months in which two states of the readings differ, with the readings of either, by checksums: days first, so
    that only days that differ are read a second time, then sites within them."""
    day = F.col("reading_date")
    found = differing(stored, live, [[day], [F.col("site_id")]], table("fact_energy_consumption").columns)
    month = F.date_format("reading_date", "yyyy-MM").alias("month")
    sums = [F.sum(c).alias(c) for c in ("left_rows", "right_rows")]
    return found.groupBy("site_id", month).agg(*sums).withColumnsRenamed({"left_rows": "stored_readings", "right_rows": "live_readings"})
