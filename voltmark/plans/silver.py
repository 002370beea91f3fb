"""Silver tables: the typed star model, from raw text and from the maintenance source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.functions import labelled, surrogate_key
from voltmark.operators import Intake, conform
from voltmark.registry import table

# Display names of the region codes; other codes show as they are.
REGION_LABELS = {
    "EMEA": "Europe, Middle East & Africa",
    "AMER": "Americas",
    "APAC": "Asia-Pacific",
}

# Per-site totals on dim_site.
TOTALS = ["total_energy_kwh", "total_energy_cost", "total_co2_kg"]


def dim_region(raw_site: DataFrame, labels: Mapping[str, str] = REGION_LABELS) -> DataFrame:
    """One row per region code that any site carries, keyed by the hash of the code."""
    code = F.col("region_code")
    codes = raw_site.select(F.col("region").alias("region_code")).filter(code.isNotNull()).distinct()
    return codes.select(
        surrogate_key(code).alias("region_id"), code, labelled(code, labels).alias("region_name")
    )


def dim_device(raw_device: DataFrame, intake: Intake | None = None) -> DataFrame:
    return conform(raw_device, "dim_device", intake=intake)


def fact_energy_consumption(raw_meter_readings: DataFrame, intake: Intake | None = None) -> DataFrame:
    """Readings with a valid timestamp; numbers that do not parse are null."""
    return conform(
        raw_meter_readings,
        "fact_energy_consumption",
        derive={"reading_date": F.to_date("timestamp")},
        required=["timestamp"],
        intake=intake,
    )


def fact_energy_cost(raw_billing: DataFrame, intake: Intake | None = None) -> DataFrame:
    return conform(raw_billing, "fact_energy_cost", intake=intake)


def energy_by_site(consumption: DataFrame) -> DataFrame:
    return consumption.groupBy("site_id").agg(F.sum("energy_kwh").alias("total_energy_kwh"))


def cost_by_site(cost: DataFrame) -> DataFrame:
    """Totals per site over all currencies, as billed."""
    return cost.groupBy("site_id").agg(
        F.sum("energy_cost").alias("total_energy_cost"),
        F.sum("co2_emissions_kg").alias("total_co2_kg"),
    )


def dim_site(raw_site: DataFrame, consumption: DataFrame, cost: DataFrame, intake: Intake | None = None) -> DataFrame:
    """Sites with their totals over both facts, 0 where a site has none (or its total is NaN).

    Each fact is summed to one row per site before it is joined, so the two cannot multiply each
    other, and a site with a third of all readings is one row by then. All three inputs of the
    joins come out of a shuffle on ``site_id``; the joins add none.
    """
    return sites_with_totals(raw_site, energy_by_site(consumption), cost_by_site(cost), intake)


def sites_with_totals(raw_site: DataFrame, energy: DataFrame, cost: DataFrame, intake: Intake | None = None) -> DataFrame:
    """Sites with their totals, from tables with one row for each site."""
    sites = conform(raw_site, "dim_site", derive={"region_id": surrogate_key(F.col("region"))}, intake=intake)
    joined = sites.join(energy, "site_id", "left").join(cost, "site_id", "left")
    return joined.na.fill(0.0, TOTALS).select(*table("dim_site").columns)


def dim_supplier(suppliers: DataFrame, intake: Intake | None = None) -> DataFrame:
    """Suppliers from the maintenance source; the last ingested record survives, or else the latest contract."""
    return conform(suppliers, "dim_supplier", latest=["contract_since"], intake=intake)


def maintenance_event(events: DataFrame, intake: Intake | None = None) -> DataFrame:
    """Events from the maintenance source; the last ingested record of an event id survives,
    or else the latest dated one."""
    return conform(events, "maintenance_event", latest=["event_date"], intake=intake)
