"""The full run: bronze to silver to gold, table by table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmark.functions import parse
from voltmark.operators import Intake
from voltmark.plans import gold, silver
from voltmark.registry import INGESTED_AT, SOURCE_FILE, table
from voltmark.session import fine_scans
from voltmark.sources.lake import Lake


def bronze_to_silver(
    lake: Lake, labels: Mapping[str, str] = silver.REGION_LABELS, intake: Intake | None = None
) -> dict[str, int]:
    """Rebuild the silver tables from bronze; returns the rows written by table. ``intake`` counts what is left out.

    The facts come first, and the site totals read the *written* facts: parsing and deduplicating
    them happens once, and a lost executor costs at most the table in progress.
    """
    with fine_scans(lake.spark):
        raw = {name: lake.read(name) for name in ("raw_site", "raw_device", "raw_meter_readings", "raw_billing")}
        written = {
            "dim_region": lake.overwrite("dim_region", silver.dim_region(raw["raw_site"], labels)),
            "dim_device": lake.overwrite("dim_device", silver.dim_device(raw["raw_device"], intake)),
            "fact_energy_consumption": lake.overwrite(
                "fact_energy_consumption", silver.fact_energy_consumption(raw["raw_meter_readings"], intake)
            ),
            "fact_energy_cost": lake.overwrite("fact_energy_cost", silver.fact_energy_cost(raw["raw_billing"], intake)),
        }
        sites = silver.dim_site(raw["raw_site"], lake.read("fact_energy_consumption"), lake.read("fact_energy_cost"), intake)
        written["dim_site"] = lake.overwrite("dim_site", sites)
    return written


def silver_to_gold(lake: Lake) -> dict[str, int]:
    """Rebuild the gold tables from silver; returns the rows written by table."""
    daily = gold.agg_daily_consumption_by_site(lake.read("fact_energy_consumption"))
    kpi = gold.kpi_co2_by_region(lake.read("fact_energy_cost"), lake.read("dim_site"))
    return {
        "agg_daily_consumption_by_site": lake.overwrite("agg_daily_consumption_by_site", daily),
        "kpi_co2_by_region": lake.overwrite("kpi_co2_by_region", kpi),
    }


def run_all(
    lake: Lake, labels: Mapping[str, str] = silver.REGION_LABELS, intake: Intake | None = None
) -> dict[str, int]:
    """Silver, then gold. Every table is replaced, so a run can be repeated at any time."""
    return {**bronze_to_silver(lake, labels, intake), **silver_to_gold(lake)}


def load_maintenance(
    lake: Lake, suppliers: DataFrame, events: DataFrame, intake: Intake | None = None
) -> dict[str, int]:
    """Conform the maintenance source into silver. Its events refer to devices, so those must exist."""
    lake.read_required("dim_device")
    with fine_scans(lake.spark):
        return {
            "dim_supplier": lake.overwrite("dim_supplier", silver.dim_supplier(suppliers, intake)),
            "maintenance_event": lake.overwrite("maintenance_event", silver.maintenance_event(events, intake)),
        }


# Raw tables, what they are conformed to, and the columns besides the key that a row must have.
_CONFORMED = (
    ("raw_site", "dim_site", ()),
    ("raw_device", "dim_device", ()),
    ("raw_meter_readings", "fact_energy_consumption", ("timestamp",)),
    ("raw_billing", "fact_energy_cost", ()),
)


def dropped_rows(lake: Lake) -> DataFrame:
    """The raw rows that a run drops: the silver table they don't reach, the first column they lack (or that doesn't parse), the row
    as JSON and its ingestion. A lazy frame; ``lake.overwrite("dropped_rows", ...)`` keeps it beside the layers."""
    parts = []
    for raw, name, required in _CONFORMED:
        types = {f.name: f.dataType for f in table(name).schema}
        missing = [
            F.when(parse(F.col(f"`{c}`"), T.StringType(), types[c]).isNull(), F.lit(c)) for c in (*table(name).key, *required)
        ]
        rows = lake.read(raw).select(
            F.lit(name).alias("table_name"),
            F.coalesce(*missing).alias("missing"),
            F.to_json(F.struct(*[F.col(f"`{c}`") for c in table(raw).business_columns])).alias("row"),
            INGESTED_AT,
            SOURCE_FILE,
        )
        parts.append(rows.filter("missing IS NOT NULL"))
    return reduce(lambda left, right: left.unionByName(right), parts)
