"""Metered-energy analytics on Spark DataFrames.

The usual entry points::

    from voltmark import Lake, run_all, metrics, EntityGraph

    lake = Lake(spark, "s3a://bucket/energy")
    lake.append("raw_billing", land(extract, "raw_billing", source_file="erp"))
    run_all(lake)
    metrics(lake.bind(), ["Total Energy Cost"], by=[("dim_region", "region_name")])
"""

from voltmark.plans.graph import ENERGY_GRAPH, EntityGraph
from voltmark.plans.incremental import run_incremental
from voltmark.plans.medallion import bronze_to_silver, run_all, silver_to_gold
from voltmark.plans.metrics import ENERGY_MODEL, metrics
from voltmark.session import build_session
from voltmark.sources.lake import Lake
from voltmark.sources.landing import land, land_files, land_rows

__all__ = [
    "ENERGY_GRAPH",
    "ENERGY_MODEL",
    "EntityGraph",
    "Lake",
    "bronze_to_silver",
    "build_session",
    "land",
    "land_files",
    "land_rows",
    "metrics",
    "run_all",
    "run_incremental",
    "silver_to_gold",
]
