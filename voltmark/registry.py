"""Every table of the lake: layer, schema, business key and partitioning.

Table and column names below are fixed values of the data model. Readers pass
these schemas to Spark and writers check against them, so an empty or evolved
table still reads with all its columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")

# Stamped on every landed row, next to the business columns.
INGESTED_AT = "ingested_at"
SOURCE_FILE = "source_file"


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "long": T.LongType(),
}


@dataclass(frozen=True)
class Table:
    """``fields`` lists the columns as ``name type``, separated by commas. Rows of equal ``bucket_by`` are stored in
    one bucket, so that a join on it need not shuffle them."""

    name: str
    layer: str
    fields: str
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    bucket_by: str | None = None

    @cached_property
    def schema(self) -> T.StructType:
        pairs = [field.split() for field in self.fields.split(",")]
        return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def business_columns(self) -> list[str]:
        """Columns without the ingestion metadata."""
        return [c for c in self.columns if c not in (INGESTED_AT, SOURCE_FILE)]


def _raw(name: str, key: str, columns: str) -> Table:
    """A landing table: business columns are all text, plus ingestion metadata."""
    texts = [f"{c} string" for c in columns.split()]
    fields = ", ".join([*texts, f"{INGESTED_AT} timestamp", f"{SOURCE_FILE} string"])
    return Table(name, "bronze", fields, (key,))


_ALL = (
    _raw(
        "raw_site",
        "site_id",
        "site_id site_name country region latitude longitude site_type contracted_power_kw commissioned_date",
    ),
    _raw(
        "raw_device",
        "device_id",
        "device_id site_id device_type model measurement_unit install_location is_active",
    ),
    _raw(
        "raw_meter_readings",
        "reading_id",
        "reading_id device_id site_id timestamp active_power_kw energy_kwh voltage_v current_a power_factor",
    ),
    _raw(
        "raw_billing",
        "cost_id",
        "cost_id site_id billing_period energy_consumed_kwh peak_demand_kw tariff_rate energy_cost "
        "co2_emissions_kg currency",
    ),
    Table(
        "dim_region",
        "silver",
        "region_id string, region_code string, region_name string",
        ("region_id",),
    ),
    Table(
        "dim_site",
        "silver",
        "site_id string, site_name string, country string, region string, region_id string, "
        "latitude double, longitude double, site_type string, contracted_power_kw double, "
        "commissioned_date date, total_energy_kwh double, total_energy_cost double, total_co2_kg double",
        ("site_id",),
    ),
    Table(
        "dim_device",
        "silver",
        "device_id string, site_id string, device_type string, model string, measurement_unit string, "
        "install_location string, is_active boolean",
        ("device_id",),
    ),
    Table(
        "fact_energy_consumption",
        "silver",
        "reading_id string, device_id string, site_id string, timestamp timestamp, active_power_kw double, "
        "energy_kwh double, voltage_v double, current_a double, power_factor double, reading_date date",
        ("reading_id",),
        ("reading_date",),
    ),
    Table(
        "fact_energy_cost",
        "silver",
        "cost_id string, site_id string, billing_period string, energy_consumed_kwh double, "
        "peak_demand_kw double, tariff_rate double, energy_cost double, co2_emissions_kg double, currency string",
        ("cost_id",),
    ),
    Table(
        "dim_supplier",
        "silver",
        "supplier_id string, supplier_name string, supplier_type string, country string, contract_since date",
        ("supplier_id",),
    ),
    Table(
        "maintenance_event",
        "silver",
        "event_id string, device_id string, site_id string, supplier_id string, event_date timestamp, "
        "event_type string, downtime_hours double, cost double, currency string, description string",
        ("event_id",),
    ),
    Table(
        "agg_daily_consumption_by_site",
        "gold",
        "site_id string, reading_date date, total_energy_kwh double, avg_active_power_kw double, "
        "avg_power_factor double, reading_count long",
        ("site_id", "reading_date"),
    ),
    Table(
        "kpi_co2_by_region",
        "gold",
        "region_id string, region string, billing_period string, total_co2_kg double, "
        "total_energy_kwh double, total_cost double",
        ("region_id", "region", "billing_period"),
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _ALL}

# Beside the layers: what incremental runs keep for themselves (sums that later runs add to, how far the last one came), and
# the materialised entity graph, rows that did not reach silver, and files that were landed.
STATE: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "daily_state",
            "state",
            "site_id string, energy_sum double, energy_n long, power_sum double, power_n long, factor_sum double, "
            "factor_n long, readings long, reading_date date",
            ("site_id", "reading_date"),
            ("reading_date",),
        ),
        Table(
            "billing_state",
            "state",
            "site_id string, billing_period string, energy_sum double, energy_n long, cost_sum double, cost_n long, "
            "co2_sum double, co2_n long, bills long",
            ("site_id", "billing_period"),
        ),
        Table(
            "run_state",
            "state",
            "table_name string, version string, part long, high_water long",
            ("table_name",),
        ),
        Table("graph_nodes", "graph", "type string, id string, display_name string", ("type", "id"), ("type",)),
        Table(
            "graph_edges",
            "graph",
            "rel string, src_type string, src string, dst_type string, dst string",
            ("rel", "src", "dst"),
            ("rel",),
            bucket_by="src",
        ),
        Table(
            "dropped_rows",
            "state",
            "table_name string, missing string, row string, ingested_at timestamp, source_file string",
            ("table_name", "row"),
        ),
        Table(
            "landed_files",
            "state",
            "table_name string, version string, part long, file_path string, modified long",
            ("table_name", "file_path", "modified"),
        ),
        Table("pending_days", "state", "reading_date date", ("reading_date",)),
    )
}


def table(name: str) -> Table:
    if name in STATE:
        return STATE[name]
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
    return TABLES[name]


def layer_tables(layer: str) -> list[Table]:
    if layer not in LAYERS:
        raise KeyError(f"unknown layer {layer!r}; known: {', '.join(LAYERS)}")
    return [t for t in _ALL if t.layer == layer]
