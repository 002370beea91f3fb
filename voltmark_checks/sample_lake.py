"""The sample tables as extracts of the energy domain, as text, with the faults raw extracts have.

Numbers are multiples of powers of two, so sums of them are exact in any order and Spark and the
checking SQL must agree to the last bit. Faults are part of the data: keys that are missing, text
that is no number, date or flag, rows delivered twice with other values. No row is left out.

``voltmark_checks.oracles.EXTRACTS`` states the same mapping in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmark.functions.parse import to_timestamp
from voltmark.plans import silver


# The given tables, with their types, so that reading them needs no job to find the types out.
SAMPLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def sample(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SAMPLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _stamped(df: DataFrame, ingested_at: str, source_file: str) -> DataFrame:
    return df.withColumns(
        {"ingested_at": F.lit(ingested_at).cast("timestamp"), "source_file": F.lit(source_file)}
    )


def raw_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers. Closed accounts have lost their id, new ones have no region yet. Every fifth country delivers
    again, with other types."""
    nation = sample(spark, sf_dir, "nation")
    region = sample(spark, sf_dir, "region")
    customers = (
        sample(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )

    def delivery(rows: DataFrame, site_type: str) -> DataFrame:
        return rows.selectExpr(
            "CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS string) END AS site_id",
            "c_name AS site_name",
            "n_name AS country",
            "CASE WHEN c_acctbal BETWEEN 0 AND 200 THEN NULL WHEN r_name = 'EUROPE' THEN 'EMEA' "
            "WHEN r_name = 'AMERICA' THEN 'AMER' WHEN r_name = 'ASIA' THEN 'APAC' ELSE r_name END AS region",
            "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown' "
            "ELSE CAST(n_nationkey * 2.5D AS string) END AS latitude",
            "CAST(n_nationkey * -7.25D AS string) AS longitude",
            f"{site_type} AS site_type",
            "CAST(c_acctbal AS string) AS contracted_power_kw",
            "concat('2020-', lpad(CAST(1 + n_nationkey % 12 AS string), 2, '0'), '-', "
            "CAST(31 - n_nationkey % 3 AS string)) AS commissioned_date",
        )

    first = _stamped(delivery(customers, "c_mktsegment"), "2024-02-01 00:00:00", "sites")
    again = delivery(customers.filter("c_nationkey % 5 = 0"), "lower(c_mktsegment)")
    return first.unionByName(_stamped(again, "2024-02-03 00:00:00", "sites again"))


def raw_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, four to a site. The smallest ones carry no id; the flag is written in many ways. Some are delivered
    again as another model, the earlier delivery coming last."""
    parts = sample(spark, sf_dir, "part")
    columns = (
        "CASE WHEN p_size > 2 THEN CAST(p_partkey AS string) END AS device_id",
        "CAST(p_partkey DIV 4 AS string) AS site_id",
        "p_type AS device_type",
        "CASE WHEN p_type = 'SMALL' THEN 'A' ELSE 'kWh' END AS measurement_unit",
        "concat('feeder-', CAST(p_size AS string)) AS install_location",
        "CASE WHEN p_size < 10 THEN 'true' WHEN p_size < 20 THEN 'TRUE' WHEN p_size < 30 THEN 'False' "
        "WHEN p_size < 40 THEN ' true ' WHEN p_size < 45 THEN 'yes' END AS is_active",
    )
    refitted = parts.filter("p_size % 7 = 0").selectExpr(*columns, "concat('A-', p_brand) AS model")
    later = _stamped(refitted, "2024-02-03 00:00:00", "devices again")
    return later.unionByName(_stamped(parts.selectExpr(*columns, "p_brand AS model"), "2024-02-01 00:00:00", "devices"))


def raw_meter_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, where clicks and errors were delivered again a day later with one more kWh.

    A first delivery may have lost its timestamp and be mended by the second, and the reverse. Some readings
    have a time without a date, some no site.
    """
    events = sample(spark, sf_dir, "events").withColumn("hundredths", F.expr("CAST(round(value * 100) AS bigint)"))

    def delivery(rows: DataFrame, damaged: str, extra_kwh: int) -> DataFrame:
        return rows.selectExpr(
            "CASE WHEN event_type = 'signup' AND value > 60 THEN NULL ELSE CAST(event_id AS string) END AS reading_id",
            "CAST(user_id AS string) AS device_id",
            "CASE WHEN event_type <> 'view' OR value >= 2 THEN CAST(user_id DIV 4 AS string) END AS site_id",
            f"CASE WHEN event_type = '{damaged}' AND value < 5 THEN 'x' "
            "WHEN event_type = 'purchase' AND value < 3 THEN '08:00:00' "
            "WHEN event_type = 'purchase' AND value < 4 THEN 'T08:00' ELSE CAST(ts AS string) END AS timestamp",
            "CASE WHEN event_type = 'signup' AND value < 5 THEN 'n/a' "
            "ELSE CAST(hundredths * 0.5D AS string) END AS active_power_kw",
            "CASE WHEN event_type = 'view' AND value > 60 THEN 'abc' "
            f"ELSE CAST(hundredths * 0.25D + {extra_kwh} AS string) END AS energy_kwh",
            "CAST(200 + user_id * 0.125D AS string) AS voltage_v",
            "CAST(hundredths * 0.125D AS string) AS current_a",
            "CASE event_type WHEN 'purchase' THEN '0.875' WHEN 'click' THEN '0.9375' "
            "WHEN 'view' THEN '0.96875' ELSE '1.0' END AS power_factor",
        )

    first = _stamped(delivery(events, "error", 0), "2024-02-01 00:00:00", "meters")
    again = events.filter("event_type IN ('click', 'error')")
    second = _stamped(delivery(again, "click", 1), "2024-02-02 00:00:00", "meters again")
    return first.unionByName(second)


def raw_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders. Bills of customers without a site id are orphans, some bills name no site. Every tenth bill is
    corrected later."""
    orders = sample(spark, sf_dir, "orders").withColumn("cents", F.expr("CAST(round(o_totalprice * 100) AS bigint)"))

    def delivery(rows: DataFrame, extra_cost: int) -> DataFrame:
        return rows.selectExpr(
            "CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 10000 THEN NULL "
            "ELSE CAST(o_orderkey AS string) END AS cost_id",
            "CASE WHEN o_orderpriority <> '3-MEDIUM' OR o_totalprice >= 5000 THEN CAST(o_custkey AS string) END AS site_id",
            "date_format(o_orderdate, 'yyyy-MM') AS billing_period",
            "CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 20000 THEN '' "
            "ELSE CAST(cents * 0.125D AS string) END AS energy_consumed_kwh",
            "CAST(cents % 1000 * 0.5D AS string) AS peak_demand_kw",
            "'0.125' AS tariff_rate",
            f"CAST(cents * 0.25D + {extra_cost} AS string) AS energy_cost",
            "CAST(cents * 0.0625D AS string) AS co2_emissions_kg",
            "CASE WHEN o_orderstatus = 'F' THEN 'EUR' ELSE 'USD' END AS currency",
        )

    first = _stamped(delivery(orders, 0), "2024-02-01 00:00:00", "bills")
    return first.unionByName(_stamped(delivery(orders.filter("o_orderkey % 10 = 0"), 3), "2024-02-04 00:00:00", "corrections"))


def third_delivery(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What arrives after all of the above: readings moved to another day, old ones delivered again as they were, and late files
    with earlier ingestion times, some of them of readings nobody had; bills moved to another period; sites of other regions."""
    readings = raw_meter_readings(spark, sf_dir)
    first = readings.filter("source_file = 'meters'")
    number = "CAST(reading_id AS bigint)"
    moved = first.filter(f"{number} % 13 = 0").withColumns(
        {
            "timestamp": (to_timestamp(F.col("timestamp")) + F.expr("INTERVAL 40 DAYS")).cast("string"),
            "energy_kwh": F.expr("CAST(try_cast(energy_kwh AS double) + 2 AS string)"),
        }
    )
    replayed = first.filter(f"{number} % 7 = 1")
    late = first.filter(f"{number} % 11 = 2").withColumn("energy_kwh", F.lit("1000"))
    unknown = first.filter(f"{number} % 17 = 3").withColumn("reading_id", F.concat(F.lit("late-"), "reading_id"))
    early = {"ingested_at": F.lit("2024-01-15 00:00:00").cast("timestamp"), "source_file": F.lit("late meters")}
    moved = moved.withColumns({"ingested_at": F.lit("2024-02-06 00:00:00").cast("timestamp"), "source_file": F.lit("moved")})
    readings = moved.unionByName(replayed).unionByName(late.withColumns(early)).unionByName(unknown.withColumns(early))
    bills = raw_billing(spark, sf_dir).filter("source_file = 'bills' AND CAST(cost_id AS bigint) % 7 = 0")
    bills = bills.withColumn("billing_period", F.lit("2030-01"))
    sites = raw_site(spark, sf_dir).filter("source_file = 'sites' AND CAST(site_id AS bigint) % 11 = 0")
    sites = sites.withColumn("region", F.lit("MOON"))
    later = {"ingested_at": F.lit("2024-02-07 00:00:00").cast("timestamp"), "source_file": F.lit("third")}
    return {"raw_meter_readings": readings, "raw_billing": bills.withColumns(later), "raw_site": sites.withColumns(later)}


def supplier_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers; every third is corrected later, to a contract of a year before."""
    nation = sample(spark, sf_dir, "nation")
    suppliers = sample(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))

    def delivery(rows: DataFrame, year: int, ingested_at: str) -> DataFrame:
        return rows.selectExpr(
            "s_suppkey AS supplier_id",
            "s_name AS supplier_name",
            "CASE WHEN s_acctbal < 1000 THEN 'Distributor' WHEN s_acctbal < 6000 THEN 'Service Partner' "
            "ELSE 'OEM' END AS supplier_type",
            "n_name AS country",
            f"concat('{year}-', lpad(CAST(1 + n_nationkey % 12 AS string), 2, '0'), '-', "
            "CAST(31 - n_nationkey % 3 AS string)) AS contract_since",
            f"TIMESTAMP '{ingested_at}' AS ingested_at",
        )

    corrected = delivery(suppliers.filter("s_suppkey % 3 = 0"), 2020, "2024-02-05 00:00:00")
    return corrected.unionByName(delivery(suppliers, 2021, "2024-02-01 00:00:00"))


def maintenance_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as typed maintenance records; about a quarter of them revise an earlier one. Some are
    corrected later, to a date before."""

    def delivery(rows: DataFrame, days_back: int, ingested_at: str) -> DataFrame:
        return rows.selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber) AS event_id",
            "CAST(l_partkey AS string) AS device_id",
            "CAST(l_partkey DIV 4 AS string) AS site_id",
            "CASE WHEN l_discount > 0 THEN CAST(l_suppkey AS string) END AS supplier_id",
            f"CAST(l_shipdate AS timestamp) - INTERVAL {days_back} DAYS AS event_date",
            "CASE l_returnflag WHEN 'R' THEN 'repair' WHEN 'A' THEN 'inspection' ELSE 'replacement' END AS event_type",
            "l_quantity * 0.5D AS downtime_hours",
            "round(l_extendedprice * 100) * 0.25D AS cost",
            "CASE WHEN l_linestatus = 'O' THEN 'EUR' ELSE 'USD' END AS currency",
            "concat('order ', l_orderkey, ' line ', l_linenumber) AS description",
            f"TIMESTAMP '{ingested_at}' AS ingested_at",
        )

    lines = sample(spark, sf_dir, "lineitem")
    corrected = delivery(lines.filter("l_partkey % 9 = 0"), 30, "2024-02-05 00:00:00")
    return corrected.unionByName(delivery(lines, 0, "2024-02-01 00:00:00"))


RAW = {
    "raw_site": raw_site,
    "raw_device": raw_device,
    "raw_meter_readings": raw_meter_readings,
    "raw_billing": raw_billing,
}


class SilverTables(Mapping):
    """The silver tables built from the extracts, each when it is first asked for."""

    NAMES = (
        "dim_region",
        "dim_device",
        "fact_energy_consumption",
        "fact_energy_cost",
        "dim_site",
        "dim_supplier",
        "maintenance_event",
    )

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def _build(self, name: str) -> DataFrame:
        at = (self._spark, self._sf_dir)
        match name:
            case "dim_region":
                return silver.dim_region(raw_site(*at))
            case "dim_device":
                return silver.dim_device(raw_device(*at))
            case "fact_energy_consumption":
                return silver.fact_energy_consumption(raw_meter_readings(*at))
            case "fact_energy_cost":
                return silver.fact_energy_cost(raw_billing(*at))
            case "dim_site":
                return silver.dim_site(raw_site(*at), self["fact_energy_consumption"], self["fact_energy_cost"])
            case "dim_supplier":
                return silver.dim_supplier(supplier_source(*at))
            case "maintenance_event":
                return silver.maintenance_event(maintenance_source(*at))


def silver_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return SilverTables(spark, sf_dir)
