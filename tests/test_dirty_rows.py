"""Faulty raw rows: what is kept, what becomes null and what is dropped."""

import math
from datetime import datetime

import pytest
from conftest import event_frame, rows_of, supplier_frame
from pyspark.sql import functions as F

from voltmark import land_rows, metrics
from voltmark.plans import gold, silver
from voltmark.registry import TABLES


def readings(spark, *changes):
    base = ("r", "d", "s", "2026-06-01 08:00:00", "1.0", "2.0", "3.0", "4.0", "0.5")
    columns = TABLES["raw_meter_readings"].business_columns
    rows = [tuple({**dict(zip(columns, base, strict=True)), **c}.values()) for c in changes]
    return land_rows(spark, "raw_meter_readings", rows, "t")


def bills(spark, *changes):
    base = ("c", "s", "2026-06", "10", "1", "0.1", "5", "7", "EUR")
    columns = TABLES["raw_billing"].business_columns
    rows = [tuple({**dict(zip(columns, base, strict=True)), **c}.values()) for c in changes]
    return land_rows(spark, "raw_billing", rows, "t")


def sites(spark, *changes):
    base = ("s", "Name", "Land", "EMEA", "1", "2", "plant", "3", "2020-01-31")
    columns = TABLES["raw_site"].business_columns
    rows = [tuple({**dict(zip(columns, base, strict=True)), **c}.values()) for c in changes]
    return land_rows(spark, "raw_site", rows, "t")


def test_bad_number_keeps_the_row(spark):
    fact = silver.fact_energy_consumption(
        readings(spark, {"reading_id": "1", "energy_kwh": "abc"}, {"reading_id": "2"})
    )
    assert rows_of(fact, "reading_id", "energy_kwh") == [("1", None), ("2", 2.0)]
    daily = gold.agg_daily_consumption_by_site(fact)
    assert rows_of(daily, "total_energy_kwh", "reading_count") == [(2.0, 2)]


def test_bad_timestamp_drops_the_row(spark):
    fact = silver.fact_energy_consumption(
        readings(spark, {"reading_id": "1", "timestamp": "x"}, {"reading_id": "2", "timestamp": None}, {"reading_id": "3"})
    )
    assert rows_of(fact, "reading_id") == [("3",)]


def test_impossible_date_is_null(spark):
    frame = silver.dim_site(
        sites(spark, {"commissioned_date": "2026-06-31"}),
        silver.fact_energy_consumption(readings(spark)),
        silver.fact_energy_cost(bills(spark)),
    )
    assert rows_of(frame, "site_id", "commissioned_date") == [("s", None)]


@pytest.mark.parametrize(
    ("text", "value"), [("TRUE", True), ("true", True), (" true ", False), ("yes", False), (None, None)]
)
def test_boolean_text(spark, text, value):
    raw = land_rows(spark, "raw_device", [("d", "s", "t", "m", "u", "l", text)], "t")
    assert rows_of(silver.dim_device(raw), "is_active") == [(value,)]


def test_null_keys_are_dropped(spark):
    assert silver.fact_energy_consumption(readings(spark, {"reading_id": None})).isEmpty()
    assert silver.fact_energy_cost(bills(spark, {"cost_id": None})).isEmpty()
    assert silver.dim_device(land_rows(spark, "raw_device", [(None, *"abcdef")], "t")).isEmpty()
    none = silver.dim_site(
        sites(spark, {"site_id": None}),
        silver.fact_energy_consumption(readings(spark)),
        silver.fact_energy_cost(bills(spark)),
    )
    assert none.isEmpty()


def at(df, moment):
    return df.withColumn("ingested_at", F.lit(moment).cast("timestamp"))


def test_later_replay_survives(spark):
    first = at(readings(spark, {"energy_kwh": "9"}), datetime(2026, 1, 1))
    second = at(readings(spark, {"energy_kwh": "1"}), datetime(2026, 1, 2))
    for raw in (first.union(second), second.union(first)):
        assert rows_of(silver.fact_energy_consumption(raw), "energy_kwh") == [(1.0,)]


def test_bad_replay_does_not_replace_a_good_row(spark):
    good = at(readings(spark, {"energy_kwh": "9"}), datetime(2026, 1, 1))
    bad = at(readings(spark, {"energy_kwh": "1", "timestamp": "x"}), datetime(2026, 1, 2))
    assert rows_of(silver.fact_energy_consumption(good.union(bad)), "energy_kwh") == [(9.0,)]


def test_replaying_everything_changes_nothing(spark):
    raw = readings(spark, {"reading_id": "1"}, {"reading_id": "2", "energy_kwh": "7"})
    once = rows_of(silver.fact_energy_consumption(raw))
    assert rows_of(silver.fact_energy_consumption(raw.union(raw).repartition(3))) == once


def test_regions(spark):
    raw = sites(
        spark,
        {"site_id": "1", "region": None},
        {"site_id": "2", "region": "LATAM"},
        {"site_id": "3", "region": "APAC"},
        {"site_id": "4", "region": "APAC"},
    )
    assert rows_of(silver.dim_region(raw), "region_code", "region_name") == [("APAC", "Asia-Pacific"), ("LATAM", "LATAM")]
    frame = silver.dim_site(
        raw, silver.fact_energy_consumption(readings(spark)), silver.fact_energy_cost(bills(spark))
    )
    assert rows_of(frame.filter("region_id IS NULL"), "site_id") == [("1",)]


def test_other_region_labels(spark):
    region = silver.dim_region(sites(spark, {"region": "N"}), labels={"N": "North"})
    assert rows_of(region, "region_name") == [("North",)]


def test_orphans_and_sites_without_region_share_the_null_group(spark):
    cost = silver.fact_energy_cost(
        bills(
            spark,
            {"cost_id": "1", "site_id": "gone"},
            {"cost_id": "2", "site_id": "s"},
            {"cost_id": "3", "site_id": None},
            {"cost_id": "4", "site_id": "n"},
        )
    )
    frame = silver.dim_site(
        sites(spark, {"region": None}, {"site_id": "n", "region": "AMER"}),
        silver.fact_energy_consumption(readings(spark)),
        cost,
    )
    kpi = gold.kpi_co2_by_region(cost, frame)
    assert rows_of(kpi, "region", "billing_period", "total_co2_kg", "total_energy_kwh", "total_cost") == [
        ("AMER", "2026-06", 7.0, 10.0, 5.0),
        (None, "2026-06", 21.0, 30.0, 15.0),
    ]
    assert rows_of(gold.kpi_co2_by_region(cost, frame, by_currency=True), "region", "currency") == [
        ("AMER", "EUR"),
        (None, "EUR"),
    ]


def test_site_without_facts_has_zero_totals(spark):
    frame = silver.dim_site(
        sites(spark, {"site_id": "lonely"}),
        silver.fact_energy_consumption(readings(spark)),
        silver.fact_energy_cost(bills(spark)),
    )
    assert rows_of(frame, "total_energy_kwh", "total_energy_cost", "total_co2_kg") == [(0.0, 0.0, 0.0)]


def test_nan_text(spark):
    fact = silver.fact_energy_consumption(readings(spark, {"reading_id": "1", "energy_kwh": "NaN"}, {"reading_id": "2"}))
    ((total,),) = rows_of(gold.agg_daily_consumption_by_site(fact), "total_energy_kwh")
    assert math.isnan(total)
    frame = silver.dim_site(sites(spark, {}), fact, silver.fact_energy_cost(bills(spark)))
    assert rows_of(frame, "total_energy_kwh") == [(0.0,)]


def test_ratio_without_energy_is_null(spark):
    cost = silver.fact_energy_cost(bills(spark, {}))
    none = silver.fact_energy_consumption(readings(spark))
    tables = {
        "fact_energy_cost": cost,
        "fact_energy_consumption": none,
        "dim_site": silver.dim_site(sites(spark, {}), none, cost),
    }
    result = metrics(tables, ["Total Energy Cost", "Cost per kWh"], by=[("dim_site", "country")])
    assert rows_of(result) == [("Land", 5.0, None)]


def test_empty_inputs_give_empty_tables(spark):
    no_readings, no_bills, no_sites = readings(spark), bills(spark), sites(spark)
    consumption, cost = silver.fact_energy_consumption(no_readings), silver.fact_energy_cost(no_bills)
    frame = silver.dim_site(no_sites, consumption, cost)
    built = {
        "dim_region": silver.dim_region(no_sites),
        "dim_site": frame,
        "dim_device": silver.dim_device(land_rows(spark, "raw_device", [], "t")),
        "fact_energy_consumption": consumption,
        "fact_energy_cost": cost,
        "agg_daily_consumption_by_site": gold.agg_daily_consumption_by_site(consumption),
        "kpi_co2_by_region": gold.kpi_co2_by_region(cost, frame),
    }
    for name, df in built.items():
        assert df.isEmpty()
        wanted = [(f.name, f.dataType) for f in TABLES[name].schema]
        assert [(f.name, f.dataType) for f in df.schema] == wanted


def test_maintenance_source(spark):
    suppliers = silver.dim_supplier(supplier_frame(spark))
    assert rows_of(suppliers.filter("contract_since IS NULL"), "supplier_id") == [("o2",)]
    old = ("E1", "D", "S", "P", "2026-06-01 10:00:00", "repair", "bad", "1", "EUR", "first")
    new = ("E1", "D", "S", "P", "2026-06-02 10:00:00", "repair", "2", "1", "EUR", "second")
    lost = (None, "D", "S", "P", "2026-06-02 10:00:00", "repair", "2", "1", "EUR", "no id")
    events = silver.maintenance_event(event_frame(spark, [new, old, lost]))
    assert rows_of(events, "event_id", "description", "downtime_hours") == [("E1", "second", 2.0)]


def test_typed_source_values_pass_through(spark):
    typed = supplier_frame(spark).withColumn("contract_since", F.lit("2020-02-03").cast("date"))
    assert {r[0].isoformat() for r in rows_of(silver.dim_supplier(typed), "contract_since")} == {"2020-02-03"}
