"""End to end on the small lake, against answers worked out by hand."""

import hashlib
from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from voltmark import ENERGY_MODEL, EntityGraph, metrics, run_all
from voltmark.plans import questions

close = pytest.approx


EMEA = "Europe, Middle East & Africa"


def same(actual, expected):
    """Equal rows, numbers up to rounding."""
    assert len(actual) == len(expected)
    for a, e in zip(actual, sorted(expected, key=repr), strict=True):
        for x, y in zip(a, e, strict=True):
            assert x == (close(y, abs=1e-6) if isinstance(y, float) else y), (a, e)


def test_rows_written(golden):
    assert golden.counts == {
        "dim_region": 3,
        "dim_device": 6,
        "fact_energy_consumption": 9,
        "fact_energy_cost": 6,
        "dim_site": 5,
        "agg_daily_consumption_by_site": 8,
        "kpi_co2_by_region": 5,
        "dim_supplier": 2,
        "maintenance_event": 5,
    }


def test_regions(golden):
    names = {"EMEA": EMEA, "AMER": "Americas", "APAC": "Asia-Pacific"}
    same(rows_of(golden.read("dim_region")), [(hashlib.md5(c.encode()).hexdigest(), c, n) for c, n in names.items()])


def test_devices(golden):
    flags = {"m-1": True, "m-2": True, "m-3": False, "m-4": True, "m-5": None, "m-6": False}
    assert dict(rows_of(golden.read("dim_device"), "device_id", "is_active")) == flags


def test_sites(golden):
    odd = rows_of(golden.read("dim_site"), "site_id", "latitude", "region_id", "commissioned_date")
    by_site = {r[0]: r[1:] for r in odd}
    assert by_site["quay"][0] is None and by_site["quay"][2] is None  # the 29th of February 2021
    assert by_site["reef"][0] is None and by_site["pop-up"][1] is None


def test_daily(golden):
    day = lambda m, d: date(2023, m, d)
    expected = [
        ("north-hall", day(10, 28), 4.0, 16.0, 0.5, 1),
        ("north-hall", day(10, 29), 12.0, 16.0, 0.875, 2),  # the second delivery of a2 counts
        ("quay", day(10, 29), 20.0, 40.0, 0.75, 1),
        ("quay", day(10, 30), None, 48.0, 0.25, 1),
        ("mesa", day(11, 1), 32.0, 64.0, 1.0, 1),
        ("reef", day(11, 1), 0.5, 2.0, 0.5, 1),
        ("pop-up", day(11, 2), 3.0, 6.0, 0.75, 1),
        (None, day(11, 2), 5.0, 10.0, 1.0, 1),
    ]
    same(rows_of(golden.read("agg_daily_consumption_by_site")), expected)


def test_site_totals(golden):
    expected = [
        ("north-hall", 16.0, 40.0, 64.0),
        ("quay", 20.0, 100.0, 16.0),
        ("mesa", 32.0, 40.0, 160.0),
        ("reef", 0.5, 0.0, 0.0),
        ("pop-up", 3.0, 8.0, 1.0),
    ]
    same(rows_of(golden.read("dim_site"), "site_id", "total_energy_kwh", "total_energy_cost", "total_co2_kg"), expected)


def test_kpi(golden):
    expected = [
        ("AMER", "2023-11", 160.0, 320.0, 40.0),
        ("EMEA", "2023-10", 56.0, 300.0, 125.0),
        ("EMEA", "2023-11", 24.0, 60.0, 15.0),
        (None, "2023-10", 4.0, 8.0, 2.0),
        (None, "2023-11", 1.0, 16.0, 8.0),
    ]
    columns = ("region", "billing_period", "total_co2_kg", "total_energy_kwh", "total_cost")
    same(rows_of(golden.read("kpi_co2_by_region"), *columns), expected)


ORDER = [
    "Total Energy (kWh)",
    "Total Energy Cost",
    "Total CO2 (kg)",
    "Cost per kWh",
    "CO2 Intensity (kg/kWh)",
    "Avg Power Factor",
    "Site Count",
]


def test_metrics_by_region(golden):
    assert set(ORDER) == set(ENERGY_MODEL.measures)
    expected = [
        ("Americas", 32.0, 40.0, 160.0, 1.25, 5.0, 1.0, 1),
        ("Asia-Pacific", 0.5, None, None, None, None, 0.5, 1),
        (EMEA, 36.0, 140.0, 80.0, 140 / 36, 80 / 36, 0.65, 2),
        (None, 8.0, 10.0, 5.0, 1.25, 0.625, 0.875, 1),
    ]
    same(rows_of(metrics(golden.bind(), ORDER, by=[("dim_region", "region_name")])), expected)


def test_metric_totals(golden):
    same(rows_of(metrics(golden.bind(), ORDER)), [(76.5, 190.0, 245.0, 190 / 76.5, 245 / 76.5, 6.5 / 9, 5)])


def test_unreachable_slicer_repeats_the_total(golden):
    result = metrics(golden.bind(), ["Total Energy (kWh)", "Total Energy Cost"], by=[("dim_device", "device_type")])
    expected = [("gas_meter", 32.0, 190.0), ("power_meter", 39.5, 190.0), ("water_meter", 2.0, 190.0), (None, 3.0, 190.0)]
    same(rows_of(result), expected)


def test_top_emitter(golden):
    assert rows_of(questions.top_emitting_sites(golden.bind()), "site_id", "total_co2_kg") == [("mesa", 160)]


def test_edge_counts(golden):
    counts = EntityGraph(golden.bind()).all_edges().groupBy("rel").count()
    assert dict(rows_of(counts)) == {
        "locatedIn": 4,  # one site has no region
        "hasDevice": 6,
        "produces": 9,
        "billedFor": 6,
        "hasMaintenance": 5,
        "performedBy": 4,  # one event has no supplier
    }


def test_cost_by_region_both_ways(golden):
    by_bills = dict(rows_of(questions.cost_by_region(golden.bind())))
    by_sites = dict(rows_of(questions.cost_by_region_from_sites(golden.bind())))
    assert by_bills == {"Americas": 40, EMEA: 140, None: 10}
    assert by_sites == {"Americas": 40, EMEA: 140, "Asia-Pacific": 0}


def test_run_again_changes_nothing(golden):
    names = ("dim_region", "dim_site", "dim_device", "fact_energy_consumption", "kpi_co2_by_region")
    before = {name: rows_of(golden.read(name)) for name in names}
    again = run_all(golden)
    assert again == {name: golden.counts[name] for name in again}
    assert {name: rows_of(golden.read(name)) for name in names} == before


def test_supplier_downtime(golden):
    actual = rows_of(
        questions.supplier_downtime_by_region(golden.bind()),
        "region_name",
        "supplier_name",
        "events",
        "downtime_hours",
        "cost",
    )
    expected = [
        ("Americas", "Kappa", 1, 6.0, 128.0),
        (EMEA, "Kappa", 1, 2.0, 64.0),
        (EMEA, "Omicron", 1, 0.5, 8.0),
        (EMEA, None, 1, 1.0, 4.0),
        (None, "Omicron", 1, 3.0, 16.0),
    ]
    same(actual, expected)


def test_branches_do_not_multiply(golden):
    actual = rows_of(
        questions.energy_and_maintenance_by_region(golden.bind()),
        "region_name",
        "energy_kwh",
        "co2_kg",
        "downtime_hours",
        "maintenance_cost",
    )
    expected = [
        ("Americas", 32.0, 160.0, 6.0, 128.0),
        ("Asia-Pacific", 0.5, None, None, None),
        (EMEA, 36.0, 80.0, 3.5, 76.0),
        (None, 8.0, 5.0, 3.0, 16.0),
    ]
    same(actual, expected)


def test_answers_add_up_to_the_facts(golden):
    """Nothing is lost on the way, whatever its device, site, region or supplier."""
    tables = golden.bind()
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    regions = questions.energy_and_maintenance_by_region(tables)
    downtime = questions.supplier_downtime_by_region(tables)
    assert total(regions, "energy_kwh") == total(tables["fact_energy_consumption"], "energy_kwh")
    assert total(regions, "co2_kg") == total(tables["fact_energy_cost"], "co2_emissions_kg")
    assert total(downtime, "events") == tables["maintenance_event"].count()
    for column, fact in (("downtime_hours", "downtime_hours"), ("maintenance_cost", "cost")):
        assert total(regions, column) == total(tables["maintenance_event"], fact) == total(downtime, fact)


def test_no_drift_after_a_run(golden):
    assert questions.snapshot_drift(golden.bind()).isEmpty()
