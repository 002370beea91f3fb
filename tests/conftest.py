from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from voltmark import Lake, build_session, land_rows, run_all  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# A small lake with known answers: two sites in one region, one without a region, readings and bills whose
# site, device or region is missing, a number and a timestamp that do not parse, and a reading delivered again.
SITES = [
    ("north-hall", "North hall", "Norway", "EMEA", "63.4", "10.4", "warehouse", "400", "2018-11-05"),
    ("quay", "Quay 9", "Norway", "EMEA", None, "5.3", "cold store", "650.5", "2021-02-29"),
    ("mesa", "Mesa yard", "Chile", "AMER", "-23.6", "-70.4", "depot", "120", "2022-08-17"),
    ("reef", "Reef pumps", "Fiji", "APAC", "south", "178.0", "pump", "75.25", "2017-05-30"),
    ("pop-up", "Pop-up", "Oman", None, "23.6", "58.4", "event", "12", "2024-01-09"),
]
DEVICES = [
    ("m-1", "north-hall", "power_meter", "K4", "kWh", "hall east", "true"),
    ("m-2", "north-hall", "water_meter", "W1", "m3", "cellar", "TRUE"),
    ("m-3", "quay", "power_meter", "K4", "kWh", "gate", "no"),
    ("m-4", "mesa", "gas_meter", "G7", "kWh", "boiler", "true"),
    ("m-5", "reef", "power_meter", "K5", "kWh", "pump 1", None),
    ("m-6", "nowhere", "power_meter", "K5", "kWh", "store", "false"),
]
READINGS = [
    ("a1", "m-1", "north-hall", "2023-10-28 22:15:00", "16", "4", "230", "70", "0.5"),
    ("a2", "m-1", "north-hall", "2023-10-29 06:30:00", "24", "8", "231", "104", "0.75"),
    ("a3", "m-2", "north-hall", "2023-10-29 07:00:00", "8", "2", "229", "35", "1"),
    ("b1", "m-3", "quay", "2023-10-29 00:00:00", "40", "20", "400", "100", "0.75"),
    ("b2", "m-3", "quay", "2023-10-30 23:59:59", "48", "n/a", "400", "120", "0.25"),
    ("c1", "m-4", "mesa", "2023-11-01 12:00:00", "64", "32", "110", "580", "1"),
    ("d1", "m-5", "reef", "2023-11-01 03:00:00", "2", "0.5", "240", "8", "0.5"),
    ("e1", "m-9", "pop-up", "2023-11-02 09:00:00", "6", "3", "230", "26", "0.75"),
    ("f1", "m-6", None, "2023-11-02 10:00:00", "10", "5", "230", "43", "1"),
    ("g1", "m-1", "north-hall", "08:00:00", "1", "1", "1", "1", "1"),
]
AGAIN = [("a2", "m-1", "north-hall", "2023-10-29 06:30:00", "24", "10", "231", "104", "0.75")]
VALID_READINGS = 9
BILLS = [
    ("i-1", "north-hall", "2023-10", "100", "20", "0.25", "25", "40", "NOK"),
    ("i-2", "north-hall", "2023-11", "60", "15", "0.25", "15", "24", "NOK"),
    ("i-3", "quay", "2023-10", "200", "50", "0.5", "100", "16", "EUR"),
    ("i-4", "mesa", "2023-11", "320", "64", "0.125", "40", "160", "USD"),
    ("i-5", "gone", "2023-10", "8", "1", "0.25", "2", "4", "EUR"),
    ("i-6", "pop-up", "2023-11", "16", "6", "0.5", "8", "1", "EUR"),
]
SUPPLIERS = [("k7", "Kappa", "OEM", "Chile", "2019-06-30"), ("o2", "Omicron", "Partner", "Norway", "2020-02-30")]
EVENTS = [
    ("x1", "m-1", "north-hall", "k7", "2023-10-30 08:00:00", "repair", "2", "64", "NOK", "relay"),
    ("x2", "m-1", "north-hall", "o2", "2023-11-03 08:00:00", "inspection", "0.5", "8", "NOK", "yearly check"),
    ("x3", "m-4", "mesa", "k7", "2023-11-04 08:00:00", "repair", "6", "128", "USD", "valve"),
    ("x4", "m-3", "quay", None, "2023-11-05 08:00:00", "repair", "1", "4", "EUR", "own staff"),
    ("x5", "m-9", "pop-up", "o2", "2023-11-05 09:00:00", "repair", "3", "16", "EUR", "unknown meter"),
]


def supplier_frame(spark, rows=SUPPLIERS):
    return spark.createDataFrame(
        rows, "supplier_id string, supplier_name string, supplier_type string, country string, contract_since string"
    )


def event_frame(spark, rows=EVENTS):
    return spark.createDataFrame(
        rows,
        "event_id string, device_id string, site_id string, supplier_id string, event_date string, event_type string, "
        "downtime_hours string, cost string, currency string, description string",
    )


@pytest.fixture(scope="session")
def golden(spark, tmp_path_factory):
    """The small lake after a full run, with the maintenance source."""
    from voltmark.plans.medallion import load_maintenance

    lake = Lake(spark, str(tmp_path_factory.mktemp("golden")))
    for name, rows in (
        ("raw_site", SITES),
        ("raw_device", DEVICES),
        ("raw_meter_readings", READINGS),
        ("raw_billing", BILLS),
    ):
        lake.append(name, land_rows(spark, name, rows, source_file="fixture"))
    lake.append("raw_meter_readings", land_rows(spark, "raw_meter_readings", AGAIN, source_file="again"))
    lake.counts = run_all(lake)
    lake.counts |= load_maintenance(lake, supplier_frame(spark), event_frame(spark))
    return lake


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns or df.columns]).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
