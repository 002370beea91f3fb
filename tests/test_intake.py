"""What conforming leaves out, counted in the pass that writes."""

from conftest import AGAIN, BILLS, DEVICES, READINGS, SITES, event_frame, rows_of, supplier_frame
from pyspark.sql import functions as F

from voltmark import Lake, land_rows, run_all
from voltmark.operators import Intake
from voltmark.plans import silver
from voltmark.plans.medallion import dropped_rows, load_maintenance

EXTRA = [
    (None, "m-1", "quay", "never", "x", "1", "", "1", None),  # counts for its key, not for its time
    ("z1", "m-1", "quay", None, "1", "1", "1", "1", "1"),
    ("z2", "m-1", "quay", "12:30:00", "NaN", "1", "1", "1", "1"),
]


def loaded(spark, root):
    lake = Lake(spark, root)
    for name, rows in (("raw_site", SITES), ("raw_device", DEVICES), ("raw_billing", [*BILLS, (None,) * 9])):
        lake.append(name, land_rows(spark, name, rows, "fixture"))
    lake.append("raw_meter_readings", land_rows(spark, "raw_meter_readings", READINGS + EXTRA, "fixture"))
    lake.append("raw_meter_readings", land_rows(spark, "raw_meter_readings", AGAIN, "again"))
    return lake


def test_counts_of_a_full_run(spark, tmp_path):
    lake, intake = loaded(spark, str(tmp_path)), Intake()
    written = run_all(lake, intake=intake)
    written |= load_maintenance(lake, supplier_frame(spark), event_frame(spark), intake)
    counts = intake.counts()
    assert set(counts) == {"dim_site", "dim_device", "fact_energy_consumption", "fact_energy_cost", "dim_supplier", "maintenance_event"}
    readings = counts["fact_energy_consumption"]
    assert readings == {
        "read|": 14, "dropped|reading_id": 1, "dropped|timestamp": 3, "failed|timestamp": 3, "failed|active_power_kw": 1,
        "failed|energy_kwh": 1, "failed|voltage_v": 1, "failed|current_a": 0, "failed|power_factor": 0,
    }
    replaced = readings["read|"] - readings["dropped|reading_id"] - readings["dropped|timestamp"] - written["fact_energy_consumption"]
    assert replaced == len(AGAIN)
    assert counts["fact_energy_cost"]["dropped|cost_id"] == 1 and counts["dim_site"]["failed|latitude"] == 1
    assert counts["dim_site"]["failed|commissioned_date"] == 1 and counts["dim_supplier"]["failed|contract_since"] == 1
    assert counts["maintenance_event"]["read|"] == 5
    assert ("fact_energy_consumption", "dropped", "timestamp", 3) in rows_of(intake.report(spark))


def test_counting_changes_no_rows_and_needs_no_second_pass(spark):
    raw = land_rows(spark, "raw_meter_readings", READINGS + EXTRA, "t")
    watched = silver.fact_energy_consumption(raw, Intake())
    assert rows_of(watched) == rows_of(silver.fact_energy_consumption(raw))
    assert watched._jdf.queryExecution().optimizedPlan().toString().count("CollectMetrics") == 1


def test_counts_that_do_not_add_up_are_taken_again(spark):
    """As after a lost executor, whose tasks count twice."""
    raw, intake = land_rows(spark, "raw_meter_readings", READINGS + EXTRA, "t"), Intake()
    silver.fact_energy_consumption(raw, intake).collect()
    watch = intake._watches["fact_energy_consumption"]
    watch.source = watch.source.union(watch.source)
    assert intake.counts()["fact_energy_consumption"]["read|"] == 13


def test_dropped_rows(spark, tmp_path):
    lake = loaded(spark, str(tmp_path))
    assert lake.overwrite("dropped_rows", dropped_rows(lake)) == 5
    kept = lake.read("dropped_rows").withColumn("reading", F.get_json_object("row", "$.reading_id"))
    assert rows_of(kept, "table_name", "missing", "reading", "source_file") == sorted(
        [
            ("fact_energy_consumption", "reading_id", None, "fixture"),
            ("fact_energy_consumption", "timestamp", "g1", "fixture"),
            ("fact_energy_consumption", "timestamp", "z1", "fixture"),
            ("fact_energy_consumption", "timestamp", "z2", "fixture"),
            ("fact_energy_cost", "cost_id", None, "fixture"),
        ],
        key=repr,
    )
