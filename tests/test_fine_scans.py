"""How much a task scans where rows are sorted before their shuffle."""

import pytest
from conftest import BILLS, DEVICES, READINGS, SITES

from voltmark import Lake, land_rows, run_incremental
from voltmark.plans.medallion import bronze_to_silver, load_maintenance
from voltmark.registry import table
from voltmark.session import FINE_SCAN, fine_scans

SCAN = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def scans(monkeypatch):
    """Bytes of files a task may read, as each table is overwritten."""
    seen, overwrite = {}, Lake.overwrite

    def watched(lake, name, df):
        seen[name] = lake.spark.conf.get(SCAN)
        return overwrite(lake, name, df)

    monkeypatch.setattr(Lake, "overwrite", watched)
    return seen


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = {"raw_site": SITES, "raw_device": DEVICES, "raw_meter_readings": READINGS, "raw_billing": BILLS}
    for name, given in rows.items():
        lake.append(name, land_rows(spark, name, given, "t"))
    return lake


def test_deduplication_reads_little_a_task(spark, lake, scans):
    before = spark.conf.get(SCAN)
    bronze_to_silver(lake)
    suppliers = spark.createDataFrame([], "supplier_id string, supplier_name string, supplier_type string, country string, contract_since date")
    load_maintenance(lake, suppliers, spark.createDataFrame([], table("maintenance_event").schema))
    assert {"fact_energy_consumption", "fact_energy_cost", "dim_site", "maintenance_event"} <= set(scans)
    assert set(scans.values()) == {str(FINE_SCAN)} and spark.conf.get(SCAN) == before
    scans.clear()
    run_incremental(lake)
    assert set(scans.values()) == {str(FINE_SCAN)} and spark.conf.get(SCAN) == before


@pytest.mark.parametrize("asked, used", [("1m", "1m"), ("32MB", "32MB"), ("4096", "4096"), ("1g", str(FINE_SCAN)), ("134217728b", str(FINE_SCAN))])
def test_fine_scans_keep_a_smaller_setting(spark, asked, used):
    before = spark.conf.get(SCAN)
    try:
        spark.conf.set(SCAN, asked)
        with pytest.raises(KeyError), fine_scans(spark):
            assert spark.conf.get(SCAN) == used
            raise KeyError
        assert spark.conf.get(SCAN) == asked
    finally:
        spark.conf.set(SCAN, before)
