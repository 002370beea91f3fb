import os
from datetime import date

import pytest
from conftest import BILLS, READINGS, VALID_READINGS, plan_of, rows_of
from pyspark.sql import functions as F

from voltmark import Lake, land, land_rows, run_all
from voltmark.plans import silver
from voltmark.plans.medallion import load_maintenance
from voltmark.registry import LAYERS, TABLES, layer_tables, table


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def fact(spark, rows=READINGS):
    return silver.fact_energy_consumption(land_rows(spark, "raw_meter_readings", rows, "t"))


def test_registry():
    assert {layer: len(layer_tables(layer)) for layer in LAYERS} == {"bronze": 4, "silver": 7, "gold": 2}
    assert table("raw_site").columns[-2:] == ["ingested_at", "source_file"]
    with pytest.raises(KeyError):
        table("nope")
    with pytest.raises(KeyError):
        layer_tables("nope")


def test_paths(lake):
    assert lake.path("dim_site") == f"{lake.root}/silver/dim_site"
    with pytest.raises(KeyError):
        lake.path("nope")


def test_landing(spark):
    extract = spark.createDataFrame([(1, "s", "2026-06", 1.5, None, 0.1, 2.0, 3.0, "EUR")],
        "cost_id int, site_id string, billing_period string, energy_consumed_kwh double, peak_demand_kw double, "
        "tariff_rate double, energy_cost double, co2_emissions_kg double, currency string")
    landed = land(extract, "raw_billing", "erp")
    assert landed.schema.simpleString() == table("raw_billing").schema.simpleString()
    row = landed.first()
    assert (row.cost_id, row.energy_consumed_kwh, row.peak_demand_kw, row.source_file) == ("1", "1.5", None, "erp")
    assert row.ingested_at is not None
    with pytest.raises(ValueError, match="unknown"):
        land(extract.withColumn("more", F.lit(1)), "raw_billing", "erp")
    with pytest.raises(ValueError, match="missing"):
        land(extract.drop("currency"), "raw_billing", "erp")
    with pytest.raises(ValueError, match="silver"):
        land(extract, "fact_energy_cost", "erp")


def test_landing_files_records_their_paths(spark, tmp_path):
    path = str(tmp_path / "bills")
    spark.createDataFrame(BILLS, table("raw_billing").business_columns).write.option("header", True).csv(path)
    schema = ", ".join(f"{c} string" for c in table("raw_billing").business_columns)
    read = spark.read.schema(schema).option("header", True).csv(path)
    landed = land(read, "raw_billing", F.col("_metadata.file_path"))
    assert landed.count() == len(BILLS)
    assert all("bills" in r.source_file for r in landed.collect())


def test_append_adds_and_overwrite_replaces(spark, lake):
    bills = land_rows(spark, "raw_billing", BILLS, "t")
    assert lake.append("raw_billing", bills) == len(BILLS)
    assert lake.append("raw_billing", bills.limit(1)) == 1
    assert lake.read("raw_billing").count() == len(BILLS) + 1
    assert lake.overwrite("raw_billing", bills.limit(2)) == 2
    assert lake.read("raw_billing").count() == 2


def test_schema_is_enforced(spark, lake):
    bills = land_rows(spark, "raw_billing", BILLS, "t")
    with pytest.raises(ValueError, match="currency: table string, frame absent"):
        lake.append("raw_billing", bills.drop("currency"))
    with pytest.raises(ValueError, match="more: table absent"):
        lake.append("raw_billing", bills.withColumn("more", F.lit(1)))
    with pytest.raises(ValueError, match="cost_id: table string, frame int"):
        lake.overwrite("raw_billing", bills.withColumn("cost_id", F.lit(1)))
    reordered = bills.select(*reversed(bills.columns))
    lake.append("raw_billing", reordered)
    assert lake.read("raw_billing").columns == table("raw_billing").columns


def test_partitions_are_written_and_pruned(spark, lake):
    assert lake.overwrite("fact_energy_consumption", fact(spark)) == VALID_READINGS
    folders = {f for f in os.listdir(lake.location("fact_energy_consumption")) if f.startswith("reading_date=")}
    days = ("2023-10-28", "2023-10-29", "2023-10-30", "2023-11-01", "2023-11-02")
    assert folders == {f"reading_date={d}" for d in days}
    day = lake.read("fact_energy_consumption").filter(F.col("reading_date") == F.lit(date(2023, 10, 29)))
    assert day.count() == 3
    plan = plan_of(day)
    assert "PartitionFilters: [isnotnull(reading_date" in plan
    assert lake.read("fact_energy_consumption").columns == table("fact_energy_consumption").columns


def test_a_partition_is_not_scattered_over_all_tasks(spark, lake):
    """Rows of a day are brought together before writing: few files, however the rows were spread."""
    many = [(f"R{i}", "d", "s", f"2026-06-0{1 + i % 5} 08:00:00", "1", "1", "1", "1", "1") for i in range(2000)]
    lake.overwrite("fact_energy_consumption", fact(spark, many).repartition(16))
    files = [f for d, _, names in os.walk(lake.location("fact_energy_consumption")) for f in names if f.endswith(".parquet")]
    assert len(files) == 5


def test_a_hot_partition_is_split(spark, lake):
    """Four fifths of the rows on one day are written by several tasks, and all of them arrive."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        many = spark.range(40000).select(
            F.col("id").cast("string").alias("reading_id"),
            F.md5(F.col("id").cast("string")).alias("device_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("site_id"),
            F.lit("2026-06-01 08:00:00").cast("timestamp").alias("timestamp"),
            *[F.rand(1).alias(c) for c in ("active_power_kw", "energy_kwh", "voltage_v", "current_a", "power_factor")],
            F.expr("CASE WHEN id % 5 = 0 THEN date'2026-06-02' ELSE date'2026-06-01' END").alias("reading_date"),
        )
        assert lake.overwrite("fact_energy_consumption", many.repartition(8)) == 40000
        hot = os.listdir(f"{lake.location('fact_energy_consumption')}/reading_date=2026-06-01")
        assert len([f for f in hot if f.endswith(".parquet")]) > 2
        assert lake.read("fact_energy_consumption").count() == 40000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_overwrite_replaces_all_partitions_whatever_the_session_says(spark, lake):
    lake.overwrite("fact_energy_consumption", fact(spark))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        lake.overwrite("fact_energy_consumption", fact(spark, READINGS[:1]))
        assert lake.read("fact_energy_consumption").count() == 1
        lake.truncate(["fact_energy_consumption"])
        assert lake.read("fact_energy_consumption").count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_create_tables(spark, lake):
    assert set(lake.create_tables()) == set(TABLES)
    for name, spec in TABLES.items():
        df = lake.read(name)
        assert df.isEmpty() and df.columns == spec.columns
    lake.append("raw_billing", land_rows(spark, "raw_billing", BILLS, "t"))
    assert lake.create_tables("bronze") == []
    assert lake.read("raw_billing").count() == len(BILLS)


def test_a_column_declared_later_reads_as_null(spark, lake):
    bills = land_rows(spark, "raw_billing", BILLS, "t").drop("currency")
    bills.write.parquet(f"{lake.path('raw_billing')}/v00000001")
    assert lake.create_tables("bronze") == ["raw_site", "raw_device", "raw_meter_readings"]
    assert rows_of(lake.read("raw_billing"), "cost_id", "currency") == [(b[0], None) for b in BILLS]


def test_truncate_keeps_schemas_and_goes_on_past_missing_tables(spark, lake):
    lake.append("raw_billing", land_rows(spark, "raw_billing", BILLS, "t"))
    lake.overwrite("fact_energy_consumption", fact(spark))
    outcome = lake.truncate()
    assert set(outcome) == set(TABLES)
    assert outcome["raw_billing"] == outcome["fact_energy_consumption"] == "cleared"
    assert outcome["dim_site"].startswith("skipped")
    for name in ("raw_billing", "fact_energy_consumption"):
        assert lake.read(name).isEmpty() and lake.read(name).columns == table(name).columns


def test_reset_needs_confirmation_and_touches_tables_only(spark, lake):
    lake.create_tables()
    other = f"{lake.root}/silver/notes"
    os.makedirs(other)
    with pytest.raises(ValueError):
        lake.reset()
    assert lake.exists("dim_site")
    assert lake.reset("gold", confirm=True) == [t.name for t in layer_tables("gold")]
    assert lake.exists("dim_site") and not lake.exists("kpi_co2_by_region")
    lake.reset(confirm=True)
    assert not lake.exists("dim_site") and os.path.isdir(other)


def test_required_table(spark, lake):
    lake.create_tables("bronze", "silver")
    with pytest.raises(ValueError, match="dim_device has no rows"):
        lake.read_required("dim_device")
    with pytest.raises(ValueError, match="dim_device"):
        load_maintenance(lake, spark.range(1), spark.range(1))


def test_views(golden, spark):
    golden.bind("dim_site", views=True)
    assert spark.sql("SELECT count(*) AS n FROM dim_site").first().n == 5
    assert set(golden.bind()) == {t.name for t in layer_tables("silver")}


def test_delta_options(spark, tmp_path):
    if "delta" not in (spark.conf.get("spark.sql.extensions", None) or ""):
        pytest.skip("needs a session with Delta")
    lake = Lake(spark, str(tmp_path), fmt="delta")
    lake.create_tables()
    assert lake.append("raw_billing", land_rows(spark, "raw_billing", BILLS, "t")) == len(BILLS)
    assert lake.truncate(["raw_billing"]) == {"raw_billing": "cleared"}


def test_run_over_empty_tables(spark, lake):
    """Nothing landed yet: every table is written, empty, with its schema."""
    lake.create_tables()
    counts = run_all(lake)
    assert set(counts.values()) == {0}
    for name in counts:
        assert lake.read(name).isEmpty() and lake.read(name).columns == table(name).columns
    assert lake.overwrite("dim_region", spark.createDataFrame([], table("dim_region").schema)) == 0


def test_run_replaces_all_rows_when_bronze_shrinks(spark, lake):
    lake.create_tables("bronze")
    lake.append("raw_meter_readings", land_rows(spark, "raw_meter_readings", READINGS, "t"))
    assert run_all(lake)["fact_energy_consumption"] == VALID_READINGS
    lake.truncate(["raw_meter_readings"])
    assert run_all(lake)["fact_energy_consumption"] == 0
    assert lake.read("fact_energy_consumption").isEmpty()


def test_a_failed_overwrite_leaves_the_table_as_it_was(spark, lake):
    lake.overwrite("raw_billing", land_rows(spark, "raw_billing", BILLS, "t"))
    before = rows_of(lake.read("raw_billing"), "cost_id")
    broken = lake.read("raw_billing").withColumn("currency", F.expr("CAST(raise_error('no') AS string)"))
    with pytest.raises(Exception, match="no"):
        lake.overwrite("raw_billing", broken)
    assert rows_of(lake.read("raw_billing"), "cost_id") == before
    mended = lake.read("raw_billing").where("cost_id <> 'i-1'")
    assert lake.overwrite("raw_billing", mended) == len(BILLS) - 1  # a table may be rewritten from itself
    assert lake.read("raw_billing").count() == len(BILLS) - 1


def test_a_reader_under_way_keeps_its_version(spark, lake):
    lake.overwrite("raw_billing", land_rows(spark, "raw_billing", BILLS, "t"))
    reader = lake.read("raw_billing")
    lake.overwrite("raw_billing", land_rows(spark, "raw_billing", BILLS[:1], "t"))
    assert reader.count() == len(BILLS) and lake.read("raw_billing").count() == 1
    lake.overwrite("raw_billing", land_rows(spark, "raw_billing", BILLS[:2], "t"))
    assert len([f for f in os.listdir(lake.path("raw_billing")) if f.startswith("v")]) == 2


def test_an_unfinished_table_is_not_read_as_empty(spark, lake):
    with pytest.raises(FileNotFoundError, match="raw_billing"):
        lake.read("raw_billing")
    lake.overwrite("raw_billing", land_rows(spark, "raw_billing", BILLS, "t"))
    os.remove(f"{lake.location('raw_billing')}/_SUCCESS")
    with pytest.raises(FileNotFoundError, match="raw_billing"):
        lake.read("raw_billing")
    assert lake.truncate(["raw_billing"])["raw_billing"].startswith("skipped")


def test_truncate_goes_on_past_any_failure(spark, lake, monkeypatch):
    lake.create_tables("bronze")
    save = Lake._save

    def failing(self, spec, rows, mode):
        if spec.name == "raw_site":
            raise RuntimeError("no permission")
        save(self, spec, rows, mode)

    monkeypatch.setattr(Lake, "_save", failing)
    outcome = lake.truncate(["raw_site", "raw_billing"])
    assert outcome == {"raw_site": "skipped: no permission", "raw_billing": "cleared"}
