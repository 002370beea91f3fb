"""Physical plans: what is read, what is shuffled, and what skew does."""

import re
from contextlib import contextmanager

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from voltmark import EntityGraph, Lake, land_rows
from voltmark.plans import gold, questions, silver


@contextmanager
def session_settings(spark, settings):
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# Join by shuffle whatever the size, as large tables do.
LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def read_columns(plan: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


def test_regions_read_one_column(golden):
    plan = plan_of(silver.dim_region(golden.read("raw_site")))
    assert read_columns(plan) == [{"region"}]
    assert "PushedFilters: [IsNotNull(region)]" in plan


def test_facts_push_their_filters_and_shuffle_once(golden):
    plan = plan_of(silver.fact_energy_consumption(golden.read("raw_meter_readings")))
    assert "IsNotNull(reading_id)" in plan and "IsNotNull(timestamp)" in plan
    assert shuffles(plan) == 1
    assert "Python" not in plan


def test_daily_reads_what_it_sums_and_combines_before_the_shuffle(golden):
    plan = plan_of(gold.agg_daily_consumption_by_site(golden.read("fact_energy_consumption")))
    assert read_columns(plan) == [{"site_id", "energy_kwh", "active_power_kw", "power_factor"}]
    assert shuffles(plan) == 1 and "partial_sum" in plan[plan.index("Exchange") :]


def test_site_joins_add_no_shuffle(spark, golden):
    with session_settings(spark, LARGE):
        sites = silver.dim_site(
            golden.read("raw_site"), golden.read("fact_energy_consumption"), golden.read("fact_energy_cost")
        )
        plan = plan_of(sites)
    assert plan.count("SortMergeJoin") == 2
    assert shuffles(plan) == 3  # one per input, all on site_id


def test_bills_are_summed_before_the_join(spark, golden):
    with session_settings(spark, LARGE):
        plan = plan_of(gold.kpi_co2_by_region(golden.read("fact_energy_cost"), golden.read("dim_site")))
    assert "partial_sum" in plan[plan.index("SortMergeJoin") :]
    assert {"site_id", "region_id", "region"} in read_columns(plan)


def test_totals_nobody_asks_for_are_not_computed(golden):
    sites = silver.dim_site(
        golden.read("raw_site"), golden.read("fact_energy_consumption"), golden.read("fact_energy_cost")
    )
    assert "Join" not in plan_of(sites.select("site_id", "region_id"))


def test_no_question_needs_python_or_a_cross_join(golden):
    tables = golden.bind()
    for question in (
        questions.cost_by_region,
        questions.cost_by_region_from_sites,
        questions.top_emitting_sites,
        questions.co2_intensity_by_site,
        questions.supplier_downtime_by_region,
        questions.energy_and_maintenance_by_region,
        questions.snapshot_drift,
    ):
        plan = plan_of(question(tables))
        assert not re.search("Cartesian|NestedLoop|Python|RDD", plan), question.__name__


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Half of all maintenance events on one device."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("skewed")))
    device = F.when(F.col("id") % 2 == 0, F.lit("0")).otherwise((F.col("id") % 200).cast("string"))
    events = spark.range(60000).select(
        F.col("id").cast("string").alias("event_id"),
        device.alias("device_id"),
        F.lit("s").alias("site_id"),
        (F.col("id") % 7).cast("string").alias("supplier_id"),
        F.lit("2026-01-01 00:00:00").alias("event_date"),
        F.lit("repair").alias("event_type"),
        F.lit("1").alias("downtime_hours"),
        F.lit("2").alias("cost"),
        F.lit("EUR").alias("currency"),
        F.sha2(F.col("id").cast("string"), 512).alias("description"),
    )
    lake.overwrite("maintenance_event", silver.maintenance_event(events.repartition(8)))
    devices = [(str(i), "s", "t", "m", "u", "l", "true") for i in range(200)]
    lake.overwrite("dim_device", silver.dim_device(land_rows(spark, "raw_device", devices, "t")))
    return lake


def test_a_hot_key_is_split_in_a_walk(spark, skewed):
    settings = {
        **LARGE,
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "256KB",
    }
    with session_settings(spark, settings):
        walk = EntityGraph(skewed.bind("maintenance_event", "dim_device")).traverse(
            ["hasMaintenance"], carry={"MaintenanceEvent": ["description"], "Device": ["model"]}
        )
        assert len(walk.collect()) == 60000
        assert "skew=true" in plan_of(walk)


def test_a_hot_key_in_a_question_is_one_row_per_supplier(spark, skewed):
    events = skewed.read("maintenance_event")
    per_device = events.groupBy("device_id", "supplier_id").count()
    assert rows_of(per_device.filter("device_id = '0'"), "count") and per_device.count() <= 200 * 7
    tables = {
        "maintenance_event": events,
        "dim_device": skewed.read("dim_device"),
        "dim_region": spark.createDataFrame([("r", "R", "Region")], "region_id string, region_code string, region_name string"),
        "dim_site": spark.createDataFrame([("s", "r")], "site_id string, region_id string").selectExpr(
            "*",
            *[f"CAST(NULL AS string) AS {c}" for c in ("site_name", "country", "site_type")],
            *[
                f"CAST(NULL AS double) AS {c}"
                for c in ("contracted_power_kw", "total_energy_kwh", "total_energy_cost", "total_co2_kg")
            ],
        ),
        "dim_supplier": spark.range(7).selectExpr(
            "CAST(id AS string) AS supplier_id", "concat('S', id) AS supplier_name", "'t' AS supplier_type", "'c' AS country"
        ),
    }
    result = questions.supplier_downtime_by_region(tables)
    totals = result.agg(F.sum("events"), F.sum("downtime_hours"), F.sum("cost"))
    assert tuple(totals.first()) == (60000, 60000.0, 120000.0)
    with session_settings(spark, LARGE):
        plan = plan_of(questions.supplier_downtime_by_region(tables))
    assert re.search(r"HashAggregate\(keys=\[device_id#\d+, supplier_id#\d+\], functions=\[partial_count", plan)


def test_a_filter_on_the_day_prunes_partitions(golden):
    from datetime import date

    from voltmark import metrics

    day = {("fact_energy_consumption", "reading_date"): [date(2023, 10, 29)]}
    result = metrics(golden.bind(), ["Total Energy (kWh)"], by=[("dim_region", "region_name")], where=day)
    assert re.search(r"PartitionFilters: \[[^\]]*reading_date#\d+ (IN|=)", plan_of(result))
    assert [r[1] for r in result.collect()] == [32.0]


def test_walks_reduce_their_tables_before_they_join_them(spark, golden):
    path = ["hasDevice", "hasMaintenance", "performedBy"]
    graph = EntityGraph(golden.bind())
    with session_settings(spark, LARGE):
        walk = graph.traverse(path, start=["mesa"], where={"Supplier": {"country": ["Chile"]}})
        plan = walk._jdf.queryExecution().optimizedPlan().toString()
        plain = graph.traverse(path)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plain
    # Three semi-joins from the end, three from the start, all below the three joins of the walk.
    assert plan.count("Join Inner") == 3 and plan.count("LeftSemi") >= 6
    assert plan.split("Join Inner")[-1].count("LeftSemi") >= 2
    assert len(walk.collect()) == 1


def test_dimension_filters_reach_the_fact_before_it_is_summed(golden):
    from voltmark import metrics

    def planned(values):
        where = {("dim_region", "region_code"): values}
        return metrics(golden.bind(), ["Total Energy (kWh)"], by=[("dim_site", "country")], where=where)

    for values, kind in ((["EMEA"], "LeftSemi"), (["EMEA", None], "LeftAnti")):
        plan = planned(values)._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        reduction = next(i for i, line in enumerate(lines) if kind in line)
        depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(lines)}
        summed = [i for i in range(reduction) if "Aggregate" in lines[i] and "energy_kwh" in lines[i]]
        assert summed and depth[summed[-1]] < depth[reduction], plan
        assert "Join LeftOuter" in plan[: plan.index(kind)]  # the slicer is joined to the sums
    assert dict(rows_of(planned(["EMEA"]))) == {"Norway": 36.0}
    assert dict(rows_of(planned([None]))) == {None: 5.0, "Oman": 3.0}
