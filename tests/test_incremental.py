"""Incremental runs against full ones, and appends that count as a whole."""

import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import BILLS, DEVICES, READINGS, SITES, rows_of
from pyspark.sql import functions as F

from voltmark import Lake, land_rows, run_all, run_incremental
from voltmark.plans import incremental, silver
from voltmark.registry import table

FACT = "fact_energy_consumption"
BUILT = ("dim_region", "dim_device", "dim_site", FACT, "fact_energy_cost", "agg_daily_consumption_by_site", "kpi_co2_by_region")
RAW = {"raw_site": SITES, "raw_device": DEVICES, "raw_meter_readings": READINGS, "raw_billing": BILLS}


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def deliver(lake, name, rows, day):
    """Rows landed on a day of January 2024; none if ``day`` is None."""
    landed = land_rows(lake.spark, name, rows, f"day {day}")
    when = F.lit(None if day is None else f"2024-01-{day:02} 00:00:00").cast("timestamp")
    lake.append(name, landed.withColumn("ingested_at", when).coalesce(1))


def first(lake):
    for name, rows in RAW.items():
        deliver(lake, name, rows, 1)
    return run_incremental(lake)


def assert_as_rebuilt(lake, tmp_path):
    other = Lake(lake.spark, str(tmp_path / f"other-{random.random()}"))
    for name in RAW:
        other.append(name, lake.read(name).coalesce(1))
    run_all(other)
    for name in BUILT:
        assert repr(rows_of(lake.read(name))) == repr(rows_of(other.read(name))), name  # NaN as text


def files(lake, name):
    """Data files of each partition, with the times of their last change."""
    found = {}
    for folder, _, names in os.walk(lake.location(name)):
        found[os.path.basename(folder)] = {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def reading(key, when, kwh, site="quay", device="m-3"):
    return (key, device, site, when, kwh, kwh, "230", "1", "0.5")


def test_the_first_run_builds_all(lake, tmp_path):
    assert first(lake)[FACT] == 9
    assert_as_rebuilt(lake, tmp_path)
    assert run_incremental(lake) == {}  # nothing new


def test_only_days_that_change_are_written(lake, tmp_path):
    first(lake)
    before = files(lake, FACT)
    # b1 stays on its day with another value, d1 moves to the day of b2, new ones come on 2023-11-02 and on a new day.
    rows = [reading("b1", "2023-10-29 00:00:00", "41"), reading("d1", "2023-10-30 01:00:00", "3", "reef", "m-5")]
    rows += [reading("n1", "2023-11-02 01:00:00", "5"), reading("n2", "2024-02-29 01:00:00", "7"), reading(None, "2023-10-28 00:00:00", "1")]
    rows += [reading("a1", "no time", "9")]  # dropped, and so does not replace a1
    deliver(lake, "raw_meter_readings", rows, 2)
    written = run_incremental(lake)
    assert set(written) == {FACT, "dim_site", "agg_daily_consumption_by_site"}
    after = files(lake, FACT)
    changed = {d for d in before | after if d.startswith("reading_date") and before.get(d) != after.get(d)}
    days = ("2023-10-29", "2023-10-30", "2023-11-01", "2023-11-02", "2024-02-29")
    assert changed == {f"reading_date={d}" for d in days}
    assert before["reading_date=2023-10-28"] == after["reading_date=2023-10-28"]
    assert written[FACT] == lake.read(FACT).where("reading_date <> '2023-10-28'").count()
    assert_as_rebuilt(lake, tmp_path)


def test_a_day_that_loses_its_last_row_goes(lake, tmp_path):
    first(lake)
    deliver(lake, "raw_meter_readings", [reading("b2", "2023-11-02 08:00:00", "48")], 2)
    run_incremental(lake)
    assert "reading_date=2023-10-30" not in files(lake, FACT) and "reading_date=2023-10-30" not in files(lake, "daily_state")
    assert_as_rebuilt(lake, tmp_path)


def test_replays_late_and_untimed_rows_do_not_win(lake, tmp_path):
    first(lake)
    deliver(lake, "raw_meter_readings", [reading("b1", "2023-10-30 00:00:00", "1")], 5)
    deliver(lake, "raw_billing", [("i-1", "mesa", "2024-01", "1", "1", "1", "1", "1", "EUR")], 5)
    run_incremental(lake)
    for day in (3, 5, None):
        rows = [reading("b1", "2023-12-24 00:00:00", str(day)), reading(f"late {day}", "2023-10-28 00:00:00", "2")]
        deliver(lake, "raw_meter_readings", READINGS + rows, day)
        deliver(lake, "raw_billing", [*BILLS, ("i-1", "quay", "2024-02", "7", "7", "7", "7", str(day), None)], day)
        run_incremental(lake)
    assert_as_rebuilt(lake, tmp_path)


def test_bills_move_between_groups_with_nulls(lake, tmp_path):
    first(lake)
    state = rows_of(lake.read("billing_state").where("site_id = 'quay'"))
    rows = [("i-1", None, None, "x", "1", "1", "NaN", None, None), ("i-2", "mesa", "2023-11", None, "1", "1", "3", "4", "NOK")]
    deliver(lake, "raw_billing", rows, 2)
    assert set(run_incremental(lake)) == {"fact_energy_cost", "dim_site", "kpi_co2_by_region"}
    assert rows_of(lake.read("billing_state").where("site_id = 'quay'")) == state
    deliver(lake, "raw_billing", [("i-1", "mesa", None, "1", "1", "1", "2", "1", None)], 3)
    run_incremental(lake)
    assert_as_rebuilt(lake, tmp_path)


def test_changed_dimensions(lake, tmp_path):
    first(lake)
    deliver(lake, "raw_site", [("quay", "Quay 10", "Norway", "APAC", None, "5.3", "store", "1", None)], 2)
    deliver(lake, "raw_device", [("m-3", "quay", "water_meter", "W", "m3", "gate", "true")], 2)
    assert set(run_incremental(lake)) == {"dim_region", "dim_device", "dim_site", "kpi_co2_by_region"}
    assert_as_rebuilt(lake, tmp_path)


def test_random_deliveries(lake, tmp_path):
    chance = random.Random(3)
    first(lake)
    for day in (2, 3, 2):
        rows = [
            reading(
                chance.choice(["a1", "b1", "c1", "k1", "k2", "k3", None]),
                chance.choice(["2023-10-28 00:00:00", "2023-11-01 05:00:00", "2023-12-01 00:00:00", "never"]),
                chance.choice(["1", "2", "NaN", "x", "4"]),
                chance.choice(["quay", "mesa", None, "gone"]),
            )
            for _ in range(6)
        ]
        deliver(lake, "raw_meter_readings", rows, day)
        bills = [
            (chance.choice(["i-1", "i-3", "j", None]), chance.choice(["quay", "reef", None]), chance.choice(["2023-10", None, "2024-01"]), "8", "1", "1", chance.choice(["2", "NaN", ""]), "4", "EUR")
            for _ in range(4)
        ]
        deliver(lake, "raw_billing", bills, day)
        run_incremental(lake)
    assert_as_rebuilt(lake, tmp_path)


@pytest.mark.parametrize("at", ["daily_state", "dim_site", "note"])
def test_an_interrupted_run_is_made_good(lake, tmp_path, monkeypatch, at):
    first(lake)
    deliver(lake, "raw_meter_readings", [reading("b2", "2023-11-02 08:00:00", "48"), reading("z", "2023-10-28 08:00:00", "1")], 2)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        if at == "daily_state":
            replace = Lake.replace_partitions
            patch.setattr(Lake, "replace_partitions", lambda self, name, *a: stop() if name == at else replace(self, name, *a))
        else:
            patch.setattr(incremental, {"dim_site": "_gold", "note": "_note"}[at], stop)
        with pytest.raises(RuntimeError, match="stopped"):
            run_incremental(lake)
    run_incremental(lake)
    assert_as_rebuilt(lake, tmp_path)
    assert run_incremental(lake) == {}


def test_other_runs_and_truncation_lead_to_a_rebuild(lake, tmp_path):
    first(lake)
    deliver(lake, "raw_meter_readings", [reading("n", "2023-11-02 01:00:00", "5")], 2)
    run_all(lake)
    assert set(run_incremental(lake)) == set(BUILT)
    lake.truncate(["raw_meter_readings"])
    assert run_incremental(lake)[FACT] == 0
    assert_as_rebuilt(lake, tmp_path)
    lake.reset("silver", confirm=True)
    assert set(run_incremental(lake)) == set(BUILT)
    assert_as_rebuilt(lake, tmp_path)


def test_incremental_runs_need_parts(spark, tmp_path):
    with pytest.raises(ValueError, match="Parquet"):
        run_incremental(Lake(spark, str(tmp_path), fmt="delta"))


# -- appends -----------------------------------------------------------------------


@pytest.mark.parametrize("name", ["raw_meter_readings", FACT])
def test_an_append_without_its_mark_is_not_read(spark, lake, name):
    def rows(some):
        landed = land_rows(spark, "raw_meter_readings", some, "t")
        return landed if name == "raw_meter_readings" else silver.fact_energy_consumption(landed)

    assert lake.append(name, rows(READINGS[:2])) == 2
    assert lake.append(name, rows(READINGS[2:5])) == 3
    assert lake.append(name, rows(READINGS[5:6])) == 1
    assert lake.position(name)[1] == 2
    assert rows_of(lake.read(name), "reading_id") == sorted((r[0],) for r in READINGS[:6])
    os.remove(f"{lake._appended(name, lake.location(name))}/part=00000002/_SUCCESS")
    assert rows_of(lake.read(name), "reading_id") == sorted((r[0],) for r in READINGS[:5])
    assert lake.append(name, rows(READINGS[6:8])) == 2  # beside what is left of the other
    assert rows_of(lake.read(name), "reading_id") == sorted((r[0],) for r in READINGS[:5] + READINGS[6:8])
    assert rows_of(lake.read(name, after=1), "reading_id") == sorted((r[0],) for r in READINGS[6:8])
    assert lake.read(name, after=9).isEmpty() and lake.read(name).columns == table(name).columns
    lake.overwrite(name, rows(READINGS[:1]))
    assert lake.read(name).count() == 1
    lake.overwrite(name, rows(READINGS[:1]))
    assert [f for f in os.listdir(lake.path(name)) if f.startswith("a")] == []


def test_a_failed_append_leaves_the_table_as_it_was(spark, lake):
    bills = land_rows(spark, "raw_billing", BILLS, "t")
    lake.append("raw_billing", bills)
    with pytest.raises(Exception, match="no"):
        lake.append("raw_billing", bills.withColumn("currency", F.expr("CAST(raise_error('no') AS string)")))
    assert lake.read("raw_billing").count() == len(BILLS)
    assert lake.append("raw_billing", bills.limit(1)) == 1
    assert lake.read("raw_billing").count() == len(BILLS) + 1


def test_partitions_are_replaced_one_for_one(spark, lake):
    lake.overwrite(FACT, silver.fact_energy_consumption(land_rows(spark, "raw_meter_readings", READINGS, "t")))
    day = datetime(2023, 10, 29).date()
    rows = lake.read(FACT)
    assert lake.replace_partitions(FACT, rows.where("reading_id = 'a2'"), [day, day + timedelta(1)]) == 1
    left = {r.reading_date for r in lake.read(FACT).collect()}
    assert left == {day - timedelta(1), day, datetime(2023, 11, 1).date(), datetime(2023, 11, 2).date()}
    assert lake.exists(FACT)
    with pytest.raises(ValueError, match="partition"):
        lake.replace_partitions("raw_billing", rows, [day])
    lake.append(FACT, lake.read(FACT).limit(1))
    with pytest.raises(ValueError, match="appended"):
        lake.replace_partitions(FACT, rows, [day])
