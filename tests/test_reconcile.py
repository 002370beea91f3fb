"""Two states of a table compared by checksums."""

import random
from collections import Counter

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from voltmark import Lake, land_rows
from voltmark.operators import differing
from voltmark.plans import questions, silver

SCHEMA = "region string, site string, n int, x double"


def brute(left, right, keys):
    groups = {}
    for side, rows in enumerate((left, right)):
        for row in rows:
            groups.setdefault(tuple(row[k] for k in keys), (Counter(), Counter()))[side][repr(row)] += 1
    return sorted(((*g, sum(a.values()), sum(b.values())) for g, (a, b) in groups.items() if a != b), key=repr)


@pytest.fixture(scope="module")
def states():
    chance = random.Random(8)
    rows = [(chance.choice(["e", "w", None]), chance.choice("abc"), chance.randrange(5), chance.choice([1.5, None, float("nan")])) for _ in range(300)]
    changed = rows[:50] + [(r, s, n + 1, x) for r, s, n, x in rows[50:53]] + rows[53:]
    return rows, changed


def test_against_brute_force(spark, states):
    rows, changed = states
    left = spark.createDataFrame(rows, SCHEMA).repartition(4)
    regions, sites = [F.col("region")], [F.col("site")]
    for other in (changed, changed + rows[:1], rows[1:], rows + [rows[0]] * 2, [], [r for r in rows if r[0] != "e"], [(None, "b", None, 2.0)]):
        right = spark.createDataFrame(other, SCHEMA).repartition(3)
        found = differing(left, right, [regions, sites], ["n", "x", "region", "site"])
        assert found.columns == ["region", "site", "left_rows", "right_rows"]
        assert rows_of(found) == brute(rows, other, (0, 1))
        assert rows_of(differing(left, right, [[*regions, *sites]], ["n", "x"])) == brute(rows, other, (0, 1))
    same = spark.createDataFrame(rows[::-1], SCHEMA)
    assert rows_of(differing(left, same, [regions, sites], left.columns)) == []
    with pytest.raises(ValueError):
        differing(left, same, [], ["n"])


def test_nulls_in_other_columns_are_other_rows(spark):
    left = spark.createDataFrame([("g", None, 1)], "g string, a int, b int")
    right = spark.createDataFrame([("g", 1, None)], "g string, a int, b int")
    assert rows_of(differing(left, right, [[F.col("g")]], ["a", "b"])) == [("g", 1, 1)]


def test_only_days_that_differ_are_read_again(spark, golden, tmp_path):
    stored, live = golden.read("fact_energy_consumption"), Lake(spark, str(tmp_path))
    more = [("n1", "m-3", "quay", "2023-10-29 05:00:00", "1", "1", "1", "1", "1"), ("n2", "m-4", "mesa", "2023-12-24 05:00:00", "1", "1", "1", "1", "1")]
    extra = silver.fact_energy_consumption(land_rows(spark, "raw_meter_readings", more, "t"))
    live.overwrite("fact_energy_consumption", stored.unionByName(extra))
    found = questions.drifted_site_months(stored, live.read("fact_energy_consumption"))
    assert rows_of(found) == [("mesa", "2023-12", 0, 1), ("quay", "2023-10", 1, 2)]
    plan = plan_of(found)
    assert plan.count("PartitionFilters: [reading_date#") == 2 and "2023-10-28" not in plan
    # Rows are combined to checksums before they are shuffled, and rows of the two sides never meet.
    assert plan.count("partial_sum") >= 2 and plan.count("FullOuter") == 1
