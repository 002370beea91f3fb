"""Every registered query against its SQL, over the whole smallest sample."""

import os

import pytest

import __spark_entry__ as entry_module
from voltmark_checks.compare import connect, differences
from voltmark_checks.queries import QUERIES

SAMPLE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="needs the sample tables")


@pytest.fixture(scope="module")
def con():
    return connect(SAMPLE)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, con, name):
    count, problem = differences(spark, con, SAMPLE, name)
    assert problem is None
    assert count > 0
