from pathlib import Path

import pytest

import __spark_entry__ as driver
from workload.compare import compare, connect
from workload.queries import REGISTERED

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def connection():
    pytest.importorskip("duckdb")
    return connect(SF)


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


def test_every_query_has_sql():
    assert set(REGISTERED) <= set(driver.queries())
    assert set(REGISTERED) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("key", list(REGISTERED))
def test_query_agrees_with_sql(spark, connection, key):
    problem = compare(spark, connection, SF, key, driver.queries()[key], driver.oracle_sql()[key])
    assert problem is None, problem
