from pathlib import Path

import pytest

import __spark_entry__ as driver
from workload.compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")
NAMES = [k for k in driver.queries() if k.startswith("op") or k == "pipeline"]


def test_all_are_registered():
    assert {int(k[2:].split("_")[0]) for k in NAMES if k != "pipeline"} == set(range(1, 14))
    assert "pipeline" in NAMES


@pytest.mark.parametrize("key", NAMES)
def test_given_tables(spark, key, vocabulary):
    sql = driver.oracle_sql().get(key)
    if sql:
        assert compare(spark, connect(SF), SF, key, driver.queries()[key], sql) is None
    else:
        assert driver.queries()[key](spark, SF).count() > 0
