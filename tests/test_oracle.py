"""Every registered query with SQL agrees with DuckDB on the small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, duck  # noqa: E402

from delaykit.catalogue import REGISTRY  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SLOW = {"published_totals_gbt", "published_totals_lr"}  # minutes each; tools/check_oracle.py runs them
WITH_SQL = sorted(n for n, e in REGISTRY.items() if e.sql and n not in SLOW)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_sql(spark, con, name):
    entry = REGISTRY[name]
    problem, _, _ = compare(spark, con, FOLDER, entry.run, entry.sql)
    assert problem is None, problem


def test_entry_runs(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).limit(1).count() == 1
    assert set(driver.oracle_sql()) <= set(driver.queries())
