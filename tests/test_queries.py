"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

from checks import compare, registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    state, _, _, note = compare.compare(spark, con, FOLDER, name)
    assert state in ("ok", "rows-only"), note


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
