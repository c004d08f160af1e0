"""Every registered query with a SQL counterpart, on the smallest data set."""

import __spark_entry__ as driver
import oracle
import pytest

SF = "/root/testdata/sf0.001"
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_names_agree():
    assert set(ORACLES) <= set(driver.queries())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert oracle.compare(driver.queries()[name](spark, SF), con, ORACLES[name]) is None
