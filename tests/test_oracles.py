"""Every query with an SQL twin gives the twin's names, types and values."""

import check_oracles
import pytest

import __spark_entry__ as driver

ORACLES = driver.oracle_sql()
QUERIES = driver.queries()


@pytest.fixture(scope="module")
def duck(sf):
    return check_oracles.connect(sf)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, duck, name):
    mine = QUERIES[name](spark, sf).toArrow()
    assert check_oracles.compare(mine, duck.execute(ORACLES[name]).to_arrow_table()) == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0
