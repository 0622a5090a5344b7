"""Every registered query against its SQL, value by value, on the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification import oracles
from verification.check import connect, difference
from verification.registry import REGISTRY

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, small, duck, name):
    assert difference(QUERIES[name](spark, small), duck, ORACLES[name]) is None


def test_the_check_can_fail(spark, small, duck):
    result = QUERIES["q3_minmax"](spark, small)
    sql = ORACLES["q3_minmax"]
    assert difference(result, duck, sql.replace("SELECT * FROM extremes", "SELECT * FROM extremes LIMIT 3"))
    off = sql.replace("SELECT * FROM extremes", "SELECT airline, min_delay + 1 AS min_delay, max_delay FROM extremes")
    assert difference(result, duck, off)


def test_registry_is_complete():
    assert set(ORACLES) <= set(QUERIES)
    assert set(REGISTRY) == set(oracles.all_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
