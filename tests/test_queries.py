"""Every registered query against its SQL, on the given tables."""

import pytest

import __spark_entry__ as contract
from check import connect, difference
from tests import conftest

FOLDER = f"{conftest.TABLES}/sf0.001"
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    from cellscope.registry.queries import QUERIES as OWN

    assert set(OWN) <= set(ORACLES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["generasi", "count", "percentage"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, base, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert difference(got, base.execute(ORACLES[name]).df()) is None
