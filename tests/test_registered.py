"""Every registered query against its SQL, on all rows of the smallest scale."""

import inspect

import pytest

import __spark_entry__ as entry
from tallywatch.queries import ORACLES, QUERIES
from tools.compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"
ROWS_ONLY = set()


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, SF) is None


def test_only_the_inexpressible_lacks_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.queries()) >= set(entry.oracle_sql())
    for query in entry.queries().values():
        assert list(inspect.signature(query).parameters) == ["spark", "d"]
