"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.01"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 7
