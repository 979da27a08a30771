"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registered
from check import connect, mismatch, type_mismatch

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_equals_sql(spark, con, name):
    frame = registered.queries()[name](spark, FOLDER)
    sql = registered.oracle_sql()[name]
    assert mismatch(frame.toPandas(), con.execute(sql).df()) is None
    assert type_mismatch(frame, con, sql) is None


@pytest.mark.parametrize(
    "name", sorted(set(registered.queries()) - set(registered.oracle_sql()))
)
def test_has_rows(spark, name):
    assert registered.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert registered.entry(spark).count() > 0
