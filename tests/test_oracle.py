"""Every registered query, against its SQL where it has one."""

import pytest

import __spark_entry__ as contract
from check import compare, duck

QUERIES, SQLS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_equals_sql(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQLS[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQLS)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["id", "date", "label"] and df.count() > 0
