"""Every registered query with SQL gives the same rows as the SQL."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    spark.catalog.clearCache()
    problem = compare(spark, duck, FOLDER, QUERIES[name], ORACLE[name])
    # A table this small may leave a guard without violations.
    assert problem in ("", "no rows")


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
