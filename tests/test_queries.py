import pytest

from checks.compare import database, spark_rows, sql_rows
from checks.queries import all_queries
from checks.sql import oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(oracle()) == set(all_queries())


@pytest.mark.parametrize("name", all_queries())
def test_rows_equal_sql(spark, db, name):
    assert spark_rows(all_queries()[name](spark, SF_DIR)) == sql_rows(db, oracle()[name])


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
