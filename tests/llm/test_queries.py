import pytest

from checks.compare import database, spark_rows, sql_rows
from corpusloom.llm.queries import llm_queries
from corpusloom.llm.sql import llm_sql

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", llm_sql())
def test_rows_equal_sql(spark, name):
    assert spark_rows(llm_queries()[name](spark, SF_DIR)) == sql_rows(database(SF_DIR), llm_sql()[name])


def test_registered():
    import __spark_entry__ as contract

    assert set(llm_queries()) | {"pipeline"} <= set(contract.queries())
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{i}" for i in range(1, 14)]
