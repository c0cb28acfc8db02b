import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("8")
    yield spark
    spark.stop()


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
