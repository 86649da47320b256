import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import SCHEMA, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.selectExpr("*", "1 AS size", "'k' AS keep_id", "2 AS n", "true AS kept", "0 AS score", "5 AS cls")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (7, 0, 0), (7, 0, 0), (9, None, 1), (None, 1, 0)],
                                 "doc_id long, quality int, toxic int")
