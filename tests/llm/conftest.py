import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def odd_docs(spark):
    from llm_cases import SCHEMA, odd_rows
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture()
def no_docs(spark):
    from llm_cases import SCHEMA
    return spark.createDataFrame([], SCHEMA)
