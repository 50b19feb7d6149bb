import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import ODD, document_rows, frame  # noqa: E402


@pytest.fixture(scope="session")
def corpus():
    return document_rows()


@pytest.fixture(scope="session")
def documents(spark, corpus):
    return frame(spark, corpus).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
