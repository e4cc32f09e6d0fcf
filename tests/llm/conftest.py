import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return corpus.rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return corpus.frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    return corpus.frame(spark, corpus.odd_rows())


@pytest.fixture(scope="session")
def empty(spark):
    return corpus.frame(spark, [])
