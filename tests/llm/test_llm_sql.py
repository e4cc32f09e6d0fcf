"""Queries beside their SQL in DuckDB, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import check_sql  # noqa: E402

from surveyloom.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return check_sql.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert check_sql.compare(QUERIES[name](spark, SF), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, con, name):
    documents = con.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert QUERIES[name](spark, SF).count() >= documents
