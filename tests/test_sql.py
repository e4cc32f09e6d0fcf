"""Every driver query beside its SQL in DuckDB, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_sql  # noqa: E402

from surveyloom.queries import all_queries, all_sql  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")

ROWS_ONLY = {"label_similarity", "impute_linear", "synthetic_table", "harmonised_imputed", "convergence_of_sources", "convergence_of_trees"}


@pytest.fixture(scope="module")
def con():
    return check_sql.connect(SF)


def test_only_these_have_no_sql():
    assert set(all_queries()) - set(all_sql()) == ROWS_ONLY
    assert set(all_sql()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query(spark, con, name):
    assert check_sql.compare(all_queries()[name](spark, SF), con, all_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(ROWS_ONLY - {"convergence_of_sources", "convergence_of_trees"}))
def test_rows(spark, name):
    assert all_queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import importlib

    assert importlib.import_module("__spark_entry__").entry(spark).count() == 12
