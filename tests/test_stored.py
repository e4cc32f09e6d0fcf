"""Stored profiles beside the rows they are of."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.operators import stored
from surveyloom.operators.impute import eligibility
from surveyloom.specs import ImputeRule

BY = ["source_flag", "kohort"]
RULE = ImputeRule(min_values=20, never=frozenset({"y"}))


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        x, y = 1e6 + rng.normal(), float(rng.integers(0, 3))
        gap = rng.random(2) < 0.3
        rows.append(("abc"[i % 3], None if i % 40 == 0 else "xy"[i % 2], None if gap[0] else x, None if gap[1] else y, 5.0 if i % 3 else None))
    return spark.createDataFrame(rows, "source_flag string, kohort string, x double, y double, c double").cache()


def numbers(df):
    return {
        (r["source_flag"], r["kohort"], r["column"]): tuple(r[c] for c in ("n", "filled", "known", "min", "max", "mean", "squares")) for r in df.collect()
    }


def test_parts_together_are_the_whole(spark, table):
    columns = ["x", "y", "c"]
    whole = numbers(stored.profile_rows(table, columns, BY))
    cut = F.xxhash64("x", "y") % 3
    parts = [stored.profile_rows(table.where(F.pmod(cut, F.lit(3)) == k), columns, BY) for k in range(3)]
    merged = numbers(stored.merge_profiles([*parts, parts[0].limit(0)], BY))
    assert set(merged) == set(whole)
    for key, want in whole.items():
        assert merged[key][:5] == want[:5]
        for got, value in zip(merged[key][5:], want[5:]):
            assert got is None if want[2] == 0 else got == pytest.approx(value, rel=1e-9, abs=1e-9)


def test_a_column_one_table_lacks(table):
    a = stored.profile_rows(table.where("source_flag <> 'b'"), ["x", "y"], [])
    b = stored.profile_rows(table.where("source_flag = 'b'"), ["x"], [])
    got = {r["column"]: (r["n"], r["filled"]) for r in stored.merge_profiles([a, b], []).collect()}
    known = table.where("source_flag <> 'b'").agg(F.count("y")).first()[0]
    assert got["y"] == (900, known) and got["x"][0] == 900


def test_a_survey_is_read_by_itself(spark, table, tmp_path):
    path, columns = str(tmp_path / "profiles"), ["x", "y", "c"]
    for s in "abcb":
        stored.store_profile(table.where(F.col("source_flag") == s), columns, BY, path)
    kept = stored.read_profile(spark, path)
    key = lambda r: (r["source_flag"], str(r["kohort"]), r["feature"])
    got = sorted(map(str, sorted(stored.eligible(kept, BY, RULE).select("source_flag", "kohort", "feature", "n", "filled", "missing_rate", "eligible", "indicator").collect(), key=key)))
    want = sorted(map(str, sorted(eligibility(table, columns, BY, RULE).select("source_flag", "kohort", "feature", "n", "filled", "missing_rate", "eligible", "indicator").collect(), key=key)))
    assert got == want
    shares = {(r["variable"], r["source"], r["cohort"]): r["share"] for r in stored.shares(kept, *BY).collect()}
    assert shares["c", "a", "x"] == 0.0 and shares["c", "b", "y"] == 1.0
    cells = stored.contract_rows(kept, *BY)
    assert cells.where("cohort is null").count() == 0 and cells.where("absent").count() == 2
