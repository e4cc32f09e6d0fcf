"""Null rules of the composites, and the wealth index against a NumPy decomposition."""

import numpy as np
import pytest

from surveyloom.operators import composites as K
from surveyloom.specs import Composites


def test_null_rules(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 90.0), (None, 2.0, 89.9), (None, None, None), (88.0, 1.0, 998.0)], "a double, b double, c double"
    )
    row = df.selectExpr(
        f"{K.row_sum(['a', 'b'])} AS s", f"{K.row_count_of(['a', 'b'])} AS n", f"{K.at_least('c', 90)} AS t",
        f"{K.all_equal(['a', 'b'])} AS e",
    ).collect()
    assert [tuple(r) for r in row] == [(2.0, 2.0, 1, 1), (2.0, 0.0, 0, 0), (None, None, None, 0), (89.0, 1.0, 1, 0)]


def brute(x):
    x = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    sd = x.std(axis=0)
    z = np.where(sd > 0, (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1), 0)
    pc = z @ np.linalg.svd(z, full_matrices=False)[2][0]
    return -pc if np.corrcoef(pc, x.sum(axis=1))[0, 1] < 0 else pc


def sample(n, seed):
    rng = np.random.default_rng(seed)
    wealth = rng.normal(size=n)
    x = np.column_stack([(wealth + rng.normal(size=n) * s > 0) + 1.0 for s in (0.4, 0.8, 1.5)] + [np.ones(n)])
    x[rng.random((n, 4)) < 0.1] = np.nan
    return x


@pytest.mark.parametrize("orient", ["code_sum", "ownership"])
def test_wealth_per_source(spark, orient):
    data = {"a": sample(400, 1), "b": sample(300, 2)}
    rows = [(s, i, *[None if np.isnan(v) else float(v) for v in r]) for s, x in data.items() for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "source string, i int, asset_1 double, asset_2 double, asset_3 double, asset_4 double")
    got = K.wealth_index(df, ["asset_1", "asset_2", "asset_3", "asset_4"], by=["source"], orient=orient)
    sign = 1 if orient == "code_sum" else -1
    for s, x in data.items():
        mine = np.array([r["wealth_index"] for r in got.where(got.source == s).orderBy("i").collect()])
        assert np.abs(mine - sign * brute(x)).max() < 1e-9
    one = K.wealth_index(df.where(df.source == "a").drop("source"), ["asset_1", "asset_2", "asset_3", "asset_4"], orient=orient)
    mine = np.array([r["wealth_index"] for r in one.orderBy("i").collect()])
    assert np.abs(mine - sign * brute(data["a"])).max() < 1e-9


def test_wealth_needs_three_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "asset_1 double, asset_2 double")
    assert K.wealth_index(df, ["asset_1", "asset_2"]).columns == df.columns


def test_unknown_column_counts_nothing(spark):
    x = sample(200, 3)[:, :3]
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r], None) for i, r in enumerate(x)], "i int, asset_1 double, asset_2 double, asset_3 double, asset_4 double")
    got = K.wealth_index(df, [f"asset_{i}" for i in range(1, 5)]).orderBy("i").collect()
    assert np.abs(np.array([r["wealth_index"] for r in got]) - brute(x)).max() < 1e-9


def test_composites_of_present_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 95.0, 1.0, 0.0)], "anc_freq_a double, food_a double, ttd_count double, imm_a double, imm_vit_a_count double")
    out = K.add_composites(df, df.columns, Composites())
    row = out.first()
    assert (row["ANC_total_visit"], row["food_diversity_score"], row["TTD_compliance"], row["imunisasi_lengkap"]) == (1.0, 0.0, 1, 1)
    assert "wealth_index" not in out.columns


def test_moments_far_from_zero(spark):
    """Sums of squares about a centre of each task's own lose no digits; columns may be unknown in whole parts of the rows."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 3)) * [1.0, 2.0, 0.5] + [1e9, -1e9, 3.0]
    x[:, 1] += x[:, 0] - 1e9
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:1000, 2] = np.nan
    groups = np.array(["a", "b", None], dtype=object)[rng.integers(0, 3, len(x))]
    rows = [(g, *[None if np.isnan(v) else float(v) for v in r], None) for g, r in zip(groups, x)]
    schema = "g string, p double, q double, r double, never double"
    names = ["p", "q", "r", "never"]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, schema).repartition(parts)
        got = {row["g"]: row for row in K.cross_moments(df, names, ["g"]).collect()}
        whole = K.cross_moments(df, names).collect()
        for key, row in [*got.items(), ("all", whole[0])]:
            own = x if key == "all" else x[groups == key] if key is not None else x[[g is None for g in groups]]
            assert row["n"] == len(own) and row["mean_never"] is None and row["cov_p__never"] == 0
            off = np.where(np.isnan(own), 0.0, own - np.nanmean(own, axis=0))
            want = off.T @ off / len(own)
            for i, a in enumerate(names[:3]):
                assert row[f"mean_{a}"] == pytest.approx(np.nanmean(own[:, i]), rel=1e-15, abs=1e-9)
                for j in range(i, 3):
                    assert row[f"cov_{a}__{names[j]}"] == pytest.approx(want[i, j], rel=1e-6, abs=1e-6)
    plan = K.cross_moments(df, names, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "Join" not in plan
    assert K.cross_moments(df.limit(0), names, ["g"]).collect() == []
