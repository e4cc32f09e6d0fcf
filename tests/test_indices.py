"""Reference lookup and scores against a scalar computation on a grid."""

import bisect
import math

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import indices as I
from surveyloom.queries.indices import lms_rows
from surveyloom.sources.tables import LMS
from surveyloom.specs import Measures

TABLE = {}
for ind, sex, x, l, m, s in lms_rows():
    TABLE.setdefault((ind, sex), []).append((x, l, m, s))


def reference(ind, sex, x):
    points = sorted(TABLE.get((ind, sex), []))
    if x is None or not points or not points[0][0] <= x <= points[-1][0]:
        return None
    at = bisect.bisect_left([p[0] for p in points], x)
    if points[at][0] == x:
        return points[at][1:]
    lo, hi = points[at - 1], points[at]
    share = (x - lo[0]) / (hi[0] - lo[0])
    return tuple(a + share * (b - a) for a, b in zip(lo[1:], hi[1:]))


def score(value, lms):
    if lms is None or value is None or value <= 0:
        return None
    l, m, s = lms
    return math.log(value / m) / s if l == 0 else ((value / m) ** l - 1) / (l * s)


def bounded(z, lo, hi):
    return None if z is None or z < lo or z > hi else z


@pytest.fixture(scope="module")
def lms(spark):
    return spark.createDataFrame(lms_rows(), LMS)


def test_lookup_on_a_grid(spark, lms):
    keys = [(ind, float(sex), x / 4) for ind in ("haz_l", "haz_h", "waz", "whz_l", "whz_h", "none") for sex in (1, 2, 3) for x in range(-4, 500, 3)]
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], "i int, ind string, sex double, x double")
    got = {r["i"]: (r["r_l"], r["r_m"], r["r_s"]) for r in I.lookup(df, I.segments(lms), "sex", {"r": ("ind", "x")}).collect()}
    assert len(got) == len(keys)
    for i, (ind, sex, x) in enumerate(keys):
        want = reference(ind, int(sex), x)
        if want is None:
            assert got[i] == (None, None, None), keys[i]
        else:
            assert got[i] == pytest.approx(want, abs=1e-12), keys[i]


def test_all_scores(spark, lms):
    rows = [
        (h, w, a, s, p)
        for h in (None, 45.0, 61.3, 85.0, 88.0, 119.5)
        for w in (None, 0.0, 3.2, 9.9, 20.0)
        for a in (None, 0.0, 11.0, 23.5, 24.0, 37.0, 60.0, 61.0)
        for s in (None, 1.0, 2.0, 3.0, 1.5)
        for p in (None, 1.0, 2.0, 8.0)
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, height_child_cm double, weight_child_kg double, age_child_months double, sex_child double, measure_position double")
    got = {r["i"]: r for r in I.growth_indices(df, lms, Measures()).collect()}
    assert len(got) == len(rows)
    for i, (h, w, a, s, p) in enumerate(rows):
        haz = waz = whz = None
        if s in (1.0, 2.0) and a is not None:
            hc = h
            if h is not None and a < 24 and p is not None and p != 1:
                hc = h + 0.7
            if h is not None and a >= 24 and p == 1:
                hc = h - 0.7
            haz = bounded(score(hc, reference("haz_l" if a < 24 else "haz_h", int(s), a)), -6, 6)
            waz = bounded(score(w, reference("waz", int(s), a)), -6, 5)
            whz = bounded(score(w, reference("whz_l" if a < 24 else "whz_h", int(s), h)), -5, 5)
        r = got[i]
        for name, want in (("haz_score", haz), ("waz_score", waz), ("whz_score", whz)):
            assert r[name] == (None if want is None else pytest.approx(want, abs=1e-9)), (name, rows[i])
        assert r["stunting_binary"] == (None if haz is None else int(haz < -2))


def test_median_scores_zero_and_bounds(spark, lms):
    m = reference("haz_h", 1, 24.0)[1]
    spread = m * 0.0425
    rows = [(m,), (m - 2 * spread,), (m - 6 * spread,), (m + 6 * spread,), (m + 6.01 * spread,)]
    df = spark.createDataFrame([(h, 10.0, 24.0, 1.0) for (h,) in rows], "height_child_cm double, weight_child_kg double, age_child_months double, sex_child double")
    got = I.growth_indices(df, lms, Measures()).collect()
    assert abs(got[0]["haz_score"]) < 1e-6 and got[0]["stunting_binary"] == 0
    assert got[4]["haz_score"] is None and got[4]["stunting_binary"] is None


def test_plan_is_broadcast_hash_joins(spark, lms):
    df = spark.range(5).selectExpr("double(id) AS height_child_cm", "double(id) AS weight_child_kg", "double(id) AS age_child_months", "1D AS sex_child")
    df = df.withColumn("sex_child", 1.0 + F.col("age_child_months") % 2)
    plan = I.growth_indices(df, lms, Measures())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_large_reference_joins_by_shuffle(spark, lms):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(60).selectExpr("50D + id AS height_child_cm", "10D AS weight_child_kg", "double(id) AS age_child_months", "1D + id % 2 AS sex_child")
        out = I.growth_indices(df, lms, Measures())
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
        by_shuffle = sorted(map(str, out.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert by_shuffle == sorted(map(str, I.growth_indices(df, lms, Measures()).collect()))


def test_a_hot_month_is_spread_when_the_reference_is_shuffled(spark, lms):
    rows = spark.range(4000).selectExpr("id", "'haz_h' AS ind", "1D AS sex", "CASE WHEN id < 3600 THEN 30D ELSE 24D + id % 30 END AS x")
    fixed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in fixed}

    def largest(salts):
        out = I.lookup(rows, I.segments(lms), "sex", {"r": ("ind", "x")}, salts=salts)
        return out, out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    try:
        for k, v in fixed.items():
            spark.conf.set(k, v)
        _, alone = largest(1)
        out, spread = largest(16)
        by_salt = sorted(map(str, out.collect()))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert alone >= 3600 and spread < 1600
    assert by_salt == sorted(map(str, I.lookup(rows, I.segments(lms), "sex", {"r": ("ind", "x")}).collect()))
