"""Scalar expressions against plain Python and pandas."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions import columns as C
from surveyloom.functions import similarity

TEXTS = [
    "1", " 1 ", "x", "5d", "1f", "", " ", "1e3", ".5", "-3.", "+7", "1,000", "0x1F", "nan", "NaN", "inf", "-Infinity",
    "1_000", "1e", "--1", "1 2", "007", "true", None,
]


def test_text_to_number_like_pandas(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r["i"]: r["n"] for r in df.select("i", C.numeric(df, "t").alias("n")).collect()}
    for i, t in enumerate(TEXTS):
        want = pd.to_numeric(pd.Series([t], dtype="object"), errors="coerce").iloc[0]
        assert got[i] == (None if pd.isna(want) else float(want)), t


def test_numbers_to_number(spark):
    df = spark.createDataFrame([(1.5, 3, True, "a"), (float("nan"), None, None, "b")], "d double, i int, b boolean, s string")
    rows = df.select(*[C.numeric(df, c).alias(c) for c in "dib"]).collect()
    assert tuple(rows[0]) == (1.5, 3.0, 1.0)
    assert tuple(rows[1]) == (None, None, None)


def test_nan_to_null_keeps_metadata(spark):
    df = spark.createDataFrame([(float("nan"), "x")], "d double, s string")
    df = df.select(F.col("d").alias("d", metadata={"label": "weight"}), "s")
    out = C.nan_to_null(df)
    assert out.first()["d"] is None and out.schema["d"].metadata == {"label": "weight"}


def test_map_and_binary(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (8.0,), (None,)], "x double")
    got = df.selectExpr(
        f"{C.map_codes('x', {0: None, 1: 5, 2: 1})} AS m", f"{C.map_codes('x', {1: 2, 2: 1}, 'x')} AS s",
        f"{C.binary('x', (1,), (0, 2))} AS b",
    ).collect()
    assert [r["m"] for r in got] == [None, 5.0, 1.0, None, None]
    assert [r["s"] for r in got] == [0.0, 2.0, 1.0, 8.0, None]
    assert [r["b"] for r in got] == [0, 1, 0, None, None]


def test_sql_text_of_odd_names(spark):
    df = spark.createDataFrame([(1.0, "it's \\ odd")], ["a`b c", "t"])
    out = C.rewrite(df, {"a`b c": f"{C.ref('a`b c')} + 1", "hit": f"t = {C.text(chr(105) + 't' + chr(39) + 's ' + chr(92) + ' odd')}"})
    assert tuple(out.first()) == (2.0, "it's \\ odd", True)


@pytest.mark.parametrize("skew", [1.0, 0.0, -0.35])
def test_lms_formula(spark, skew):
    values = [-1.0, 0.0, 5.0, 10.0, 14.2, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["z"] for r in df.select(C.lms_z(F.col("v"), F.lit(skew), F.lit(10.0), F.lit(0.1)).alias("z")).collect()]
    for v, z in zip(values, got):
        if v is None or v <= 0:
            assert z is None
        else:
            want = math.log(v / 10) / 0.1 if skew == 0 else ((v / 10) ** skew - 1) / (skew * 0.1)
            assert z == pytest.approx(want, abs=1e-12)


def test_snap_ties_go_down(spark):
    df = spark.createDataFrame([(v,) for v in (-5.0, 1.4, 1.5, 1.6, 2.5, 9.0, None)], "v double")
    assert [r[0] for r in df.select(C.snap_expr(F.col("v"), [3, 1, 2])).collect()] == [1, 1, 1, 2, 2, 3, None]
    assert [r[0] for r in df.select(C.snap_expr(F.col("v"), [4])).collect()] == [4] * 6 + [None]


def test_number_text(spark):
    df = spark.createDataFrame([(1.0,), (12345678.0,), (0.25,), (None,)], "v double")
    assert [r[0] for r in df.select(C.number_text(F.col("v"))).collect()] == ["1.0", "12345678.0", "0.25", None]


def test_normal_text(spark):
    df = spark.createDataFrame([("  Tinggi/Badan (CM)_x ",), ("É, à!",), ("---",), (None,)], "t string")
    assert [r[0] for r in df.select(C.normal_text(F.col("t"))).collect()] == ["tinggi badan cm _x", "é à", "", ""]


def test_hashed_draws_ignore_partitions(spark):
    def draw(n):
        df = spark.range(0, 2000, 1, n).select("id", C.hash_uniform(F.col("id"), "c", 7).alias("u"), C.hash_normal(F.col("id"), "c", 7).alias("z"))
        return {r["id"]: (r["u"], r["z"]) for r in df.collect()}

    a, b = draw(2), draw(9)
    assert a == b
    u, z = zip(*a.values())
    assert 0 <= min(u) and max(u) < 1 and abs(sum(u) / len(u) - 0.5) < 0.03
    assert abs(sum(z) / len(z)) < 0.1 and abs(sum(x * x for x in z) / len(z) - 1) < 0.15


def test_similarity_like_difflib(spark):
    from difflib import SequenceMatcher

    pairs = [("Berat Badan (kg)", "BB balita saat ukur"), ("Umur", "umur"), ("", "x"), ("a b c d", "d c b a"), ("x", None)]
    df = spark.createDataFrame(pairs, T.StructType([T.StructField(c, T.StringType()) for c in "ab"]))
    got = [r[0] for r in df.select(similarity.label_similarity(F.col("a"), F.col("b"))).collect()]
    norm = lambda t: " ".join("".join(ch if ch.isalnum() or ch == "_" else " " for ch in (t or "").lower()).split())
    for (a, b), sim in zip(pairs, got):
        a, b = norm(a), norm(b)
        if not a or not b:
            assert sim == 0
            continue
        ta, tb = set(a.split()), set(b.split())
        assert sim == pytest.approx(max(len(ta & tb) / len(ta | tb), SequenceMatcher(None, a, b).ratio()))


def test_two_decimals_is_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (0.295,), (None,)], "v double")
    assert [r[0] for r in df.select(similarity.two_decimals(F.col("v"))).collect()] == ["0.12", "0.38", "0.29", None]
