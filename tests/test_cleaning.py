"""Boundary rows of ranges, cohorts, codes and recodes."""

from pyspark.sql import functions as F

from surveyloom.operators import cleaning as C
from surveyloom.profiles.nutrition import ENCODING, PROFILE
from surveyloom.specs import CohortRule, Encoding, Recodes


def values(df, c):
    return [r[c] for r in df.collect()]


def test_ranges_keep_their_bounds(spark):
    df = spark.createDataFrame([(v, str(v)) for v in (39.9, 40.0, 88.0, 130.0, 130.1)] + [(None, "x")], "height_child_cm double, weight_child_kg string")
    out = C.null_outside(df, PROFILE.ranges)
    assert values(out, "height_child_cm") == [None, 40.0, 88.0, 130.0, None, None]
    assert values(out, "weight_child_kg") == ["39.9", "40.0", None, None, None, "x"]
    counts = C.outside_counts(df, PROFILE.ranges).first()
    assert (counts["height_child_cm"], counts["weight_child_kg"]) == (2, 3)


def test_cohorts(spark):
    rule = CohortRule(young_only=frozenset({"food"}))
    df = spark.createDataFrame([(v, 1) for v in (23.0, 23.5, 24.0, 60.0, None, float("nan"))], "age_child_months double, food int")
    out = C.assign_cohort(df, rule)
    assert values(out, "kohort") == ["baduta", "baduta", "balita_tua", "balita_tua", None, None]
    assert values(out, "food") == [1, 1, None, None, 1, 1]
    assert values(C.add_cohort(df, rule, null_is_old=True), "kohort")[-2:] == ["balita_tua"] * 2
    assert values(C.assign_cohort(df.drop("age_child_months"), rule), "kohort") == [None] * 6


def test_codes_only_in_numbers(spark):
    df = spark.createDataFrame([(88.0, 99, 7, "88", 88), (1.0, 5, 8, "1", 2)], "a double, b int, c int, t string, svy_weight int")
    out = C.null_codes(df, PROFILE.special_codes, ["svy_weight"])
    assert [tuple(r) for r in out.collect()] == [(None, None, 7, "88", 88), (1.0, 5, 8, "1", 2)]


def test_swap_for_listed_sources(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (8.0,), (None,)], "measure_position double")
    assert values(C.swap_codes(df, PROFILE.recodes, "ssgi22"), "measure_position") == [2.0, 1.0, 8.0, None]
    assert values(C.swap_codes(df, PROFILE.recodes, "ssgi24"), "measure_position") == [1.0, 2.0, 8.0, None]


def test_recodes(spark):
    df = spark.createDataFrame([(0.0, "99"), (7.0, "16"), (9.0, "3")], "edu_mother double, jkn_owned string")
    out = C.recode(df, PROFILE.recodes, "ski23")
    assert values(out, "edu_mother") == [None, 5.0, None]
    assert values(out, "jkn_owned") == [6.0, 6.0, None]
    assert values(C.recode(df, PROFILE.recodes, "ssgi22"), "edu_mother") == [0.0, 7.0, 9.0]


def test_binary_precedence(spark):
    df = spark.createDataFrame([(float(v), float(v)) for v in range(1, 8)], "kia_book double, area_type double")
    names = ["kia_book", "area_type"]
    out = {s: C.encode_binary(df, names, PROFILE.recodes, s) for s in ("ssgi22", "ski23")}
    assert values(out["ssgi22"], "kia_book") == [1, 1, 0, 0, None, None, None]
    assert values(out["ski23"], "kia_book") == [1, 1, 1, 1, 1, 0, 0]
    assert values(out["ski23"], "area_type") == [1, 0, None, None, None, None, None]
    assert out["ski23"].schema["kia_book"].dataType.simpleString() == "tinyint"


def test_source_column_equals_one_source_at_a_time(spark):
    df = spark.createDataFrame(
        [(s, float(v), float(v)) for s in ("ssgi22", "ssgi24", "ski23", "other") for v in range(0, 12)],
        "source_flag string, edu_mother double, occupation_mother double",
    )
    for rule in (
        lambda d, s: C.recode(d, PROFILE.recodes, s),
        lambda d, s: C.encode_binary(d, ["occupation_mother"], PROFILE.recodes, s),
    ):
        whole = sorted(map(str, rule(df, C.SourceColumn("source_flag")).collect()))
        single = []
        for s in ("ssgi22", "ssgi24", "ski23", "other"):
            single += map(str, rule(df.where(F.col("source_flag") == s), s).collect())
        assert whole == sorted(single)


def test_encode(spark):
    enc = Encoding({"biner": ("b",), "ordinal": ("o",), "meta": ("m",), "drop": ("d",), "kontinu": ("k",)})
    df = spark.createDataFrame([(1, "3", 88, "x", 98.0), (2, "z", 1, "y", 4.5)], "b int, o string, m int, d string, k double")
    out = C.encode(df, enc, Recodes(), "s", (88, 98))
    assert out.columns == ["b", "o", "m", "k"]
    assert [tuple(r) for r in out.collect()] == [(1, 3.0, 88, None), (0, None, 1, 4.5)]


def test_types_by_share(spark):
    rows = [(str(i) if i else "x", str(i) if i > 1 else "x", None) for i in range(20)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out = C.infer_types(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["double", "string", "string"]


def test_profile_sizes():
    assert [len(ENCODING[g]) for g in ("biner", "ordinal", "nominal", "kontinu", "meta", "drop")] == [69, 7, 15, 37, 8, 7]
    assert Encoding.from_json(ENCODING.to_json()) == ENCODING
