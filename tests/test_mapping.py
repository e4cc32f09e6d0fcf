"""Dictionary cells, matching, claims, renames."""

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import mapping as M
from surveyloom.sources.tables import catalogue_of

SPEC = "pos int, standard_name string, category string, concept string, role string, source string, code_cell string"


def spec(spark, rows):
    return spark.createDataFrame([(i, n, "c", n, r, "s", cell) for i, (n, cell, r) in enumerate(rows, 1)], SPEC)


def columns(spark, names, source="s"):
    return spark.createDataFrame([(source, i, n, None) for i, n in enumerate(names)], "source string, pos int, code string, label string")


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2)], [" a​ ", "b é"])
    assert M.clean_names(df).columns == ["a", "b"]
    with pytest.raises(ValueError, match="collide"):
        M.clean_names(spark.createDataFrame([(1, 2)], ["a", "a "]))


def test_cells(spark):
    cells = ["P1802C (WUS)", "B6R1*", "​ P10 ", "x/y", "—", "", "DERIVASI P1+B2C+tes+7", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = df.select(M.clean_cell(F.col("c")).alias("code"), *[e.alias(n) for n, e in M.parse_cell(F.col("c")).items()]).collect()
    assert [r["code"] for r in got][:4] == ["P1802C", "B6R1", "P10", "x"]
    assert [r["status"] for r in got] == ["tersedia"] * 4 + ["tidak_tersedia"] * 2 + ["derivasi", "tidak_tersedia"]
    assert got[1]["needs_check"] and not got[0]["needs_check"]
    assert got[6]["components"] == ["P1", "B2C", "tes"]


def test_suffix_follows_the_person(spark):
    d = spec(spark, [("occupation_mother", "P410", "F"), ("age_father", "P410", "F"), ("weight", "P410", "F"), ("one", "Q1", "F"), ("none", "Z", "F")])
    c = columns(spark, ["P410_KK", "P410_IBU", "P410_AYAH", "Q1_x_y"])
    got = {r["standard_name"]: r["code"] for r in M.match_mapping(d, c).collect()}
    assert got == {"occupation_mother": "P410_IBU", "age_father": "P410_AYAH", "weight": None, "one": "Q1_x_y", "none": None}


def test_equal_name_beats_suffix_and_last_wins(spark):
    d = spec(spark, [("a", " p1 ", "F")])
    assert M.match_mapping(d, columns(spark, ["P1_IBU", "P1", "p1 "])).first()["code"] == "p1 "


def test_claims(spark):
    d = spec(spark, [("a", "K1", "F"), ("b", "k1", "F"), ("a", "K1", "F"), ("c", "—", "F"), ("d", "derivasi K1", "F"), ("e", "K9", "F")])
    got = [(r["standard_name"], r["status"], r["reason"]) for r in M.rename_map(d, columns(spark, ["K1"])).orderBy("pos").collect()]
    assert got == [
        ("a", "mapped", None), ("b", "claimed", "k1->K1 bentrok a"), ("a", "mapped", None), ("c", "skipped", None),
        ("d", "skipped", None), ("e", "unmatched", "K9"),
    ]


def test_audit_match_order(spark):
    wanted = spark.createDataFrame([("s", "AB"), ("s", "ab_c"), ("s", "zz"), ("s", None)], "source string, k string")
    got = {r["k"]: r["found"] for r in M.match_audit(wanted, columns(spark, ["ab", "AB", "A B_C"]), "k").collect()}
    assert got == {"AB": "AB", "ab_c": "A B_C", "zz": None, None: None}


def test_audit_match_of_a_name_that_many_share(spark):
    """A row meets one row per key, not every column that has the name."""
    wanted = spark.createDataFrame([("s", k) for k in ["id", "I_D", "Id ", None] * 50], "source string, k string")
    found = M.match_audit(wanted, columns(spark, ["ID", "id", "iD"] * 200 + ["I D"]), "k")
    assert {(r["k"], r["found"]) for r in found.collect()} == {("id", "id"), ("I_D", "I D"), ("Id ", "I D"), (None, None)}
    assert found.count() == 200
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_rename_and_privacy(spark):
    df = spark.createDataFrame([(1, 2, 3, "n")], ["K1", "K2", "extra", "NIK"])
    d = spec(spark, [("a", "k1", "F"), ("b", "K2*", "F"), ("pii", "NIK", "HAPUS_PRIVASI"), ("p2", "—", "HAPUS_PRIVASI")])
    codes = M.pii_codes(d, "HAPUS_PRIVASI")
    assert codes == {"s": {"NIK"}}
    safe = M.drop_columns(df, codes["s"])
    pairs = M.rename_pairs(M.rename_map(d, catalogue_of(safe, "s")))["s"]
    out = M.allow_list(M.apply_rename(safe, pairs), ["a", "b", "pii"])
    assert out.columns == ["a", "b"] and M.names_where(d, role="F") == ["a", "b"]
    assert M.names_where(d, prefix="p") == ["pii", "p2"]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["TB_anak", "x"])
    with pytest.raises(ValueError, match="TB_anak"):
        M.require_columns(df, {"height": ["tb"]})
    M.require_columns(df, {"x": ["x"]})


def test_allow_list_prunes_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(path)
    plan = M.allow_list(spark.read.parquet(path), ["b"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<b:bigint>" in plan
