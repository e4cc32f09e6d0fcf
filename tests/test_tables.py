"""Availability, stacking, reports, contracts, synthetic rows, files, stream."""

import os

import json

import pytest
from pyspark.sql import functions as F

from surveyloom import session
from surveyloom.operators import availability as A
from surveyloom.operators import combine as U
from surveyloom.operators import contract as G
from surveyloom.operators import synthetic as S
from surveyloom.operators.mapping import clean_names
from surveyloom.profiles import nutrition as N
from surveyloom.queries.indices import lms_rows
from surveyloom.sources import outputs, tables
from surveyloom.streaming.rows import harmonise_stream


def test_matrix_classes(spark):
    shares = [("v3", 0.5, 0.5, 0.9, 0.0), ("v2", 0.4996, 0.6, 0.6, 0.0), ("v1", 0.0, 0.1, 0.7, 0.7), ("v0", 0.0, 0.04, 0.4, 0.4)]
    rows = [(v, s, k, x) for v, a, b, c, o in shares for s, x0 in zip("abc", (a, b, c)) for k, x in (("y", x0), ("o", o))]
    long = spark.createDataFrame(rows, "variable string, source string, cohort string, share double")
    m = A.availability_matrix(long, "abc", "y", "o")
    got = {r["variabel"]: (r["n_sumber_y"], r["n_sumber_o"], r["lintas_sumber_y"]) for r in m.collect()}
    assert got == {"v3": (3, 0, "kuat"), "v2": (2, 0, "sebagian"), "v1": (1, 3, "lemah"), "v0": (0, 0, "tidak")}
    assert m.where("variabel = 'v2'").first()["a_y"] == 0.5
    sets = sorted((r["feature_set"], r["variabel"]) for r in A.feature_sets(m, "y", "o").collect())
    assert sets == [("heterogen", "v1"), ("heterogen", "v2"), ("universal", "v3"), ("y_only", "v2"), ("y_only", "v3")]
    labels = {(r["variabel"], r["cell"]): r["label"] for r in A.cell_labels(m, ["a_y", "b_y", "c_y"]).collect()}
    assert labels["v0", "b_y"] == "absen" and labels["v1", "b_y"] == "parsial" and labels["v3", "a_y"] == "tersedia"


def test_availability_reads_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("'s' AS source_flag", "'k' AS kohort", *[f"id AS c{i}" for i in range(40)]).write.parquet(path)
    shares = A.availability(spark.read.parquet(path), [f"c{i}" for i in range(40)], "source_flag", "kohort")
    plan = shares._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and shares.count() == 40


def test_stack_types(spark):
    a = spark.createDataFrame([(1, 1.0, "x")], "n tinyint, id double, only_a string")
    b = spark.createDataFrame([(2, "K7")], "n int, id string")
    out = U.stack({"a": a, "b": b}, "source_flag")
    assert out.dtypes == [("n", "int"), ("id", "string"), ("only_a", "string"), ("source_flag", "string")]
    assert sorted(map(tuple, out.collect())) == [(1, "1.0", "x", "a"), (2, "K7", None, "b")]
    filled = U.fill_indicators(out.withColumn("n_missing", F.when(F.col("n") == 1, 1)))
    assert sorted((r["n"], r["n_missing"]) for r in filled.collect()) == [(1, 1), (2, 0)]


def test_report(spark):
    rows = [("a", "y", 1), ("a", "y", 0), ("b", "o", None), ("b", None, 1), ("b", "o", 1)]
    df = spark.createDataFrame(rows, "source_flag string, kohort string, stunting_binary long")
    got = {(r["metric"], r["key"]): r["value"] for r in U.validation_report(df, "source_flag", "kohort", "stunting_binary").collect()}
    assert got == {
        ("total_baris", None): 5, ("total_kolom", None): 3, ("baris_per_sumber", "a"): 2, ("baris_per_sumber", "b"): 3,
        ("baris_per_kohort", "y"): 2, ("baris_per_kohort", "o"): 2, ("baris_per_kohort", None): 1,
        ("prevalensi_per_kohort", "y"): 0.5, ("prevalensi_per_kohort", "o"): 1.0,
    }


def contract(spark, matrix=None):
    return G.contract_from_schema(
        N.ENCODING, matrix, N.SOURCES, ("baduta", "balita_tua"), "stunting_binary", N.SOURCE_SHARE, N.YOUNG_SHARE, N.PREVALENCE
    )


def test_synthetic_table_follows_its_contract(spark):
    matrix = spark.createDataFrame([("food_egg", 0.9, 0.02), ("kek_flag", 0.03, 0.0)], "variabel string, ssgi22_baduta double, ssgi22_balita_tua double")
    c = contract(spark, matrix)
    assert c.struct_absent["food_egg"] == [["ssgi22", "balita_tua"]] == c.struct_absent["kek_flag"]
    assert c.cell_counts["ssgi22|baduta"] == 167 and c.domains["edu_mother"] == [1, 2, 3, 4, 5] and "stunting_binary" not in c.domains
    c.columns += ["food_egg_missing", "gone_missing"]
    make = lambda n=3000: S.synthetic_table(spark, c, n, 42, "stunting_binary", frozenset(N.ENCODING["kontinu"]), N.CONTINUOUS)
    df = make()
    assert df.columns == c.columns
    cells = {(r["source_flag"], r["kohort"]): r for r in df.groupBy("source_flag", "kohort").agg(
        F.count("*").alias("n"), F.count("food_egg").alias("egg"), F.sum("food_egg_missing").alias("flag"),
        F.avg("stunting_binary").alias("p"), F.min("height_child_cm").alias("lo"), F.max("svy_weight").alias("w"),
        F.min("id_ruta").alias("hh"), F.max("edu_mother").alias("edu"),
    ).collect()}
    assert {k: r["n"] for k, r in cells.items()} == {(s, k): n for s, k, n in S.cell_quotas(c, 3000)}
    old = cells["ssgi22", "balita_tua"]
    assert old["egg"] == 0 and old["flag"] == old["n"] and abs(old["p"] - 0.2215) < 0.05
    assert cells["ski23", "baduta"]["hh"] >= 3_000_000 and all(r["lo"] >= 45 and r["w"] <= 12 and r["edu"] == 5 for r in cells.values())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    assert sorted(map(str, make(500).repartition(3).collect())) == sorted(map(str, make(500).collect()))
    profile = G.contract_profile(df, "source_flag", "kohort")
    assert G.compare_profiles(profile, G.contract_profile(make(2000), "source_flag", "kohort")).count() == 0
    again = G.contract_from_data(df, N.ENCODING, "source_flag", "kohort", "stunting_binary", N.PREVALENCE)
    assert again.struct_absent["food_egg"] == [["ssgi22", "balita_tua"]] and again.domains["edu_mother"] == [1, 2, 3, 4, 5]
    assert G.Contract.from_json(again.to_json()) == again


def test_conformance_finds_differences(spark):
    base = spark.createDataFrame([("s", "k", 1, "a"), ("t", "k", 2, "b")], "source_flag string, kohort string, x int, y string")
    other = base.select("source_flag", "kohort", F.when(F.col("source_flag") == "s", F.col("x")).alias("x"), F.lit(1.0).alias("z"))
    got = sorted((r["column"], r["source"], r["problem"]) for r in G.compare_profiles(*[G.contract_profile(d, "source_flag", "kohort") for d in (base, other)]).collect())
    assert got == [("x", "t", "absence"), ("y", "s", "missing_right"), ("y", "t", "missing_right"), ("z", "s", "missing_left"), ("z", "t", "missing_left")]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc", "json"])
def test_read_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    spark.createDataFrame([(88.0, "x1"), (2.5, "y")], "a double, t string").write.format(fmt).option("header", True).save(path)
    df = tables.read_source(spark, path, fmt)
    assert dict(df.dtypes) == {"a": "double", "t": "string"} and sorted(r["a"] for r in df.collect()) == [2.5, 88.0]
    with pytest.raises(ValueError):
        tables.read_any(spark, path, "xls")


def test_labels_travel_with_the_table(spark, tmp_path):
    df = tables.with_labels(spark.createDataFrame([(1.0, 2)], "K1 double, `K2 ` int"), {"K1": "Umur"}, {"K1": {1: "Ya"}})
    path = str(tmp_path / "t")
    df.write.parquet(path)
    back = clean_names(spark.read.parquet(path))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    cat, values = tables.catalogue_of(spark.read.parquet(path), "s"), tables.value_labels_of(spark.read.parquet(path), "s")
    assert [(r["code"], r["label"]) for r in cat.orderBy("pos").collect()] == [("K1", "Umur"), ("K2", None)]
    assert [tuple(r) for r in values.collect()] == [("s", "K1", 1.0, "Ya")]
    assert back.columns == ["K1", "K2"] and jobs is not None


def test_spec_files(spark, tmp_path):
    (tmp_path / "d.csv").write_text('standard_name,category,concept,role,s1,s2,extra\na,"C, 1","x ""y""",F,P1 (a),—,E\nb,C,z,META,"P2/x",DERIVASI P1+P2,\n', encoding="utf-8")
    got = [tuple(r) for r in tables.load_dictionary(spark, str(tmp_path / "d.csv"), ["s1", "s2"], other="extra").orderBy("pos", "source").collect()]
    assert got[0] == (1, "a", "C, 1", 'x "y"', "F", "s1", "P1 (a)", "E") and got[3][:2] == (2, "b") and got[3][6] == "DERIVASI P1+P2"
    with pytest.raises(ValueError, match="lacks"):
        tables.load_dictionary(spark, str(tmp_path / "d.csv"), ["s9"])
    (tmp_path / "l.json").write_text(json.dumps([{"Month": "1", "L": "1", "M": "54.5", "S": "0.03"}, {"Month": "0", "L": "1", "M": "49.9", "S": "0.04"}]))
    (tmp_path / "h.json").write_text(json.dumps([{"Height": "65.0", "L": "-0.35", "M": "7.4", "S": "0.08"}]))
    lms = tables.load_lms(spark, {("haz_l", 1): str(tmp_path / "l.json"), ("whz_h", 2): str(tmp_path / "h.json")})
    assert sorted(map(tuple, lms.collect())) == [("haz_l", 1, 0.0, 1.0, 49.9, 0.04), ("haz_l", 1, 1.0, 1.0, 54.5, 0.03), ("whz_h", 2, 65.0, -0.35, 7.4, 0.08)]
    outputs.write_encoding(spark, N.ENCODING, str(tmp_path / "enc"))
    assert tables.load_encoding(spark, str(tmp_path / "enc")) == N.ENCODING
    c = contract(spark)
    outputs.write_contract(spark, c, str(tmp_path / "con"))
    assert outputs.read_contract(spark, str(tmp_path / "con")) == c
    (tmp_path / "m.csv").write_text("variabel,kategori,a_y,n_sumber_y\nv,k,0.5,1\n")
    assert tables.load_matrix(spark, str(tmp_path / "m.csv"), ["a_y"]).dtypes == [("variabel", "string"), ("kategori", "string"), ("a_y", "double"), ("n_sumber_y", "int")]


def test_written_table_has_a_folder_per_cell(spark, tmp_path):
    df = spark.createDataFrame([("a", "y", 1), ("a", None, 2)], "source_flag string, kohort string, x int")
    outputs.write_table(df, str(tmp_path / "t"))
    outputs.write_table(df, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 2 and back.where("kohort = 'y'").first()["x"] == 1
    outputs.write_report(df, str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 2


def test_one_source_is_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(s, k, i) for i, (s, k) in enumerate([("a", "x"), ("a", "y"), ("b", "x"), ("b", None)])]
    df = spark.createDataFrame(rows, "source_flag string, kohort string, v int")
    outputs.write_table(df, path)
    outputs.write_table(df.where("source_flag = 'b'").withColumn("v", F.col("v") + 100), path, keep_others=True)
    got = spark.read.schema(df.schema).parquet(path).collect()
    assert sorted((r["source_flag"], r["kohort"] or "", r["v"]) for r in got) == [("a", "x", 0), ("a", "y", 1), ("b", "", 103), ("b", "x", 102)]
    with pytest.raises(ValueError, match="cells"):
        outputs.write_table(df.select("v"), path, keep_others=True)


def test_intermediate_folders_are_removed(spark):
    kept = session.materialise(spark.range(5), "kept")
    gone = session.materialise(spark.range(5), "gone")
    session.drop_table(gone)
    assert os.path.exists(kept.written_to) and not os.path.exists(gone.written_to)
    mine = {kept.written_to}
    others = session._folders[spark.sparkContext.applicationId] - mine
    session._folders[spark.sparkContext.applicationId] = set(mine)
    session.release(spark)
    assert not os.path.exists(kept.written_to)
    session._folders[spark.sparkContext.applicationId] = others


def test_small_tables_join(spark):
    df = spark.range(50)
    joined = session.join_small(spark.range(100), df.withColumn("v", F.lit(1)), ["id"])
    assert joined.count() == 100 and joined.where("v = 1").count() == 50
    assert session.spread(spark.range(0, 10, 1, 2)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 10, 1, 64)
    assert session.spread(many) is many


class FakeSession:
    """A session with a master and settings, for the choice of the checkpoint folder."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_checkpoint_folder_comes_from_the_session(spark):
    assert session.checkpoint_root(FakeSession("yarn", {"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(FakeSession("yarn", {}))
    out = session.materialise(spark.range(5), "x")
    assert out.count() == 5 and session.checkpoint_root(spark) in out.inputFiles()[0]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(85.0 + i % 7, 11.0, float(i % 60), 1.0 + i % 2, 1.0 + i % 2, 88 if i % 5 == 0 else 1, 3.0) for i in range(200)]
    schema = "H double, W double, A double, S double, P double, food_egg int, edu_mother double"
    batch = spark.createDataFrame(rows, schema)
    batch.write.parquet(str(tmp_path / "in"))
    lms = spark.createDataFrame(lms_rows(), tables.LMS)
    names = {"H": "height_child_cm", "W": "weight_child_kg", "A": "age_child_months", "S": "sex_child", "P": "measure_position", "food_egg": "food_egg", "edu_mother": "edu_mother"}
    stream = harmonise_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "ssgi22", names, lms, N.PROFILE)
    q = stream.writeStream.format("memory").queryName("rows_out").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    want = harmonise_stream(batch, "ssgi22", names, lms, N.PROFILE)
    got = spark.table("rows_out")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
