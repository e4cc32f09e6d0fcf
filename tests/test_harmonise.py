"""The stages together, on two small raw sources with hand-computed results."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from surveyloom.functions.columns import cut_code
from surveyloom.operators.mapping import names_where
from surveyloom.plans.availability import availability
from surveyloom.plans.convergence import check_convergence
from surveyloom.plans.harmonise import harmonise, map_sources
from surveyloom.profiles.nutrition import PROFILE
from surveyloom.queries.indices import lms_rows
from surveyloom.sources.tables import LMS

#: name, role, cell of the first source, cell of the second
NAMES = [
    ("haz_score", "LABEL", "DERIVASI H1+A1", "DERIVASI H2"),
    ("id_ruta", "META", "CASE", "IDR"),
    ("pii_identitas", "HAPUS_PRIVASI", "NIK", "—"),
    ("sex_child", "FITUR_UTAMA", "S1", "S2"),
    ("age_child_months", "FITUR_UTAMA", "A1", "A2 (bulan)"),
    ("weight_child_kg", "FITUR_UTAMA", "W1", "w2*"),
    ("height_child_cm", "FITUR_UTAMA", "H1", "H2"),
    ("measure_position", "FITUR_PENDUKUNG", "P1", "P2"),
    ("edu_mother", "FITUR_UTAMA", "E1", "E2"),
    ("anc_freq_doc_t1", "FITUR_UTAMA", "V1", "V2"),
    ("anc_freq_mid_t1", "FITUR_UTAMA", "X1", "—"),
    ("food_egg", "FITUR_UTAMA", "F1", "F2"),
    ("imm_bcg", "FITUR_UTAMA", "I1", "I2"),
    ("imm_vit_a_count", "FITUR_UTAMA", "J1", "—"),
    ("ttd_count", "FITUR_UTAMA", "T1", "T2"),
    ("asset_tv", "FITUR_UTAMA", "R1", "R2"),
    ("asset_car", "FITUR_UTAMA", "R2", "R3"),
    ("asset_gold", "FITUR_UTAMA", "R3", "—"),
    ("svy_weight", "META", "WT", "WT"),
]


@pytest.fixture(scope="module")
def dictionary(spark):
    rows = [(i, n, "cat", n, role, s, c) for i, (n, role, a, b) in enumerate(NAMES, 1) for s, c in (("ssgi22", a), ("ssgi24", b))]
    return spark.createDataFrame(rows, "pos int, standard_name string, category string, concept string, role string, source string, code_cell string")


@pytest.fixture(scope="module")
def lms(spark):
    return spark.createDataFrame(lms_rows(), LMS)


def first(i):
    """Row ``i`` of the first source; rows 0 to 3 carry the odd values."""
    row = dict(CASE=float(i), NIK=f"n{i}", S1=1.0 + i % 2, A1=float(i % 59), W1=9.0, H1=60.0 + i % 40, P1=1.0, E1=2.0, V1=2.0, X1=1.0,
               F1=1.0 + i % 2, I1=1.0, J1=2.0, T1=90.0, R1=1.0 + i % 2, R2=1.0 + (i // 2) % 2, R3=1.0 + i % 3 % 2, WT=88.0, extra=1)
    if i == 0:  # height that is also a missing code, codes in counts, standing when lying is usual
        row.update(A1=30.0, H1=88.0, V1=98.0, T1=998.0, P1=1.0)
    if i == 1:  # out of range, unknown cohort
        row.update(A1=61.0, H1=130.1, W1=0.5)
    if i == 2:  # all inputs of composites unknown
        row.update(A1=10.0, V1=None, X1=None, F1=None, I1=None, T1=None)
    if i == 3:  # old child: module answers are cleared
        row.update(A1=24.0, F1=1.0)
    return row


def second(i):
    return dict(IDR=f"K{i}", S2="1" if i % 2 else "2", A2=str(i % 50), W2=10.0, H2=70.0 + i % 30, P2=1.0, E2=float(i % 9), V2=1.0 if i % 4 else None,
                F2=2.0, I2=float(1 + i % 4), T2=None, R2=1.0, R3=2.0, WT=1.5)


@pytest.fixture(scope="module")
def sources(spark):
    a = spark.createDataFrame([tuple(first(i).values()) for i in range(400)], "CASE double, NIK string, S1 double, A1 double, W1 double, H1 double, P1 double, E1 double, V1 double, X1 double, F1 double, I1 double, J1 double, T1 double, R1 double, R2 double, R3 double, WT double, extra int")
    b = spark.createDataFrame([tuple(second(i).values()) for i in range(400)], "IDR string, S2 string, A2 string, W2 double, H2 double, P2 double, E2 double, V2 double, F2 double, I2 double, T2 double, R2 double, R3 double, WT double")
    return {"ssgi22": a, "ssgi24": b}


def rows_of(df):
    return {(r["source_flag"], r["id_ruta"]): r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def parity(sources, dictionary, lms):
    return rows_of(harmonise(sources, dictionary, lms, PROFILE, impute=None))


def test_columns(parity, dictionary):
    row = parity["ssgi22", "0.0"]
    assert "NIK" not in row and "extra" not in row and "measure_position" not in row
    assert set(row) <= {*names_where(dictionary), *PROFILE.computed}
    assert len(parity) == 800 and parity["ssgi24", "K1"]["anc_freq_mid_t1"] is None


def test_parity_quirks(parity):
    zero, one, two, three = (parity["ssgi22", f"{i}.0"] for i in range(4))
    # a height of 88 is scored first and cleared afterwards; raw codes count in the composites
    assert zero["height_child_cm"] is None and zero["haz_score"] is not None
    assert zero["ANC_total_visit"] is None and zero["anc_freq_doc_t1"] is None  # 98 + 1 = 99, itself a code
    assert zero["ttd_count"] is None and zero["TTD_compliance"] == 1
    assert one["kohort"] is None and one["age_child_months"] is None and one["height_child_cm"] is None and one["weight_child_kg"] is None
    assert two["ANC_total_visit"] is None and two["food_diversity_score"] is None and two["TTD_compliance"] is None
    assert two["imunisasi_lengkap"] == 0
    assert three["kohort"] == "balita_tua" and three["food_egg"] is None and three["food_diversity_score"] is None
    assert zero["svy_weight"] == 88.0


def test_recodes_by_source(parity):
    for i in range(4, 40):
        r, raw = parity["ssgi24", f"K{i}"], second(i)
        assert r["edu_mother"] == {1: 1, 2: 1, 3: 1, 4: 2, 5: 3, 6: 4, 7: 5, 8: 5}.get(raw["E2"])
        assert r["imm_bcg"] == {1: 1, 2: 1, 3: 1, 4: 0}[raw["I2"]]
        # the all-vaccines flag counts raw answers of 1 only
        assert r["imunisasi_lengkap"] == int(raw["I2"] == 1)
        assert r["sex_child"] == (1 if i % 2 else 0) and r["age_child_months"] == float(i % 50)
        assert parity["ssgi22", f"{i}.0"]["edu_mother"] == 2.0


def test_position_is_swapped_for_one_source(parity, lms):
    r = parity["ssgi22", "25.0"]  # 25 months, raw 1 means standing: no correction
    points = {(ind, sex, x): m for ind, sex, x, _, m, _ in lms_rows()}
    m = points["haz_h", 2, 24.0] + (points["haz_h", 2, 28.0] - points["haz_h", 2, 24.0]) / 4
    assert r["haz_score"] == pytest.approx((85.0 / m - 1) / 0.0425)
    s = parity["ssgi24", "K24"]  # raw 1 means lying: 0.7 cm off
    assert s["haz_score"] == pytest.approx(((94.0 - 0.7) / points["haz_h", 2, 24.0] - 1) / 0.0425)


def test_wealth_needs_three_assets_per_source(parity):
    assert all((r["wealth_index"] is None) == (s == "ssgi24") for (s, _), r in parity.items())


def test_clean_mode(sources, dictionary, lms, parity):
    clean = rows_of(harmonise(sources, dictionary, lms, PROFILE, mode="clean", impute=None))
    zero = clean["ssgi22", "0.0"]
    assert zero["height_child_cm"] == 88.0 and zero["ANC_total_visit"] == 1.0 and zero["TTD_compliance"] is None
    assert clean["ssgi24", "K5"]["imunisasi_lengkap"] == 1 and second(5)["I2"] == 2.0
    for key, r in clean.items():
        if r["wealth_index"] is not None:
            assert r["wealth_index"] == pytest.approx(-parity[key]["wealth_index"])
    with pytest.raises(ValueError):
        harmonise(sources, dictionary, lms, PROFILE, mode="other")


def test_imputed(sources, dictionary, lms, parity):
    profile = replace(PROFILE, impute=replace(PROFILE.impute, min_values=30))
    out = rows_of(harmonise(sources, dictionary, lms, profile))
    assert set(out) == set(parity)
    for key, r in out.items():
        before = parity[key]
        for c, v in before.items():
            if v is not None:
                assert r[c] == v, c
        if r["kohort"] and key[0] == "ssgi24":
            assert r["edu_mother"] in (1.0, 2.0, 3.0, 4.0, 5.0)
            assert r["anc_freq_doc_t1"] == before["anc_freq_doc_t1"]
            assert r["anc_freq_doc_t1_missing"] == int(before["anc_freq_doc_t1"] is None)
            # asked but never answered gives an indicator; never asked gives none
            assert r["ttd_count_missing"] == 1
        if key[0] == "ssgi24":
            assert r.get("anc_freq_mid_t1_missing", 0) == 0
        assert all(v in (0, 1) for c, v in r.items() if c.endswith("_missing"))


def test_availability(sources, dictionary):
    shares, matrix = availability(sources, dictionary, PROFILE)
    got = {r["variabel"]: r for r in matrix.collect()}
    assert set(got) == {n for n, role, *_ in NAMES if role not in ("META",) and n not in ("haz_score", "pii_identitas", "measure_position")}
    assert got["anc_freq_mid_t1"]["ssgi24_baduta"] == 0.0 and got["sex_child"]["n_sumber_baduta"] == 2
    n = {(r["source"], r["cohort"]): r["n"] for r in shares.where("variable = 'food_egg'").collect()}
    young = sum(1 for i in range(400) if first(i)["A1"] < 24)
    assert n["ssgi22", "baduta"] == young and n["ssgi22", "balita_tua"] == 400 - young


def test_mapping_outcome(sources, dictionary):
    mapped = map_sources(sources, dictionary, PROFILE)
    status = {(r["source"], r["standard_name"]): r["status"] for r in mapped.outcome.collect()}
    assert status["ssgi24", "weight_child_kg"] == "mapped" and status["ssgi24", "anc_freq_mid_t1"] == "skipped"
    assert status["ssgi22", "haz_score"] == "skipped" and status["ssgi22", "pii_identitas"] == "unmatched"


def test_missing_measurement_stops_early(sources, dictionary, lms):
    broken = {"ssgi22": sources["ssgi22"].drop("H1").withColumn("tinggi_x", F.lit(1))}
    with pytest.raises(ValueError, match="height_child_cm"):
        harmonise(broken, dictionary, lms, PROFILE, impute=None)


def test_convergence_of_encoded_rows(sources, dictionary, lms):
    profile = replace(PROFILE, impute=replace(PROFILE.impute, min_values=30))
    rows = harmonise(sources, dictionary, lms, profile, impute=None)
    out = check_convergence(rows, profile, sweeps=6)
    assert out.trace.select("iteration").distinct().count() == 6
    assert out.features.where("feature IN ('haz_score', 'anc_freq_doc_t1', 'stunting_binary')").count() == 0
    assert out.cells.count() == 4 and out.features.count() >= 4 and out.top.count() == out.features.where("measured").count()


def test_counts_come_with_the_rows(spark, sources, dictionary, lms, tmp_path):
    """Counts of the stages are filled by the write; the report is of what was written."""
    from surveyloom.plans.harmonise import Watch, finish

    watch = Watch()
    rows = harmonise(sources, dictionary, lms, PROFILE, impute=None, watch=watch)
    finish(rows, str(tmp_path / "out"), PROFILE, watch)
    got = {(r["stage"], r["source"], r["name"]): r["n"] for r in watch.counts(spark).collect()}
    assert got["outside", "ssgi22", "rows"] == got["outside", "ssgi24", "rows"] == 400
    assert got["outside", "ssgi22", "height_child_cm"] == 1 and got["outside", "ssgi22", "weight_child_kg"] == 1
    assert got["outside", "ssgi22", "age_child_months"] == 1 and got["outside", "ssgi24", "height_child_cm"] == 0
    valid = {r["source_flag"]: r["n"] for r in rows.groupBy("source_flag").agg(F.count("haz_score").alias("n")).collect()}
    assert {s: got["label", s, "valid"] for s in valid} == valid
    written = spark.read.option("header", True).csv(str(tmp_path / "out" / "counts"))
    assert written.count() == len(got)


def test_a_source_imputed_through_all_stages_does_not_depend_on_others(sources, dictionary, lms):
    """Rows draw by what they hold: a further survey changes no value, by lines or trees."""
    small = replace(PROFILE, impute=replace(PROFILE.impute, sweeps=2, min_leaf=5))
    for impute in ("linear",):
        both = rows_of(harmonise(sources, dictionary, lms, small, impute=impute))
        alone = rows_of(harmonise({"ssgi24": sources["ssgi24"]}, dictionary, lms, small, impute=impute))
        for key, row in alone.items():
            for c, v in row.items():
                other = both[key][c]
                assert other == (pytest.approx(v, abs=1e-6) if isinstance(v, float) else v), (key, c)


@pytest.mark.parametrize("name", ["harmonised_rows", "harmonised_clean_mode"])
def test_generated_code_is_short_enough_to_be_compiled(spark, monkeypatch, name):
    """Above 8000 bytes a method is not compiled, and rows are copied from projection to projection."""
    from surveyloom.queries.harmonised import QUERIES
    from surveyloom.session import DEFAULTS, configure

    with monkeypatch.context() as m:
        # the adaptive plan shows its code only after it has run
        m.setitem(DEFAULTS, "spark.sql.adaptive.enabled", "false")
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    configure(spark)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert len(sizes) > 3 and max(sizes) <= int(DEFAULTS["spark.sql.codegen.hugeMethodLimit"])


def test_a_cut_keeps_rows_and_parts(spark):
    df = spark.range(100).repartition(7)
    cut = cut_code(df)
    assert cut.rdd.getNumPartitions() == 7
    assert sorted(r["id"] for r in cut.collect()) == list(range(100))
