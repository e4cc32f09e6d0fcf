"""All eight statuses of the dictionary audit, value labels, personal data, summaries."""

from surveyloom.operators import audit as A
from surveyloom.plans.audit import audit
from surveyloom.profiles.nutrition import PII_KEYWORDS

DICT = "pos int, standard_name string, category string, concept string, role string, source string, code_cell string, other_code string"
ROWS = [
    ("none", "x", "—"), ("bare", "x", "DERIVASI"), ("whole", "x", "DERIVASI K1+k_2"), ("part", "x", "DERIVASI K1+Z9+Y8"),
    ("lost", "x", "Z9*"), ("same", "Umur Balita", "K1"), ("close", "Berat badan balita", "K2*"), ("far", "qqq", "K3"),
]
COLUMNS = [("K1", "umur balita"), ("K_2", "Berat anak waktu lahir"), ("K3", "Nomor HP orang tua"), ("NIK", None), ("x4", "Nama, lengkap")]
VALUES = [("K3", 1.0, "Ya"), ("K3", 2.0, "Tidak"), ("K1", 1.0, "Laki-laki")]


def tables(spark):
    d = spark.createDataFrame([(i, n, "cat", c, "role", "s", cell, "o") for i, (n, c, cell) in enumerate(ROWS, 1)], DICT)
    c = spark.createDataFrame([("s", i, n, t) for i, (n, t) in enumerate(COLUMNS)], "source string, pos int, code string, label string")
    v = spark.createDataFrame([("s", *r) for r in VALUES], "source string, code string, value double, text string")
    e = spark.createDataFrame(
        [(1, "far", "s", 1.0, "ya"), (2, "far", "s", 2.0, "bukan"), (3, "far", "s", 9.0, "lain"), (4, "same", "s", 1.0, "laki")],
        "pos int, standard_name string, source string, value double, keyword string",
    )
    return d, c, v, e


def test_report(spark):
    out = audit(*tables(spark), PII_KEYWORDS)
    got = {r["nama_standar"]: r for r in out.report.collect()}
    assert [got[n]["status"] for n, *_ in ROWS] == [
        A.ABSENT, A.DERIVED_BARE, A.DERIVED_OK, A.DERIVED_LOST, A.NOT_FOUND, A.MATCH, A.MATCH_CLOSE, A.REVIEW,
    ]
    assert got["whole"]["kode_ditemukan"] == "K1, K_2" and got["part"]["keterangan"] == "Hilang: Z9, Y8"
    assert got["lost"]["keterangan"] == "Kode 'Z9' tidak ada di file. Cek codebook."
    assert got["same"]["kemiripan_label"] == "1.00" and got["same"]["keterangan"] == ""
    assert got["close"]["keterangan"] == A.NOTE_STAR and got["close"]["kode_ditemukan"] == "K_2"
    assert got["far"]["value_label_aktual"] == "1.0=Ya; 2.0=Tidak"
    assert got["far"]["keterangan"] == (
        "[VL? 2 harap 'bukan' dapat 'Tidak'] [VL? 9 harap 'lain' dapat '-'] " + A.NOTE_REVIEW
    )
    summary = out.summary.first()
    assert (summary["total"], summary["cocok"], summary["derivasi"], summary["komponen_hilang"]) == (8, 2, 3, 1)
    pivot = out.by_category.first().asDict()
    assert {k: v for k, v in pivot.items() if k not in ("sumber", "kategori")} == {
        "cocok": 2, "derivasi_hilang": 1, "derivasi_ok": 2, "perlu_tinjau": 1, "tidak_ditemukan": 1, "tidak_tersedia": 1,
    }
    assert {r["code"]: r["kata_kunci"] for r in out.pii.collect()} == {"K3": "nomor hp", "NIK": "nik", "x4": "nama"}
    dump = {r["code"]: (r["label"], r["value_labels"]) for r in out.metadata.collect()}
    assert dump["K3"] == ("Nomor HP orang tua", "1.0=Ya; 2.0=Tidak") and dump["NIK"] == ("", "")


def test_word_is_whole_and_first_keyword_wins(spark):
    df = spark.createDataFrame([("a", "partai rw 5 dan rt"), ("b", "sertifikat"), ("kk", ""), ("c", "ID  RUTA!")], "code string, label string")
    got = {r["code"]: r["kata_kunci"] for r in A.pii_scan(df, PII_KEYWORDS).collect()}
    assert got == {"a": "rt", "kk": "kk", "c": "id ruta"}


def test_ten_labels_of_many(spark):
    v = spark.createDataFrame([("s", "c", float(i), str(i)) for i in range(300)], "source string, code string, value double, text string")
    assert A.first_labels(v, 10).first()["value_labels"].split("; ") == [f"{i}.0={i}" for i in range(10)]
    plan = A.first_labels(v, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
