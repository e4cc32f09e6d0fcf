"""Text likeness, dictionary audit, value labels, personal data and status reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions import similarity
from surveyloom.functions.columns import normal_text as normal_text_expr
from surveyloom.operators import audit as ops
from surveyloom.operators.mapping import parse_cell
from surveyloom.queries.base import (
    CATALOGUE_SQL, DICTIONARY, DICTIONARY_SQL, LABEL, catalogue, derive, dictionary, load, select,
)
from surveyloom.session import spread
from surveyloom.queries.mapping import _CLEAN, _MAIN, _SQUEEZE, _STATUS

#: Keywords of the personal-data scan, words and phrases, first hit wins.
KEYWORDS = ("phone", "email", "e mail", "name", "address", "of the", "de la", "com", "license", "un")
CONCEPT = "small red ring"
LABELS = {
    "source": "p_brand",
    "code": "'P' || CAST(p_partkey % 40 AS STRING)",
    "value": "CAST(p_partkey AS DOUBLE)",
    "text": "CASE p_size % 3 WHEN 0 THEN 'Ya, ' || p_name WHEN 1 THEN 'Tidak' END",
}
EXPECTED = {
    "pos": "CAST(p_partkey AS INT)",
    "standard_name": "'n' || CAST(p_partkey % 40 AS STRING)",
    "source": "p_brand",
    "value": "CAST(p_partkey + p_size % 2 AS DOUBLE)",
    "keyword": "CASE p_partkey % 2 WHEN 0 THEN 'ya' ELSE 'tidak' END",
}
#: The dictionary and columns of the audit: derived cells with all, some and no components, and labels that
#: have the words of the concept and one more, whose characters are far apart.
_PART = "CAST(p_partkey AS STRING)"
AUDIT_CELL = (
    f"CASE WHEN p_partkey % 10 = 4 AND p_size % 3 = 1 THEN 'DERIVASI' WHEN p_partkey % 10 = 4 AND p_size % 3 = 2 "
    f"THEN 'DERIVASI p' || {_PART} || '_a+P' || {_PART} || '_A' ELSE code_cell END"
)
FILLER = "q" * 40
AUDIT_LABEL = (
    "CASE WHEN p_partkey % 10 = 2 THEN '' WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN '' "
    f"WHEN p_size % 2 = 0 THEN split_part(p_name, ' ', 2) || ' {FILLER} ' || split_part(p_name, ' ', 1) END"
)
AUDIT_DICTIONARY = {**DICTIONARY, "code_cell": AUDIT_CELL.replace("code_cell", f"({DICTIONARY['code_cell']})")}
AUDIT_DICTIONARY_SQL = select(AUDIT_DICTIONARY, "part")
AUDIT_CATALOGUE_SQL = CATALOGUE_SQL.replace(LABEL, AUDIT_LABEL)
REPORT = {
    "sumber": "o_orderstatus",
    "kategori": "o_orderpriority",
    "nama_standar": "CAST(o_orderkey AS STRING)",
    "status": (
        "CASE o_custkey % 8 WHEN 0 THEN 'TIDAK TERSEDIA (sesuai kamus)' WHEN 1 THEN 'DERIVASI (tanpa komponen kode)' "
        "WHEN 2 THEN 'DERIVASI - semua komponen OK' WHEN 3 THEN 'DERIVASI - komponen HILANG' WHEN 4 THEN 'TIDAK DITEMUKAN' "
        "WHEN 5 THEN 'COCOK' WHEN 6 THEN 'COCOK (label agak beda)' ELSE 'PERLU TINJAU (label beda)' END"
    ),
}


def normal_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(load(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", normal_text_expr(F.col("text")).alias("words"))


def token_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    return part.select("p_partkey", F.round(similarity.token_jaccard(F.lit(CONCEPT), F.col("p_name")), 9).alias("jaccard"))


def label_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """With the character ratio, which has no SQL form."""
    part = load(spark, sf, "part")
    return part.select("p_partkey", "p_name", similarity.label_similarity(F.lit(CONCEPT), F.col("p_name")).alias("similarity"))


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return derive(load(spark, sf, "part"), LABELS)


def metadata_dump(spark: SparkSession, sf: str) -> DataFrame:
    columns = catalogue(spark, sf).withColumn("code", F.concat(F.lit("P"), (F.col("pos") % 40).cast("string")))
    return ops.metadata_dump(columns, _labels(spark, sf))


def derived_components(spark: SparkSession, sf: str) -> DataFrame:
    rows = dictionary(spark, sf).withColumns(parse_cell(F.col("code_cell")))
    found = ops.component_audit(rows.where(F.col("status") == "derivasi"), catalogue(spark, sf))
    return found.select(
        "source", "pos", F.array_join("present", ", ").alias("present"), F.array_join("lost", ", ").alias("lost")
    )


def label_expectations(spark: SparkSession, sf: str) -> DataFrame:
    expected = derive(load(spark, sf, "part"), EXPECTED)
    found = expected.select("source", "standard_name").distinct().withColumn(
        "found", F.concat(F.lit("P"), F.substring("standard_name", 2, 9))
    )
    return ops.expectation_notes(expected, found, _labels(spark, sf))


def audit_report(spark: SparkSession, sf: str) -> DataFrame:
    """All eight statuses. Labels equal the concept, are empty, or share two words of three."""
    expected = derive(load(spark, sf, "part"), {**EXPECTED, "standard_name": "'asset_' || CAST(p_partkey AS STRING)"})
    rows = derive(load(spark, sf, "part"), AUDIT_DICTIONARY)
    return ops.audit_dictionary(rows, catalogue(spark, sf, AUDIT_LABEL), _labels(spark, sf), expected).drop("kode_eppgbm")


def pii_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(load(spark, sf, "documents").select("doc_id", "text"))
    return ops.pii_scan(docs, KEYWORDS, code=None, label="text").select("doc_id", "kata_kunci")


def pii_scan_columns(spark: SparkSession, sf: str) -> DataFrame:
    found = ops.pii_scan(catalogue(spark, sf), ("ring", "p10c", "red widget", "id"))
    return found.select("source", "pos", "code", "kata_kunci")


def status_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ops.status_summary(derive(load(spark, sf, "orders"), REPORT))


def status_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return ops.status_pivot(derive(load(spark, sf, "orders"), REPORT))


QUERIES = {
    f.__name__: f
    for f in (
        normal_text, token_jaccard, label_similarity, metadata_dump, derived_components, label_expectations, audit_report,
        pii_scan, pii_scan_columns, status_summary, status_pivot,
    )
}


def _normal(c: str) -> str:
    return rf"trim(regexp_replace(lower(coalesce({c}, '')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


def _first(label: str, code: str | None, keywords) -> str:
    whens = []
    for w in keywords:
        if " " in w:
            hit = f"contains({label}, '{w}')"
        else:
            hit = f"contains(' ' || {label} || ' ', ' {w} ')"
            hit += f" OR contains(' ' || {code} || ' ', ' {w} ')" if code else ""
        whens.append(f"WHEN {hit} THEN '{w}'")
    return f"CASE {' '.join(whens)} END"


_NUMBER = "CAST(value AS BIGINT) || '.0'"
_SHOWN = (
    "SELECT source, code, string_agg(t, '; ' ORDER BY value) AS value_labels FROM (SELECT source, code, value, "
    f"{_NUMBER} || '=' || coalesce(text, '') AS t FROM ({select(LABELS, 'part')}) "
    "QUALIFY row_number() OVER (PARTITION BY source, code ORDER BY value) <= {most}) GROUP BY 1, 2"
)
_NOTES = """SELECT e.source, e.standard_name, coalesce(string_agg(CASE WHEN NOT contains({words}, keyword)
   THEN '[VL? ' || CAST(e.value AS BIGINT) || ' harap ''' || keyword || ''' dapat ''' || coalesce(text, '-') || '''] ' END, '' ORDER BY e.pos), '') AS note
   FROM ({expected}) e JOIN {found} f ON f.source = e.source AND f.standard_name = e.standard_name
   LEFT JOIN ({labels}) v ON v.source = e.source AND v.code = f.found AND v.value = e.value GROUP BY 1, 2"""
_COMPONENTS = rf"""SELECT source, pos, generate_subscripts(parts, 1) AS place, unnest(parts) AS component FROM (
   SELECT source, pos, list_filter(regexp_split_to_array(trim(substr({_CLEAN}, 9)), '[+\s]+'),
     lambda k: regexp_matches(k, '[A-Za-z].*\d|\d.*[A-Za-z]|[a-z]{{3,}}')) AS parts FROM d WHERE status = 'derivasi')"""


def _looked_up(rows: str, key: str, keep: str) -> str:
    return f"""SELECT {keep}, coalesce(e.code, l.code, b.code) AS found FROM {rows} r
   LEFT JOIN ex e ON e.source = r.source AND e.k = {key} LEFT JOIN lo l ON l.source = r.source AND l.k = lower({key})
   LEFT JOIN ba b ON b.source = r.source AND b.k = {_SQUEEZE.format(key)}"""


_BASE = f"""d AS (SELECT *, {_STATUS} AS status, CASE WHEN {_STATUS} = 'tersedia' THEN {_MAIN} END AS main_code,
   {_STATUS} <> 'tidak_tersedia' AND contains(code_cell, '*') AS star FROM ({DICTIONARY_SQL})),
 c AS ({CATALOGUE_SQL}),
 ex AS (SELECT source, code AS k, arg_max(code, pos) AS code FROM c GROUP BY 1, 2),
 lo AS (SELECT source, lower(code) AS k, arg_max(code, pos) AS code FROM c GROUP BY 1, 2),
 ba AS (SELECT source, {_SQUEEZE.format('code')} AS k, arg_max(code, pos) AS code FROM c GROUP BY 1, 2),
 parts AS ({_COMPONENTS}),
 hits AS ({_looked_up('parts', 'r.component', 'r.*')}),
 comp AS (SELECT source, pos, coalesce(string_agg(CASE WHEN found IS NOT NULL THEN found END, ', ' ORDER BY place), '') AS present,
   coalesce(string_agg(CASE WHEN found IS NULL THEN component END, ', ' ORDER BY place), '') AS lost FROM hits GROUP BY 1, 2)"""
_AUDIT_BASE = _BASE.replace(DICTIONARY_SQL, AUDIT_DICTIONARY_SQL).replace(CATALOGUE_SQL, AUDIT_CATALOGUE_SQL)
_EXPECTED_REPORT = select({**EXPECTED, "standard_name": "'asset_' || CAST(p_partkey AS STRING)"}, "part")

SQL = {
    "normal_text": f"SELECT doc_id, {_normal('text')} AS words FROM documents",
    "token_jaccard": f"""WITH t AS (SELECT p_partkey, {_normal('p_name')} AS w, list_distinct(string_split({_normal('p_name')}, ' ')) AS a,
   ['small', 'red', 'ring'] AS b FROM part)
 SELECT p_partkey, CASE WHEN w = '' THEN 0 ELSE round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) END AS jaccard FROM t""",
    "metadata_dump": f"""SELECT c.source, c.pos, 'P' || c.pos % 40 AS code, coalesce(label, '') AS label, coalesce(value_labels, '') AS value_labels
 FROM ({CATALOGUE_SQL}) c LEFT JOIN ({_SHOWN.format(most=10)}) s ON s.source = c.source AND s.code = 'P' || c.pos % 40""",
    "derived_components": f"WITH {_BASE} SELECT source, pos, present, lost FROM comp",
    "label_expectations": "WITH f AS (SELECT DISTINCT source, standard_name, 'P' || substr(standard_name, 2) AS found FROM (" + select(EXPECTED, "part") + ")) "
    + _NOTES.format(words=_normal("text"), expected=select(EXPECTED, "part"), found="f", labels=select(LABELS, "part")),
    "audit_report": f"""WITH {_AUDIT_BASE},
 f AS ({_looked_up('d', 'r.main_code', 'r.*')}),
 notes AS ({_NOTES.format(words=_normal('text'), expected=_EXPECTED_REPORT, found='f', labels=select(LABELS, 'part'))}),
 shown AS ({_SHOWN.format(most=6)}),
 j AS (SELECT f.*, comp.present, comp.lost, coalesce(c.label, '') AS label, coalesce(shown.value_labels, '') AS vl,
   coalesce(notes.note, '') AS note, CASE WHEN f.found IS NOT NULL THEN CASE WHEN coalesce(c.label, '') = concept THEN 1 WHEN contains(c.label, 'qqq') THEN 0.67 ELSE 0 END END AS sim,
   status = 'derivasi' AND comp.pos IS NULL AS bare
   FROM f LEFT JOIN comp ON comp.source = f.source AND comp.pos = f.pos
   LEFT JOIN (SELECT source, code, arg_max(coalesce(label, ''), pos) AS label FROM c GROUP BY 1, 2) c
     ON c.source = f.source AND c.code = f.found
   LEFT JOIN shown ON shown.source = f.source AND shown.code = f.found
   LEFT JOIN notes ON notes.source = f.source AND notes.standard_name = f.standard_name)
 SELECT source AS sumber, pos AS no, category AS kategori, standard_name AS nama_standar, concept AS konsep, role AS peran,
 code_cell AS kode_kamus, CASE WHEN status = 'derivasi' THEN coalesce(present, '') ELSE coalesce(found, '') END AS kode_ditemukan, label AS label_aktual,
 CASE sim WHEN 1 THEN '1.00' WHEN 0 THEN '0.00' WHEN 0.67 THEN '0.67' ELSE '' END AS kemiripan_label, vl AS value_label_aktual,
 CASE WHEN status = 'tidak_tersedia' THEN 'TIDAK TERSEDIA (sesuai kamus)'
  WHEN bare THEN 'DERIVASI (tanpa komponen kode)' WHEN status = 'derivasi' AND lost = '' THEN 'DERIVASI - semua komponen OK' WHEN status = 'derivasi' THEN 'DERIVASI - komponen HILANG'
  WHEN found IS NULL THEN 'TIDAK DITEMUKAN' WHEN sim = 1 THEN 'COCOK' WHEN sim > 0 THEN 'COCOK (label agak beda)' ELSE 'PERLU TINJAU (label beda)' END AS status,
 CASE WHEN status = 'tidak_tersedia' THEN 'Tangani dengan missing_indicator_flag jika di-merge'
  WHEN bare THEN 'Dibuat di pipeline; tidak ada kode sumber langsung' WHEN status = 'derivasi' AND lost = '' THEN '' WHEN status = 'derivasi' THEN 'Hilang: ' || lost
  WHEN found IS NULL THEN 'Kode ''' || main_code || ''' tidak ada di file. Cek codebook.'
  ELSE note || CASE WHEN star THEN '[Kode bertanda *: konfirmasi codebook] ' ELSE '' END
   || CASE WHEN sim = 0 THEN 'Verifikasi manual: konsep vs label aktual' ELSE '' END END AS keterangan
 FROM j""",
    "pii_scan": f"""WITH t AS (SELECT doc_id, {_normal('text')} AS w FROM documents)
 SELECT * FROM (SELECT doc_id, {_first('w', None, KEYWORDS)} AS kata_kunci FROM t) WHERE kata_kunci IS NOT NULL""",
    "pii_scan_columns": f"""WITH t AS (SELECT *, {_normal('label')} AS w, {_normal('code')} AS k FROM ({CATALOGUE_SQL}))
 SELECT * FROM (SELECT source, pos, code, {_first('w', 'k', ('ring', 'p10c', 'red widget', 'id'))} AS kata_kunci FROM t) WHERE kata_kunci IS NOT NULL""",
    "status_summary": f"""SELECT sumber, count(*) AS total, count(CASE WHEN contains(status, 'COCOK') THEN 1 END) AS cocok,
 count(CASE WHEN contains(status, 'PERLU TINJAU') THEN 1 END) AS perlu_tinjau,
 count(CASE WHEN contains(status, 'TIDAK DITEMUKAN') THEN 1 END) AS tidak_ditemukan,
 count(CASE WHEN contains(status, 'DERIVASI') THEN 1 END) AS derivasi,
 count(CASE WHEN contains(status, 'komponen HILANG') THEN 1 END) AS komponen_hilang,
 count(CASE WHEN contains(status, 'TIDAK TERSEDIA') THEN 1 END) AS tidak_tersedia FROM ({select(REPORT, 'orders')}) GROUP BY 1""",
    "status_pivot": f"""SELECT sumber, kategori, count(*) FILTER (WHERE status LIKE 'COCOK%') AS cocok,
 count(*) FILTER (WHERE contains(status, 'HILANG')) AS derivasi_hilang,
 count(*) FILTER (WHERE starts_with(status, 'DERIVASI') AND NOT contains(status, 'HILANG')) AS derivasi_ok,
 count(*) FILTER (WHERE starts_with(status, 'PERLU')) AS perlu_tinjau,
 count(*) FILTER (WHERE status = 'TIDAK DITEMUKAN') AS tidak_ditemukan,
 count(*) FILTER (WHERE starts_with(status, 'TIDAK TERSEDIA')) AS tidak_tersedia FROM ({select(REPORT, 'orders')}) GROUP BY 1, 2""",
}
