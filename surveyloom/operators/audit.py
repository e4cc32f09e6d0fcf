"""Dictionary audit against source metadata, personal-data scan and metadata reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.columns import normal_text, number_text
from surveyloom.functions.similarity import label_similarity, two_decimals
from surveyloom.operators.mapping import match_audit, parse_cell, spread_gaps

# Thresholds, statuses and notes of the published audit report.
SAME = 0.70
CLOSE = 0.45
SHOWN_LABELS = 6
DUMPED_LABELS = 10
ABSENT = "TIDAK TERSEDIA (sesuai kamus)"
DERIVED_BARE = "DERIVASI (tanpa komponen kode)"
DERIVED_OK = "DERIVASI - semua komponen OK"
DERIVED_LOST = "DERIVASI - komponen HILANG"
NOT_FOUND = "TIDAK DITEMUKAN"
MATCH = "COCOK"
MATCH_CLOSE = "COCOK (label agak beda)"
REVIEW = "PERLU TINJAU (label beda)"
NOTE_ABSENT = "Tangani dengan missing_indicator_flag jika di-merge"
NOTE_BARE = "Dibuat di pipeline; tidak ada kode sumber langsung"
NOTE_LOST = "Hilang: "
NOTE_REVIEW = "Verifikasi manual: konsep vs label aktual"
NOTE_STAR = "[Kode bertanda *: konfirmasi codebook] "
#: Group of a status: the first whose words occur in it.
STATUS_GROUPS = (
    ("TIDAK DITEMUKAN", "tidak_ditemukan"),
    ("PERLU TINJAU", "perlu_tinjau"),
    ("COCOK", "cocok"),
    ("komponen HILANG", "derivasi_hilang"),
    ("DERIVASI", "derivasi_ok"),
)
OTHER_GROUP = "tidak_tersedia"


def label_text(value: Column, text: Column) -> Column:
    return F.concat(number_text(value), F.lit("="), F.coalesce(text, F.lit("")))


def first_labels(value_labels: DataFrame, most: int) -> DataFrame:
    """(source, code, value_labels): the first ``most`` value labels of each column as text.

    Rows beyond the rank are dropped in each task before the shuffle, so a column with
    a huge label list costs no more than a short one.
    """
    order = Window.partitionBy("source", "code").orderBy("value")
    ranked = value_labels.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    parts = F.sort_array(F.collect_list(F.struct("rank", label_text(F.col("value"), F.col("text")).alias("t"))))
    return ranked.groupBy("source", "code").agg(
        F.array_join(F.transform(parts, lambda p: p["t"]), "; ").alias("value_labels")
    )


def metadata_dump(catalogue: DataFrame, value_labels: DataFrame) -> DataFrame:
    """Every source column with its label and first value labels."""
    return (
        catalogue.join(first_labels(value_labels, DUMPED_LABELS), ["source", "code"], "left")
        .select(
            "source", "pos", "code", F.coalesce("label", F.lit("")).alias("label"),
            F.coalesce("value_labels", F.lit("")).alias("value_labels"),
        )
    )


def component_audit(derived: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per derived dictionary row its components found and missing, in cell order."""
    each = derived.select("source", "pos", F.posexplode("components").alias("at", "component"))
    matched = match_audit(each, catalogue, "component")
    entry = F.struct("at", F.coalesce("found", "component").alias("c"))
    in_order = lambda c: F.transform(F.sort_array(c), lambda e: e["c"])
    return matched.groupBy("source", "pos").agg(
        in_order(F.collect_list(F.when(F.col("found").isNotNull(), entry))).alias("present"),
        in_order(F.collect_list(F.when(F.col("found").isNull(), entry))).alias("lost"),
    )


def expectation_notes(expectations: DataFrame, found: DataFrame, value_labels: DataFrame) -> DataFrame:
    """(source, standard_name, note): expected words that the actual value labels lack.

    ``expectations`` has (standard_name, source, value, keyword, pos), ``found`` the column each
    standard name was matched to. A code without a label counts as not as expected.
    """
    wanted = expectations.join(found.select("source", "standard_name", "found"), ["source", "standard_name"])
    actual = value_labels.select("source", F.col("code").alias("found"), "value", "text")
    checked = wanted.join(actual, ["source", "found", "value"], "left")
    bad = ~normal_text(F.col("text")).contains(F.col("keyword"))
    note = F.concat(
        F.lit("[VL? "), F.col("value").cast("bigint").cast("string"), F.lit(" harap '"), F.col("keyword"),
        F.lit("' dapat '"), F.coalesce("text", F.lit("-")), F.lit("'] "),
    )
    notes = F.sort_array(F.collect_list(F.when(bad, F.struct("pos", note.alias("t")))))
    return checked.groupBy("source", "standard_name").agg(
        F.array_join(F.transform(notes, lambda n: n["t"]), "").alias("note")
    )


def audit_dictionary(
    dictionary: DataFrame,
    catalogue: DataFrame,
    value_labels: DataFrame,
    expectations: DataFrame,
    other_code: str = "other_code",
) -> DataFrame:
    """One row per dictionary row and source, with one of eight statuses and notes."""
    cell = parse_cell(F.col("code_cell"))
    rows = dictionary.withColumns(cell)
    rows = match_audit(rows, catalogue, "main_code")
    derived = rows.where(F.col("status") == "derivasi")
    rows = rows.join(component_audit(derived, catalogue), ["source", "pos"], "left")
    labels = catalogue.groupBy("source", F.col("code").alias("found")).agg(
        F.max_by(F.coalesce("label", F.lit("")), "pos").alias("label")
    )
    # rows without a column have no label: they are spread instead of meeting in one task
    rows = rows.withColumn("__slot", spread_gaps(F.col("found")))
    rows = rows.join(labels.withColumn("__slot", F.lit(0)), ["source", "found", "__slot"], "left")
    shown = first_labels(value_labels, SHOWN_LABELS).withColumnRenamed("code", "found")
    rows = rows.join(shown.withColumn("__slot", F.lit(0)), ["source", "found", "__slot"], "left")
    notes = expectation_notes(expectations, rows, value_labels)
    rows = rows.join(notes, ["source", "standard_name"], "left")
    rows = rows.withColumn(
        "similarity",
        F.when(F.col("found").isNotNull(), label_similarity(F.col("concept"), F.col("label"))),
    )
    absent, is_derived = F.col("status") == "tidak_tersedia", F.col("status") == "derivasi"
    bare = is_derived & (F.size("components") == 0)
    complete = is_derived & (F.size(F.coalesce("lost", F.array().cast("array<string>"))) == 0)
    unfound, sim = F.col("found").isNull(), F.col("similarity")
    status = (
        F.when(absent, ABSENT)
        .when(bare, DERIVED_BARE)
        .when(complete, DERIVED_OK)
        .when(is_derived, DERIVED_LOST)
        .when(unfound, NOT_FOUND)
        .when(sim >= SAME, MATCH)
        .when(sim >= CLOSE, MATCH_CLOSE)
        .otherwise(REVIEW)
    )
    star = F.when(F.col("needs_check"), F.lit(NOTE_STAR)).otherwise("")
    note = (
        F.when(absent, NOTE_ABSENT)
        .when(bare, NOTE_BARE)
        .when(complete, "")
        .when(is_derived, F.concat(F.lit(NOTE_LOST), F.array_join("lost", ", ")))
        .when(unfound, F.concat(F.lit("Kode '"), "main_code", F.lit("' tidak ada di file. Cek codebook.")))
        .otherwise(
            F.concat(
                F.coalesce("note", F.lit("")), star, F.when(sim < CLOSE, F.lit(NOTE_REVIEW)).otherwise("")
            )
        )
    )
    blank = F.lit("")
    return rows.select(
        F.col("source").alias("sumber"),
        F.col("pos").alias("no"),
        F.col("category").alias("kategori"),
        F.col("standard_name").alias("nama_standar"),
        F.col("concept").alias("konsep"),
        F.col("role").alias("peran"),
        F.col("code_cell").alias("kode_kamus"),
        (F.col(other_code) if other_code in dictionary.columns else F.lit(None).cast("string")).alias("kode_eppgbm"),
        F.coalesce(F.when(is_derived, F.array_join("present", ", ")).otherwise(F.col("found")), blank).alias(
            "kode_ditemukan"
        ),
        F.coalesce("label", blank).alias("label_aktual"),
        F.coalesce(two_decimals(sim), blank).alias("kemiripan_label"),
        F.coalesce("value_labels", blank).alias("value_label_aktual"),
        status.alias("status"),
        note.alias("keterangan"),
    )


def pii_scan(catalogue: DataFrame, keywords: Sequence[str], code: str | None = "code", label: str = "label") -> DataFrame:
    """Rows whose label or code hits a keyword, with the first keyword in list order.

    A phrase must occur in the normalised label, a single word must be a whole word of
    the label or the code. Words are looked for with blanks around, so the scan is row-local
    and reads each text once: no explode, no join.
    """
    texts = F.struct(
        normal_text(F.col(label)).alias("label"), (normal_text(F.col(code)) if code else F.lit("")).alias("code")
    )

    def first_hit(t: Column) -> Column:
        words = F.concat(F.lit(" "), t["label"], F.lit(" "))
        codes = F.concat(F.lit(" "), t["code"], F.lit(" "))
        out = None
        for keyword in keywords:
            if len(keyword.split()) > 1:
                hit = t["label"].contains(keyword)
            else:
                hit = words.contains(f" {keyword} ") | codes.contains(f" {keyword} ")
            out = F.when(hit, keyword) if out is None else out.when(hit, keyword)
        return out

    # The lambda binds the normalised texts once. As plain columns they would be put in place
    # of every mention when Spark moves the filter below the projection.
    found = F.transform(F.array(texts), first_hit)[0]
    return catalogue.withColumn("kata_kunci", found).where(F.col("kata_kunci").isNotNull())


def status_summary(report: DataFrame) -> DataFrame:
    """Per source the number of rows by words in their status."""

    def n(*words: str) -> Column:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.col("status").contains(word)
        return F.count_if(hit)

    return report.groupBy("sumber").agg(
        F.count(F.lit(1)).alias("total"),
        n("COCOK").alias("cocok"),
        n("PERLU TINJAU").alias("perlu_tinjau"),
        n("TIDAK DITEMUKAN").alias("tidak_ditemukan"),
        n("DERIVASI").alias("derivasi"),
        n("komponen HILANG").alias("komponen_hilang"),
        n("TIDAK TERSEDIA").alias("tidak_tersedia"),
    )


def status_group(status: Column) -> Column:
    case = None
    for word, group in STATUS_GROUPS:
        hit = status.contains(word)
        case = F.when(hit, group) if case is None else case.when(hit, group)
    return case.otherwise(OTHER_GROUP)


def status_pivot(report: DataFrame, by: Sequence[str] = ("sumber", "kategori"), value: str = "nama_standar") -> DataFrame:
    """Counts of status groups per source and category; absent groups count 0."""
    groups = sorted([g for _, g in STATUS_GROUPS] + [OTHER_GROUP])
    return (
        report.withColumn("status_grup", status_group(F.col("status")))
        .groupBy(*by)
        .pivot("status_grup", groups)
        .agg(F.count(F.col(value)))
        .fillna(0, groups)
    )
