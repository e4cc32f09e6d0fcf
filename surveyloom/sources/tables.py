"""Reading sources and specification tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.columns import nan_to_null
from surveyloom.operators.cleaning import infer_types
from surveyloom.operators.mapping import clean_name, clean_names
from surveyloom.specs import Encoding

FORMATS = ("parquet", "csv", "orc", "json")

CATALOGUE = "source string, pos int, code string, label string"
VALUE_LABELS = "source string, code string, value double, text string"
LMS = "indicator string, sex int, x double, l double, m double, s double"
EXPECTATIONS = "pos int, standard_name string, source string, value double, keyword string"

# Which growth table serves which indicator and the key each one has.
LMS_KEYS = {"haz_l": "Month", "haz_h": "Month", "waz": "Month", "whz_l": "Length", "whz_h": "Height"}


def read_any(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Parquet, CSV (with header), ORC or JSON. CSV columns are text unless a schema is given."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}, expected one of {FORMATS}")
    reader = spark.read.options(**({"header": True} if fmt == "csv" else {})).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def read_source(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema=None,
    numbers_from_text: bool | None = None,
    **options,
) -> DataFrame:
    """A survey table with clean column names and null for NaN.

    Text formats carry no types, so columns that are numbers throughout become numbers, for
    special codes to be recognised; a schema avoids the extra pass.
    """
    df = nan_to_null(clean_names(read_any(spark, path, fmt, schema, **options)))
    if numbers_from_text is None:
        numbers_from_text = fmt == "csv" and schema is None
    return infer_types(df, share=1.0) if numbers_from_text else df


def catalogue_of(df: DataFrame, source: str) -> DataFrame:
    """(source, pos, code, label) from the schema alone: no scan. The label is the column's
    ``label`` or ``comment`` metadata."""
    rows = [
        (source, i, clean_name(f.name), f.metadata.get("label") or f.metadata.get("comment"))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, CATALOGUE)


def value_labels_of(df: DataFrame, source: str) -> DataFrame:
    """(source, code, value, text) from the ``value_labels`` column metadata: no scan."""
    rows = [
        (source, clean_name(f.name), float(value), text)
        for f in df.schema.fields
        for value, text in dict(f.metadata.get("value_labels") or {}).items()
    ]
    return df.sparkSession.createDataFrame(rows, VALUE_LABELS)


def with_labels(df: DataFrame, labels: Mapping[str, str], values: Mapping[str, Mapping[float, str]] | None = None) -> DataFrame:
    """Attach labels as column metadata; Parquet keeps them with the table."""
    values = values or {}

    def metadata(c: str) -> dict:
        out: dict = {}
        if c in labels:
            out["label"] = labels[c]
        if c in values:
            out["value_labels"] = {str(float(k)): v for k, v in values[c].items()}
        return out

    return df.select(*[F.col(f"`{c}`").alias(c, metadata=metadata(c)) for c in df.columns])


def load_dictionary(
    spark: SparkSession,
    path: str,
    sources: Sequence[str],
    fmt: str = "csv",
    other: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """The variable dictionary in long form: one row per standard name and source.

    The file has a row per variable: standard_name, category, concept, role and
    one column of code cells per source. ``other`` names a further code column to carry along, ``position``
    the column that orders the variables. A single file without one is in the order of its rows; several files need one.
    Columns: pos, standard_name, category, concept, role, source, code_cell, other_code.
    """
    fields = ["standard_name", "category", "concept", "role", *sources, *(c for c in (other, position) if c)]
    if fmt == "csv":
        wide = read_any(spark, path, "csv", quote='"', escape='"', multiLine=True)
    else:
        wide = read_any(spark, path, fmt)
    lacking = [c for c in fields if c not in wide.columns]
    if lacking:
        raise ValueError(f"dictionary file lacks columns {lacking}")
    if not position and len(wide.inputFiles()) > 1:
        raise ValueError("a dictionary of several files needs a column of positions")
    place = F.col(f"`{position}`") if position else F.monotonically_increasing_id() + 1
    cells = [F.struct(F.lit(s).alias("source"), F.col(f"`{s}`").cast("string").alias("code_cell")) for s in sources]
    # numbered before a row becomes one row per source
    return wide.withColumn("__pos", place).select(
        F.col("__pos").cast("int").alias("pos"),
        *[F.col(c).cast("string").alias(c) for c in ("standard_name", "category", "concept", "role")],
        (F.col(f"`{other}`") if other else F.lit(None)).cast("string").alias("other_code"),
        F.inline(F.array(*cells)),
    ).select("pos", "standard_name", "category", "concept", "role", "source", "code_cell", "other_code")


def load_lms(spark: SparkSession, files: Mapping[tuple[str, int], str]) -> DataFrame:
    """Growth reference (indicator, sex, x, l, m, s) from one JSON file per indicator and sex.

    Each file is an array of records with Month, Length or Height, and L, M, S, all as text.
    """
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in ("Month", "Length", "Height", "L", "M", "S")]
    )
    out: DataFrame | None = None
    for (indicator, sex), path in files.items():
        if indicator not in LMS_KEYS:
            raise ValueError(f"unknown indicator {indicator}, expected one of {sorted(LMS_KEYS)}")
        raw = spark.read.schema(schema).option("multiLine", True).json(path)
        part = raw.select(
            F.lit(indicator).alias("indicator"),
            F.lit(int(sex)).alias("sex"),
            F.col(LMS_KEYS[indicator]).cast("double").alias("x"),
            *[F.col(c).cast("double").alias(c.lower()) for c in ("L", "M", "S")],
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no growth table given")
    return out


def load_encoding(spark: SparkSession, path: str) -> Encoding:
    """Encoding schema from its JSON document (group -> list of columns)."""
    lines = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(lines) != 1:
        raise ValueError(f"{path} is not one JSON document")
    return Encoding.from_json(lines[0]["value"])


def load_matrix(spark: SparkSession, path: str, cells: Sequence[str]) -> DataFrame:
    """A published availability matrix from CSV, shares as numbers."""
    raw = read_any(spark, path, "csv")
    return raw.select(
        *[
            F.col(f"`{c}`").cast("double").alias(c) if c in cells
            else F.col(f"`{c}`").cast("int").alias(c) if c.startswith("n_sumber_")
            else F.col(f"`{c}`")
            for c in raw.columns
        ]
    )
