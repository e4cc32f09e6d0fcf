"""Stacking the sources, and the validation report of the stacked table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.columns import is_text, number_text

INTEGRAL = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
INDICATOR = "_missing"


def common_type(types: list[T.DataType]) -> T.DataType:
    """One type for a column across sources. Spark's own union would turn tinyint with
    text into bigint and fail on the first word; here text wins over numbers."""
    if len(set(types)) == 1:
        return types[0]
    if any(is_text(t) for t in types):
        return T.StringType()
    if all(t in INTEGRAL for t in types):
        return max(types, key=INTEGRAL.index)
    return T.DoubleType()


def as_type(df: DataFrame, name: str, wanted: T.DataType) -> Column:
    have, c = df.schema[name].dataType, F.col(f"`{name}`")
    if have == wanted:
        return c
    if is_text(wanted) and isinstance(have, (T.DoubleType, T.FloatType)):
        return number_text(c.cast("double")).alias(name)
    return c.cast(wanted).alias(name)


def stack(frames: Mapping[str, DataFrame], source_column: str) -> DataFrame:
    """Union by name of all sources, tagged; a column a source lacks is null there."""
    seen: dict[str, list[T.DataType]] = {}
    for df in frames.values():
        for f in df.schema.fields:
            if f.name != source_column:
                seen.setdefault(f.name, []).append(f.dataType)
    wanted = {name: common_type(types) for name, types in seen.items()}
    out: DataFrame | None = None
    for source, df in frames.items():
        part = df.select(
            *[as_type(df, c, wanted[c]) for c in df.columns if c != source_column],
            F.lit(source).alias(source_column),
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no source to stack")
    return out


def fill_indicators(df: DataFrame) -> DataFrame:
    """Missing indicators a source never produced are 0; all are tinyint."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(f"`{c}`").cast("tinyint"), F.lit(0).cast("tinyint"))
            for c in df.columns
            if c.endswith(INDICATOR) and c[: -len(INDICATOR)] in df.columns
        }
    )


def cell_counts(df: DataFrame, by: list[str], label: str | None = None) -> DataFrame:
    """Rows per cell, and rows with a known and with a positive label."""
    known = F.col(label).cast("double") if label else F.lit(None).cast("double")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(known).alias("n_known"),
        F.sum(known).alias("total"),
    )


def validation_report(df: DataFrame, source: str, cohort: str, label: str) -> DataFrame:
    """Long report (metric, key, value): rows, columns, rows per source and per cohort
    (rows of no cohort kept) and label share per cohort.

    The data is aggregated once, per cell; the grouping sets then run on that small result
    instead of tripling every input row.
    """
    cells = cell_counts(df, [source, cohort], label)
    s, k = F.col(source), F.col(cohort)
    totals = cells.groupingSets([[], [s], [k]], s, k).agg(
        F.grouping_id().alias("level"),
        F.sum("n").alias("n"),
        F.sum("n_known").alias("n_known"),
        F.sum("total").alias("total"),
    )
    rows = F.array(
        F.when(
            F.col("level") == 3,
            F.struct(F.lit("total_baris").alias("metric"), F.lit(None).cast("string").alias("key"),
                     F.col("n").cast("double").alias("value")),
        ),
        F.when(
            F.col("level") == 3,
            F.struct(F.lit("total_kolom").alias("metric"), F.lit(None).cast("string").alias("key"),
                     F.lit(float(len(df.columns))).alias("value")),
        ),
        F.when(
            (F.col("level") == 1) & s.isNotNull(),
            F.struct(F.lit("baris_per_sumber").alias("metric"), s.cast("string").alias("key"),
                     F.col("n").cast("double").alias("value")),
        ),
        F.when(
            F.col("level") == 2,
            F.struct(F.lit("baris_per_kohort").alias("metric"), k.cast("string").alias("key"),
                     F.col("n").cast("double").alias("value")),
        ),
        F.when(
            (F.col("level") == 2) & k.isNotNull(),
            F.struct(F.lit("prevalensi_per_kohort").alias("metric"), k.cast("string").alias("key"),
                     F.bround(F.try_divide(F.col("total"), F.col("n_known").cast("double")), 4).alias("value")),
        ),
    )
    return totals.select(F.explode(F.array_compact(rows)).alias("r")).select("r.*")


def prevalence(df: DataFrame, cohort: str, label: str) -> DataFrame:
    """Unweighted mean of the label per cohort, null cohort left out."""
    return (
        df.where(F.col(cohort).isNotNull())
        .groupBy(cohort)
        .agg(F.bround(F.avg(F.col(label).cast("double")), 4).alias("prevalence"))
    )
