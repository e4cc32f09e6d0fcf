"""How much of each variable is there, per source and cohort.

One wide partial aggregate reads the data once whatever the number of variables; the
result has one row per cell and is reshaped from there.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds and names of availability classes.
ENOUGH = 0.50
ABSENT = 0.05
CLASSES = {3: "kuat", 2: "sebagian", 1: "lemah"}
NO_CLASS = "tidak"


def filled_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Long table (by..., n, variable, filled) from one scan of the data."""
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"f_{c}") for c in columns]
    )
    # unpivot the small per-cell result, not the data
    return wide.unpivot([*by, "n"], [f"f_{c}" for c in columns], "variable", "filled").withColumn(
        "variable", F.substring("variable", 3, 1 << 30)
    )


def availability(df: DataFrame, variables: Iterable[str], source: str, cohort: str) -> DataFrame:
    """Share of rows with a value, per variable, source and cohort; 0 if the column is absent."""
    variables = list(variables)
    there = [v for v in variables if v in df.columns]
    filled = filled_counts(df, there, [source, cohort])
    shares = filled.select(
        "variable",
        F.col(source).alias("source"),
        F.col(cohort).alias("cohort"),
        "n",
        "filled",
        (F.col("filled") / F.col("n")).alias("share"),
    )
    lacking = [v for v in variables if v not in df.columns]
    if not lacking:
        return shares
    cells = shares.select("source", "cohort", "n").distinct()
    absent = cells.select(
        F.explode(F.array(*[F.lit(v) for v in lacking])).alias("variable"),
        "source",
        "cohort",
        "n",
        F.lit(0).cast("bigint").alias("filled"),
        F.lit(0.0).alias("share"),
    )
    return shares.unionByName(absent)


def cell_name(source: Column, cohort: Column) -> Column:
    return F.concat_ws("_", source, cohort)


def availability_matrix(
    shares: DataFrame, sources: Sequence[str], young: str, old: str, categories: DataFrame | None = None
) -> DataFrame:
    """One row per variable: shares of all cells rounded to 3 digits, the number of sources
    with enough per cohort (on the unrounded share) and the cross-source class."""
    cells = [f"{s}_{k}" for s in sources for k in (young, old)]
    wide = (
        shares.withColumn("cell", cell_name(F.col("source"), F.col("cohort")))
        .groupBy("variable")
        .pivot("cell", cells)
        .agg(F.max("share"))
        .fillna(0.0, cells)
    )

    def sources_with(cohort: str) -> Column:
        hits = [(F.col(f"{s}_{cohort}") >= ENOUGH).cast("int") for s in sources]
        return sum(hits[1:], hits[0])

    n_young, n_old = sources_with(young), sources_with(old)
    label = F.lit(NO_CLASS)
    for count, name in CLASSES.items():
        label = F.when(n_young == count, name).otherwise(label)
    out = wide.select(
        F.col("variable").alias("variabel"),
        *[F.bround(c, 3).alias(c) for c in cells],
        n_young.alias(f"n_sumber_{young}"),
        n_old.alias(f"n_sumber_{old}"),
        label.alias(f"lintas_sumber_{young}"),
    )
    if categories is None:
        return out
    named = categories.select(F.col("standard_name").alias("variabel"), F.col("category").alias("kategori"))
    return out.join(named, "variabel", "left").select(
        "variabel", "kategori", *[c for c in out.columns if c != "variabel"]
    )


def feature_sets(matrix: DataFrame, young: str, old: str, n_sources: int = 3) -> DataFrame:
    """(feature_set, variabel): in all sources, in some, and in the young cohort only."""
    n_young, n_old = F.col(f"n_sumber_{young}"), F.col(f"n_sumber_{old}")
    member = F.array(
        F.when(n_young == n_sources, F.lit("universal")),
        F.when((n_young >= 1) & (n_young < n_sources), F.lit("heterogen")),
        F.when((n_young >= 1) & (n_old == 0), F.lit(f"{young}_only")),
    )
    return matrix.select(F.explode(F.array_compact(member)).alias("feature_set"), "variabel", n_young, n_old)


def cell_labels(matrix: DataFrame, cells: Sequence[str]) -> DataFrame:
    """(variabel, cell, share, label) with label tersedia, parsial or absen."""
    long = matrix.unpivot(["variabel"], list(cells), "cell", "share")
    label = F.when(F.col("share") >= ENOUGH, "tersedia").when(F.col("share") < ABSENT, "absen")
    return long.withColumn("label", label.otherwise("parsial"))


def rows_per_cell(shares: DataFrame) -> DataFrame:
    """Rows of each cell, out of the availability pass."""
    return shares.groupBy("source", "cohort").agg(F.max("n").alias("n"))


def candidates(dictionary: DataFrame, meta_role: str, exclude: Iterable[str]) -> DataFrame:
    """Dictionary names that may be features, with category, in dictionary order."""
    rows = dictionary.where((F.col("role") != meta_role) & ~F.col("standard_name").isin(*exclude))
    return rows.groupBy("standard_name").agg(
        F.min_by("category", "pos").alias("category"), F.min("pos").alias("pos")
    )


def structural_gaps(
    df: DataFrame,
    cohort: str,
    young: str,
    old: str,
    declared: Iterable[str],
    skip: Iterable[str],
    threshold: float = 0.5,
) -> DataFrame:
    """Variables whose null rates differ between the cohorts by the threshold or more,
    largest gap first, with a mark if the variable is declared young-only."""
    skip = set(skip) | {cohort}
    columns = [c for c in df.columns if c not in skip]
    filled = filled_counts(df, columns, [cohort])
    null_rate = (F.col("n") - F.col("filled")) / F.col("n")

    def rate(which: str) -> Column:
        return F.max(F.when(F.col(cohort) == which, null_rate))

    rates = filled.groupBy("variable").agg(rate(young).alias("null_young"), rate(old).alias("null_old"))
    gap = F.col("null_old") - F.col("null_young")
    return (
        rates.withColumns({"gap": gap, "declared": F.col("variable").isin(*declared)})
        .where(F.abs("gap") >= threshold)
        .orderBy(F.desc("gap"), "variable")
    )
