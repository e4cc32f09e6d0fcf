"""Profiles that are kept and put together: a new survey is read once, by itself, and the questions about all of them are
answered from what was kept.

A stored profile has a row per cell and column with the numbers that add up: rows, filled rows, known numbers, bounds,
mean and sum of squared distances from the mean.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators.impute import feature_profile
from surveyloom.sources.outputs import write_table
from surveyloom.specs import ImputeRule


def profile_rows(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by..., column, dtype, n, filled, known, min, max, mean, squares``: one scan of the table."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wide = feature_profile(df, columns, by)
    each = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(types[c]).alias("dtype"),
                *[F.col(f"`{c}|{s}`").alias(s) for s in ("filled", "known", "min", "max", "mean")],
                (F.col(f"`{c}|sd`") * F.col(f"`{c}|sd`") * F.col(f"`{c}|known`")).alias("squares"),
            )
            for c in columns
        ]
    )
    return wide.select(*by, "n", F.explode(each).alias("p")).select(*by, "n", "p.*")


def store_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str], path: str) -> None:
    """Profile a table into ``path``. Of the first column of ``by``, values that are there already are replaced, others stay."""
    rows = profile_rows(df.where(F.col(by[0]).isNotNull()), columns, by)
    write_table(rows, path, by[:1], keep_others=True)


def _joined(a: Column, b: Column) -> Column:
    """Known numbers, mean and squares of two parts together."""
    known = a["known"] + b["known"]
    apart = b["mean"] - a["mean"]
    share = b["known"] / F.greatest(known, F.lit(1))
    both = F.struct(
        known.alias("known"), (a["mean"] + apart * share).alias("mean"),
        (a["squares"] + b["squares"] + apart * apart * a["known"] * share).alias("squares"),
    )
    return F.when(b["known"] == 0, a).when(a["known"] == 0, b).otherwise(both)


def merge_profiles(profiles: Iterable[DataFrame], by: Sequence[str]) -> DataFrame:
    """Profiles of several tables as one of all their rows, a row per cell and column.

    A column that a table lacks counts its rows as empty. What is gathered of a cell and column is a row per table.
    """
    profiles = list(profiles)
    parts = profiles[0].withColumn("__table", F.lit(0))
    for i, more in enumerate(profiles[1:], 1):
        parts = parts.unionByName(more.withColumn("__table", F.lit(i)))
    # a column that some table lacks misses that table's rows
    rows = parts.groupBy(*by, "__table").agg(F.max("n").alias("n")).groupBy(*by).agg(F.sum("n").alias("n"))
    number = F.struct(F.col("known"), F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("squares", F.lit(0.0)).alias("squares"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("known"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    merged = parts.groupBy(*by, "column").agg(
        F.max("dtype").alias("dtype"), F.sum("filled").alias("filled"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.aggregate(F.array_sort(F.collect_list(number)), nothing, _joined).alias("p"),
    )
    alike = [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]
    # without cells there is one row to join
    out = merged.alias("m").join(rows.alias("r"), alike or F.lit(True))
    known = F.col("p.known") > 0
    return out.select(
        *[F.col(f"m.{c}") for c in by], "column", "dtype", "r.n", "filled", F.col("p.known").alias("known"), "min", "max",
        F.when(known, F.col("p.mean")).alias("mean"), F.when(known, F.col("p.squares")).alias("squares"),
    )


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def shares(profile: DataFrame, source: str, cohort: str) -> DataFrame:
    """The availability of columns, as ``availability`` finds it in the rows."""
    return profile.select(
        F.col("column").alias("variable"), F.col(source).alias("source"), F.col(cohort).alias("cohort"), "n", "filled",
        (F.col("filled") / F.col("n")).alias("share"),
    )


def eligible(profile: DataFrame, by: Sequence[str], rule: ImputeRule) -> DataFrame:
    """What can be imputed and gets an indicator, as ``eligibility`` finds it in the rows."""
    never = F.col("column").isin(*rule.never)
    rate = (F.col("n") - F.col("filled")) / F.col("n")
    enough = ~never & (F.col("known") >= rule.min_values) & (F.col("min") < F.col("max"))
    return profile.select(
        *by, F.col("column").alias("feature"), "n", "filled", rate.alias("missing_rate"),
        F.coalesce(enough, F.lit(False)).alias("eligible"),
        ((rate > 0) & ((rate >= rule.indicator_rate) | never)).alias("indicator"),
    )


def contract_rows(profile: DataFrame, source: str, cohort: str) -> DataFrame:
    """Column, type and cells without a value, as ``contract_profile`` finds them in the rows."""
    rows = profile.where(F.col(source).isNotNull() & F.col(cohort).isNotNull())
    return rows.select(
        "column", "dtype", F.col(source).alias("source"), F.col(cohort).alias("cohort"), "n", "filled",
        (F.col("filled") == 0).alias("absent"),
    )
