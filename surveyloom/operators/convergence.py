"""Has the imputation settled? Verdicts over a trace (cell..., feature, iteration, mean)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Width of the band, sweep the imputation stops at, fewest gaps a verdict
# needs, largest move of a settled feature and how many features a report shows.
BAND_SIGMA = 2.0
FINAL_SWEEP = 5
MIN_GAPS = 50
SETTLED_SD = 0.30
TOP = 8


def verdicts(trace: DataFrame, by: Sequence[str], final_sweep: int = FINAL_SWEEP, band_sigma: float = BAND_SIGMA) -> DataFrame:
    """One row per cell and feature.

    ``level`` is the mean over the last third of the sweeps. ``converged_at`` is the first sweep
    from which every later one stays within ``band_sigma`` standard errors of it (the last
    sweep if none). ``drift`` compares the first with the last third and ``deviation`` is
    the largest move from the level from ``final_sweep`` on, both in standard deviations.
    All windows and groups share one partitioning; a group has as many rows as sweeps.
    """
    keys = [*by, "feature"]
    group = Window.partitionBy(*keys)
    # sweeps are counted by their order, so that a trace may use any increasing number
    ranked = trace.withColumns(
        {
            "step": F.row_number().over(group.orderBy("iteration")),
            "steps": F.count(F.lit(1)).over(group),
        }
    )
    tail = F.greatest(F.lit(1), F.floor(F.col("steps") / 3))
    sd = F.when(F.col("sd_obs") > 0, F.col("sd_obs")).otherwise(1.0)
    levelled = ranked.withColumns({"tail": tail, "sd": sd}).withColumn(
        "level", F.avg(F.when(F.col("step") > F.col("steps") - F.col("tail"), F.col("mean_imputed"))).over(group)
    )
    band = F.lit(float(band_sigma)) * F.col("sd") / F.sqrt(F.greatest(F.lit(1), F.col("n_missing")))
    move = F.abs(F.col("mean_imputed") - F.col("level"))
    out_of_band = F.max(F.when(move > band, F.col("step")))
    extra = [c for c in ("position",) if c in trace.columns]
    return (
        levelled.withColumns({"move": move, "band": band})
        .groupBy(*keys)
        .agg(
            F.max("n_missing").alias("n_missing"),
            F.max("sd").alias("sd_obs"),
            F.max("steps").alias("n_sweeps"),
            F.max("level").alias("level"),
            F.least(F.coalesce(out_of_band + 1, F.lit(1)), F.max("steps")).alias("converged_at"),
            F.abs(
                (F.avg(F.when(F.col("step") <= F.col("tail"), F.col("mean_imputed"))) - F.max("level")) / F.max("sd")
            ).alias("drift"),
            (F.max(F.when(F.col("step") >= final_sweep, F.col("move"))) / F.max("sd")).alias("deviation"),
            *[F.max(c).alias(c) for c in extra],
        )
    )


def stability(verdict: DataFrame, min_gaps: int = MIN_GAPS, settled_sd: float = SETTLED_SD) -> DataFrame:
    """Adds ``measured`` (enough gaps for a verdict) and ``unstable`` (measured, still moving)."""
    measured = F.col("n_missing") >= min_gaps
    moving = F.coalesce(F.col("deviation") > settled_sd, F.lit(False))
    return verdict.withColumns({"measured": measured, "unstable": measured & moving})


def cell_summary(stable: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per cell: features, measured, ignored, settled and unstable ones."""
    return stable.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if("measured").alias("n_measured"),
        F.count_if(~F.col("measured")).alias("n_ignored"),
        F.count_if(F.col("measured") & ~F.col("unstable")).alias("n_settled"),
        F.count_if("unstable").alias("n_unstable"),
    )


def unstable_features(stable: DataFrame) -> DataFrame:
    """Features by the number of cells in which they are unstable, most first."""
    return (
        stable.where("unstable")
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_cells"))
        .orderBy(F.desc("n_cells"), "feature")
    )


def most_missing(stable: DataFrame, by: Sequence[str], top: int = TOP) -> DataFrame:
    """The measured features with most gaps of each cell; ties by position, else by name."""
    tie = "position" if "position" in stable.columns else "feature"
    order = Window.partitionBy(*by).orderBy(F.desc("n_missing"), tie)
    return (
        stable.where("measured").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )
