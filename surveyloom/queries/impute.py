"""Eligibility, indicators, code snapping, imputation and its convergence."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import convergence, impute as ops
from surveyloom.operators.cleaning import assign_cohort
from surveyloom.queries.availability import COHORT, cleaned
from surveyloom.queries.base import SURVEY_SQL, derive, load, select, survey
from surveyloom.session import materialise
from surveyloom.specs import ImputeRule

BY = ["source_flag", "kohort"]
FEATURES = [
    "age_child_months", "sex_child", "measure_position", "height_child_cm", "weight_child_kg", "area_type", "asset_a",
    "asset_c", "visit_1", "visit_2", "food_1", "food_2", "imm_1", "imm_2", "ttd_count", "occupation_mother", "edu_mother",
]
RULE = ImputeRule(
    exclude=frozenset({"source_flag", "kohort", "id_ruta", "svy_weight"}), never=frozenset({"visit_1", "visit_2"}),
    row_key=("id_ruta",),
)
CODED = frozenset({"sex_child", "measure_position", "area_type", "asset_a", "asset_c", "food_1", "food_2", "imm_1", "imm_2", "edu_mother"})

#: A target that is an exact linear function of complete features, with gaps.
LINEAR = {
    "source_flag": "l_returnflag",
    "kohort": "CASE WHEN l_quantity < 24 THEN 'baduta' ELSE 'balita_tua' END",
    "row_key": "l_orderkey",
    "a": "l_quantity",
    "b": "l_discount * 100e0",
    "c": "CAST(l_partkey % 7 AS DOUBLE)",
    "target": "CASE WHEN (l_orderkey + l_suppkey) % 7 = 0 THEN NULL ELSE 5e0 + 2e0 * l_quantity + 300e0 * l_discount END",
    "visit": "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END",
}
LINEAR_RULE = ImputeRule(
    exclude=frozenset({"source_flag", "kohort", "row_key"}), never=frozenset({"visit"}), ridge=0.0
)
#: A target with noise and one predictor: what is filled in is the regression line of each cell.
NOISY = {
    "source_flag": "l_returnflag",
    "kohort": "CASE WHEN l_quantity < 24 THEN 'baduta' ELSE 'balita_tua' END",
    "row_key": "l_orderkey",
    "line": "l_linenumber",
    "x": "CAST(l_partkey % 31 AS DOUBLE)",
    "target": "CASE WHEN (l_orderkey + l_suppkey) % 7 = 0 THEN NULL ELSE 3e0 + 0.5e0 * (l_partkey % 31) + (l_orderkey % 23) END",
}
NOISY_RULE = ImputeRule(exclude=frozenset({"source_flag", "kohort", "row_key", "line"}), ridge=0.0, sweeps=2)
#: The same with a few groups to learn from.
GROUPED = NOISY | {
    "x": "CAST(l_partkey % 4 AS DOUBLE)",
    "target": "CASE WHEN (l_orderkey + l_suppkey) % 7 = 0 THEN NULL ELSE 3e0 * (l_partkey % 4) * (l_partkey % 4) + (l_orderkey % 23) END",
}
GROUPED_RULE = replace(NOISY_RULE, min_leaf=5)
#: Observed codes of coded features with gaps, special codes taken out.
OBSERVED = {"edu_mother": (0, 1, 3, 4, 5, 6, 7), "imm_1": (1, 3, 4), "sex_child": (1, 3), "measure_position": (1, 3)}
#: A trace out of the event stream: ten sweeps of fifty features in five cells.
TRACE = {
    "cell": "event_type",
    "feature": "'f' || CAST(user_id % 20 AS STRING)",
    "iteration": "CAST(1 + event_id % 10 AS INT)",
    "value": "CASE WHEN event_id % 10 < 6 THEN value * 2e0 ELSE 100e0 + value % 10e0 END",
}


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf).select(*BY, *FEATURES)


def missing_rates(spark: SparkSession, sf: str) -> DataFrame:
    return ops.missing_rates(_cells(spark, sf), FEATURES, BY)


def feature_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    return ops.eligibility(_cells(spark, sf), FEATURES, BY, RULE)


def missing_indicators(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaned(spark, sf).select("id_ruta", *BY, "visit_1", "food_1", "ttd_count", "asset_a")
    return ops.missing_indicators(df, RULE)


def imputation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    df = assign_cohort(survey(spark, sf), COHORT).drop("id_ruta")
    return ops.imputation_matrix(df, RULE, "balita_tua")


def snap_codes(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part").select("p_partkey", "p_retailprice")
    codes = load(spark, sf, "part").select((890 + F.col("p_size") * 2.5).alias("value"))
    return ops.snap_to_codes(part, "p_retailprice", codes)


def snap_many_codes(spark: SparkSession, sf: str) -> DataFrame:
    codes = load(spark, sf, "orders").select(F.floor(F.col("o_totalprice") / 40).cast("double").alias("value"))
    return ops.snap_to_codes(load(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", codes)


def impute_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps of an exactly linear target come back as the values they replaced."""
    df = derive(load(spark, sf, "lineitem"), LINEAR)
    return ops.impute_linear(df, LINEAR_RULE).withColumn("target", F.round("target", 4))


def imputation_trace(spark: SparkSession, sf: str) -> DataFrame:
    df = derive(load(spark, sf, "lineitem"), LINEAR)
    trace = ops.ChainedImputer(LINEAR_RULE).fit(df, log=True, fill=False).trace()
    return _rounded(trace, 5)


def _rounded(trace: DataFrame, digits: int) -> DataFrame:
    return trace.select(
        *BY, "feature", "iteration", F.round("mean_imputed", digits).alias("mean_imputed"), "n_missing", F.round("sd_obs", digits).alias("sd_obs")
    )


def tree_trace(spark: SparkSession, sf: str) -> DataFrame:
    """The trace of trees: a target with noise, whose gaps take the mean of their group."""
    imputer = ops.TreeImputer(GROUPED_RULE, trees=1, depth=3)
    return _rounded(imputer.fit(derive(load(spark, sf, "lineitem"), GROUPED), log=True, fill=False).trace(), 3)


def impute_tree_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps of a noisy target take the mean of the known values of their cell and group: what a tree on groups learns."""
    out = ops.impute_tree(derive(load(spark, sf, "lineitem"), GROUPED), GROUPED_RULE, trees=1, depth=3)
    return out.withColumn("target", F.round("target", 3))


def impute_trees_alone(spark: SparkSession, sf: str) -> DataFrame:
    """As ``impute_alone``, by trees: other sources change no value."""
    return _alone(spark, sf, lambda df, rule: ops.impute_tree(df, replace(rule, sweeps=2), CODED, trees=2, depth=3))


def impute_linear(spark: SparkSession, sf: str) -> DataFrame:
    """Coded and continuous features with gaps in every cell."""
    df = cleaned(spark, sf).select("id_ruta", *BY, *FEATURES)
    return ops.impute_linear(df, RULE, CODED)


def impute_observed_kept(spark: SparkSession, sf: str) -> DataFrame:
    """What imputation may not change: per cell the rows, no gap left in eligible features, the
    gaps kept elsewhere, and the sum of the observed values of a coded feature."""
    out = impute_linear(spark, sf)
    return out.groupBy(*BY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("ttd_count").alias("ttd_count"),
        F.count("asset_c").alias("asset_c"),
        F.count("visit_1").alias("visit_1"),
        F.sum(F.when(F.col("edu_mother_missing") == 0, F.col("edu_mother"))).alias("edu_observed"),
        *[F.count_if(~F.col(c).isin(*codes)).alias(f"{c}_strange") for c, codes in OBSERVED.items()],
        F.sum(F.col("visit_1_missing").cast("bigint")).alias("visit_1_missing"),
    )


def impute_noisy(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps of a noisy target lie on the line through the known values of their cell."""
    out = ops.impute_linear(derive(load(spark, sf, "lineitem"), NOISY), NOISY_RULE)
    return out.withColumn("target", F.round("target", 6))


def impute_alone(spark: SparkSession, sf: str) -> DataFrame:
    """A source imputed alone and among all sources: rows, filled values, and values that differ."""
    return _alone(spark, sf, lambda df, rule: ops.impute_linear(df, rule, CODED))


def _alone(spark: SparkSession, sf: str, impute) -> DataFrame:
    df = cleaned(spark, sf).select("id_ruta", *BY, *FEATURES, "svy_weight")
    rule = replace(RULE, row_key=("id_ruta", "svy_weight"), exclude=RULE.exclude | {"__row"})
    # a number per row, given once, to put both results side by side
    df = materialise(df.withColumn("__row", F.monotonically_increasing_id()), "alone")
    whole = impute(df, rule).where("source_flag = 'R'")
    alone = impute(df.where("source_flag = 'R'"), rule)
    filled = ["ttd_count", "height_child_cm", "weight_child_kg", "edu_mother", "imm_1"]
    a = whole.select("__row", *BY, *[F.col(c).alias(f"a_{c}") for c in filled], "ttd_count_missing")
    b = alone.select("__row", *[F.col(c).alias(f"b_{c}") for c in filled])
    # sums of doubles differ in their last digits with the order they are added in
    differ = [F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) > 1e-6 * (1 + F.abs(f"a_{c}")) for c in filled]
    off = reduce(lambda x, y: x | y, [F.coalesce(d, F.lit(True)) for d in differ])
    return a.join(b, "__row").groupBy(*BY).agg(
        F.count("*").alias("n"), F.sum(F.col("ttd_count_missing").cast("bigint")).alias("filled"), F.count_if(off).alias("different")
    )


def impute_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Trees: what they may not change, and that they find a relation that is no line."""
    columns = LINEAR | {"target": "CASE WHEN (l_orderkey + l_suppkey) % 7 = 0 THEN NULL ELSE abs(l_quantity - 25e0) END"}
    df = derive(load(spark, sf, "lineitem"), columns)
    out = ops.impute_tree(df, replace(LINEAR_RULE, sweeps=1, min_leaf=5), trees=6, depth=4)
    off = F.abs(F.col("target") - F.abs(F.col("a") - 25))
    return out.groupBy(*BY).agg(
        F.count("*").alias("n"), F.count("target").alias("filled"), F.count("visit").alias("visits"),
        F.count_if((F.col("target_missing") == 0) & (off > 0)).alias("changed"),
        (F.avg(F.when(F.col("target_missing") == 1, off)) < 2).alias("near"),
    )


def _trace(spark: SparkSession, sf: str) -> DataFrame:
    rows = derive(load(spark, sf, "events"), TRACE)
    return rows.groupBy("cell", "feature", "iteration").agg(
        F.round(F.avg("value"), 6).alias("mean_imputed"), F.count(F.lit(1)).alias("n")
    ).select("cell", "feature", "iteration", "mean_imputed", (F.col("n") * 10).alias("n_missing"), F.lit(25.0).alias("sd_obs"))


def convergence_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    out = convergence.stability(convergence.verdicts(_trace(spark, sf), ["cell"]))
    return out.select(
        "cell", "feature", "n_missing", "n_sweeps", F.round("level", 5).alias("level"), "converged_at",
        F.round("drift", 5).alias("drift"), F.round("deviation", 5).alias("deviation"), "measured", "unstable",
    )


def convergence_cells(spark: SparkSession, sf: str) -> DataFrame:
    return convergence.cell_summary(convergence.stability(convergence.verdicts(_trace(spark, sf), ["cell"])), ["cell"])


def convergence_unstable(spark: SparkSession, sf: str) -> DataFrame:
    return convergence.unstable_features(convergence.stability(convergence.verdicts(_trace(spark, sf), ["cell"])))


def convergence_top(spark: SparkSession, sf: str) -> DataFrame:
    stable = convergence.stability(convergence.verdicts(_trace(spark, sf), ["cell"]))
    return convergence.most_missing(stable, ["cell"]).select("cell", "feature", "n_missing", "rank")


QUERIES = {
    f.__name__: f
    for f in (
        missing_rates, feature_eligibility, missing_indicators, imputation_matrix, snap_codes, snap_many_codes,
        impute_exact, impute_noisy, impute_alone, impute_trees, impute_tree_groups, impute_trees_alone, imputation_trace, tree_trace, impute_linear, impute_observed_kept, convergence_verdicts, convergence_cells,
        convergence_unstable, convergence_top,
    )
}

_CODES = "(2, 8, 88, 98, 99, 998)"
_KEPT = ("age_child_months",)


def _clean(c: str) -> str:
    bounds = {"height_child_cm": (40, 130), "weight_child_kg": (1, 40), "age_child_months": (0, 60)}
    value = c
    if c in bounds:
        value = f"CASE WHEN {c} BETWEEN {bounds[c][0]} AND {bounds[c][1]} THEN {c} END"
    return value if c in _KEPT else f"CASE WHEN {value} NOT IN {_CODES} THEN {value} END"


_COHORT = "CASE WHEN age_child_months BETWEEN 0 AND 60 AND age_child_months < 24 THEN 'baduta' ELSE 'balita_tua' END"
CLEAN_SQL = f"""SELECT id_ruta, source_flag, {_COHORT} AS kohort, {', '.join(f'{_clean(c)} AS {c}' for c in FEATURES)} FROM ({SURVEY_SQL})"""
_LONG = " UNION ALL ".join(
    f"SELECT source_flag, kohort, '{c}' AS feature, count(*) AS n, count({c}) AS filled, min({c}) < max({c}) AS varies FROM clean GROUP BY 1, 2"
    for c in FEATURES
)
_TRUE = {**LINEAR, "target": "5e0 + 2e0 * l_quantity + 300e0 * l_discount", "gap": "(l_orderkey + l_suppkey) % 7 = 0"}
_TRACE = f"""trace AS (SELECT cell, feature, iteration, round(avg(value), 6) AS mean_imputed, count(*) * 10 AS n_missing, 25e0 AS sd_obs
   FROM ({select(TRACE, 'events')}) GROUP BY 1, 2, 3),
 r AS (SELECT *, row_number() OVER (PARTITION BY cell, feature ORDER BY iteration) AS step,
   count(*) OVER (PARTITION BY cell, feature) AS steps, greatest(1, count(*) OVER (PARTITION BY cell, feature) // 3) AS tail FROM trace),
 l AS (SELECT *, avg(CASE WHEN step > steps - tail THEN mean_imputed END) OVER (PARTITION BY cell, feature) AS level FROM r),
 m AS (SELECT *, abs(mean_imputed - level) <= 2 * sd_obs / sqrt(greatest(1, n_missing)) AS inside FROM l),
 verdict AS (SELECT cell, feature, max(n_missing) AS n_missing, max(steps) AS n_sweeps, max(level) AS level,
   least(coalesce(max(CASE WHEN NOT inside THEN step END) + 1, 1), max(steps)) AS converged_at,
   abs(avg(CASE WHEN step <= tail THEN mean_imputed END) - max(level)) / max(sd_obs) AS drift,
   max(CASE WHEN step >= 5 THEN abs(mean_imputed - level) END) / max(sd_obs) AS deviation FROM m GROUP BY 1, 2),
 stable AS (SELECT *, n_missing >= 50 AS measured, n_missing >= 50 AND coalesce(deviation > 0.30, false) AS unstable FROM verdict)"""

_ALONE = f"""WITH clean AS ({CLEAN_SQL}) SELECT source_flag, kohort, count(*) AS n,
 CAST(count(*) - count(ttd_count) AS BIGINT) AS filled, CAST(0 AS BIGINT) AS different FROM clean WHERE source_flag = 'R' GROUP BY 1, 2"""

SQL = {
    "missing_rates": f"""WITH clean AS ({CLEAN_SQL}), long AS ({_LONG})
 SELECT source_flag, kohort, feature AS variable, n, filled, (n - filled) / n AS missing_rate FROM long""",
    "feature_eligibility": f"""WITH clean AS ({CLEAN_SQL}), long AS ({_LONG})
 SELECT source_flag, kohort, feature, n, filled, (n - filled) / n AS missing_rate,
 coalesce(feature NOT IN ('visit_1', 'visit_2') AND filled >= 100 AND varies, false) AS eligible,
 filled < n AND ((n - filled) / n >= 0.10 OR feature IN ('visit_1', 'visit_2')) AS indicator FROM long""",
    "missing_indicators": f"""WITH clean AS ({CLEAN_SQL}),
 rates AS (SELECT source_flag, kohort, {', '.join(f'(count(*) - count({c})) / count(*) AS r_{c}' for c in ('visit_1', 'food_1', 'ttd_count', 'asset_a'))}
   FROM clean GROUP BY 1, 2)
 SELECT id_ruta, source_flag, kohort, visit_1, food_1, ttd_count, asset_a,
 CASE WHEN r_visit_1 > 0 THEN CAST(visit_1 IS NULL AS TINYINT) END AS visit_1_missing,
 {', '.join(f'CASE WHEN r_{c} >= 0.10 THEN CAST({c} IS NULL AS TINYINT) END AS {c}_missing' for c in ('food_1', 'ttd_count', 'asset_a'))}
 FROM clean JOIN rates USING (source_flag, kohort)""",
    "imputation_matrix": f"""SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in (
    'age_child_months', 'sex_child', 'measure_position', 'height_child_cm', 'weight_child_kg', 'area_type', 'asset_a', 'asset_b',
    'asset_c', 'asset_d', 'imm_1', 'imm_2', 'imm_vit_a_count', 'ttd_count', 'occupation_mother', 'edu_mother', 'water_source'))}
 FROM ({SURVEY_SQL}) WHERE age_child_months >= 24""",
    "snap_codes": """WITH codes AS (SELECT DISTINCT 890 + p_size * 2.5e0 AS code FROM part),
 priced AS (SELECT DISTINCT p_retailprice FROM part),
 near AS (SELECT p_retailprice, arg_min(code, struct_pack(d := abs(p_retailprice - code), c := code)) AS code
   FROM priced, codes GROUP BY 1)
 SELECT p_partkey, code AS p_retailprice FROM part JOIN near USING (p_retailprice)""",
    "snap_many_codes": """WITH codes AS (SELECT DISTINCT floor(o_totalprice / 40)::DOUBLE AS code FROM orders),
 lo AS (SELECT c_custkey, c_acctbal, code AS below FROM customer ASOF LEFT JOIN codes ON c_acctbal >= code),
 hi AS (SELECT c_custkey, code AS above FROM customer ASOF LEFT JOIN codes ON c_acctbal <= code)
 SELECT c_custkey, CASE WHEN below IS NULL THEN above WHEN above IS NULL THEN below
  WHEN c_acctbal - below <= above - c_acctbal THEN below ELSE above END AS c_acctbal FROM lo JOIN hi USING (c_custkey)""",
    "impute_exact": f"""WITH t AS ({select(_TRUE, 'lineitem')})
 SELECT source_flag, kohort, row_key, a, b, c, round(target, 4) AS target, visit, CAST(gap AS TINYINT) AS target_missing,
 CAST(visit IS NULL AS TINYINT) AS visit_missing FROM t""",
    "impute_noisy": f"""WITH t AS ({select(NOISY, 'lineitem')}),
 line AS (SELECT source_flag, kohort, regr_slope(target, x) AS slope, regr_intercept(target, x) AS base FROM t GROUP BY 1, 2)
 SELECT source_flag, kohort, row_key, line, x, round(coalesce(target, base + slope * x), 6) AS target,
 CAST(target IS NULL AS TINYINT) AS target_missing FROM t JOIN line USING (source_flag, kohort)""",
    "impute_alone": _ALONE,
    "impute_trees_alone": _ALONE,
    "impute_tree_groups": f"""WITH t AS ({select(GROUPED, 'lineitem')}),
 grouped AS (SELECT source_flag, kohort, x, avg(target) AS mean FROM t GROUP BY 1, 2, 3)
 SELECT source_flag, kohort, row_key, line, x, round(coalesce(target, mean), 3) AS target,
 CAST(target IS NULL AS TINYINT) AS target_missing FROM t JOIN grouped USING (source_flag, kohort, x)""",
    "tree_trace": f"""WITH t AS ({select(GROUPED, 'lineitem')}),
 grouped AS (SELECT source_flag, kohort, x, avg(target) AS mean FROM t GROUP BY 1, 2, 3)
 SELECT source_flag, kohort, 'target' AS feature, CAST(i AS INT) AS iteration, round(avg(CASE WHEN target IS NULL THEN mean END), 3) AS mean_imputed,
 count(CASE WHEN target IS NULL THEN 1 END) AS n_missing, round(stddev_pop(target), 3) AS sd_obs
 FROM t JOIN grouped USING (source_flag, kohort, x), generate_series(1, 2) AS s(i) GROUP BY 1, 2, 4""",
    "impute_trees": f"""WITH t AS ({select(LINEAR, 'lineitem')}) SELECT source_flag, kohort, count(*) AS n, count(*) AS filled,
 count(visit) AS visits, CAST(0 AS BIGINT) AS changed, true AS near FROM t GROUP BY 1, 2""",
    "imputation_trace": f"""WITH t AS ({select(_TRUE, 'lineitem')})
 SELECT source_flag, kohort, 'target' AS feature, CAST(i AS INT) AS iteration, round(avg(CASE WHEN gap THEN target END), 5) AS mean_imputed,
 count(CASE WHEN gap THEN 1 END) AS n_missing, round(stddev_pop(CASE WHEN NOT gap THEN target END), 5) AS sd_obs
 FROM t, generate_series(1, 5) AS s(i) GROUP BY 1, 2, 4""",
    "impute_observed_kept": f"""WITH clean AS ({CLEAN_SQL})
 SELECT source_flag, kohort, count(*) AS n, count(*) AS ttd_count,
 count(CASE WHEN (SELECT min(asset_c) = max(asset_c) FROM clean) THEN asset_c ELSE 1 END) AS asset_c,
 count(visit_1) AS visit_1, sum(edu_mother) AS edu_observed, {', '.join(f'CAST(0 AS BIGINT) AS {c}_strange' for c in OBSERVED)},
 CAST(count(*) - count(visit_1) AS BIGINT) AS visit_1_missing FROM clean GROUP BY 1, 2""",
    "convergence_verdicts": f"""WITH {_TRACE} SELECT cell, feature, n_missing, n_sweeps, round(level, 5) AS level, converged_at,
 round(drift, 5) AS drift, round(deviation, 5) AS deviation, measured, unstable FROM stable""",
    "convergence_cells": f"""WITH {_TRACE} SELECT cell, count(*) AS n_features, count(CASE WHEN measured THEN 1 END) AS n_measured,
 count(CASE WHEN NOT measured THEN 1 END) AS n_ignored, count(CASE WHEN measured AND NOT unstable THEN 1 END) AS n_settled,
 count(CASE WHEN unstable THEN 1 END) AS n_unstable FROM stable GROUP BY 1""",
    "convergence_unstable": f"WITH {_TRACE} SELECT feature, count(*) AS n_cells FROM stable WHERE unstable GROUP BY 1",
    "convergence_top": f"""WITH {_TRACE} SELECT * FROM (SELECT cell, feature, n_missing,
 CAST(row_number() OVER (PARTITION BY cell ORDER BY n_missing DESC, feature) AS INT) AS rank FROM stable WHERE measured) WHERE rank <= 8""",
}
