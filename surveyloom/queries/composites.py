"""Row-wise composites and the wealth index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.columns import number
from surveyloom.operators import composites as ops
from surveyloom.queries.base import SURVEY_SQL, survey

ASSETS = ("asset_a", "asset_b", "asset_c", "asset_d")
#: Squares of values this size have no digits left for what differs between rows.
FAR = 1e9


def _values(df: DataFrame, *names: str):
    return [number(df, n) for n in names]


def row_sum(spark: SparkSession, sf: str) -> DataFrame:
    df = survey(spark, sf)
    return df.select("id_ruta", "visit_1", "visit_2", F.expr(ops.row_sum(_values(df, "visit_1", "visit_2"))).alias("ANC_total_visit"))


def row_count_of(spark: SparkSession, sf: str) -> DataFrame:
    df = survey(spark, sf)
    return df.select("id_ruta", "food_1", "food_2", F.expr(ops.row_count_of(_values(df, "food_1", "food_2"))).alias("food_diversity_score"))


def threshold_flag(spark: SparkSession, sf: str) -> DataFrame:
    df = survey(spark, sf)
    return df.select("id_ruta", "ttd_count", F.expr(ops.at_least(number(df, "ttd_count"), 90)).alias("TTD_compliance"))


def all_equal_flag(spark: SparkSession, sf: str) -> DataFrame:
    df = survey(spark, sf)
    return df.select("id_ruta", "imm_1", "imm_2", F.expr(ops.all_equal(_values(df, "imm_1", "imm_2"))).alias("imunisasi_lengkap"))


def wealth_moments(spark: SparkSession, sf: str) -> DataFrame:
    moments = ops.cross_moments(survey(spark, sf), ASSETS, ["source_flag"])
    return moments.select("source_flag", "n", *[F.round(c, 6).alias(c) for c in moments.columns[2:]])


def wealth_moments_far(spark: SparkSession, sf: str) -> DataFrame:
    """The same of columns far from zero, each unknown in some rows."""
    far = survey(spark, sf).select("source_flag", *[(F.col(a) + FAR).alias(a) for a in ASSETS])
    moments = ops.cross_moments(far, ASSETS, ["source_flag"])
    # doubles of this size lie a ten-millionth apart
    means = [F.round(F.col(f"mean_{a}") - FAR, 4).alias(f"mean_{a}") for a in ASSETS]
    return moments.select("source_flag", "n", *means, *[F.round(c, 6).alias(c) for c in moments.columns if c.startswith("cov_")])


def wealth_index(spark: SparkSession, sf: str) -> DataFrame:
    scored = ops.wealth_index(survey(spark, sf), ASSETS, by=["source_flag"])
    return scored.select("source_flag", "id_ruta", *ASSETS, F.round("wealth_index", 6).alias("wealth_index"))


QUERIES = {f.__name__: f for f in (row_sum, row_count_of, threshold_flag, all_equal_flag, wealth_moments, wealth_moments_far, wealth_index)}

_PAIRS = [(a, b) for i, a in enumerate(ASSETS) for b in ASSETS[i:]]
_OFF = {a: f"coalesce({a} - mean_{a}, 0)" for a in ASSETS}


def moments_sql(rows: str, by: str = "source_flag") -> str:
    """CTEs ``means`` and ``moments`` of the assets per source."""
    return f"""means AS (SELECT {by}, {', '.join(f'avg({a}) AS mean_{a}' for a in ASSETS)} FROM ({rows}) GROUP BY 1),
 moments AS (SELECT {by}, count(*) AS n, {', '.join(f'any_value(mean_{a}) AS mean_{a}' for a in ASSETS)},
   {', '.join(f'avg({_OFF[a]} * {_OFF[b]}) AS cov_{a}__{b}' for a, b in _PAIRS)}
   FROM ({rows}) JOIN means USING ({by}) GROUP BY 1)"""


def weights_sql(by: str = "source_flag", rounds: int = 400) -> str:
    """CTE ``weights``: first eigenvector of the correlation matrix by power iteration."""

    def cov(a: str, b: str) -> str:
        return f"cov_{a}__{b}" if (a, b) in _PAIRS else f"cov_{b}__{a}"

    def corr(a: str, b: str) -> str:
        return f"({cov(a, b)} / (sqrt({cov(a, a)}) * sqrt({cov(b, b)})))"

    step = {a: " + ".join(f"{corr(a, b)} * v_{b}" for b in ASSETS) for a in ASSETS}
    norm = "sqrt(" + " + ".join(f"w_{a} * w_{a}" for a in ASSETS) + ")"
    with_sum = " + ".join(f"v_{a} * {corr(a, b)} * sqrt({cov(b, b)})" for a in ASSETS for b in ASSETS)
    return f"""power AS (SELECT {by}, 0 AS i, {', '.join(f'{1 + 0.1 * k}e0 AS v_{a}' for k, a in enumerate(ASSETS))} FROM moments
   UNION ALL SELECT {by}, i + 1, {', '.join(f'w_{a} / {norm}' for a in ASSETS)}
   FROM (SELECT power.{by}, i, {', '.join(f'{step[a]} AS w_{a}' for a in ASSETS)} FROM power JOIN moments USING ({by}))
   WHERE i < {rounds}),
 weights AS (SELECT {by}, CASE WHEN {with_sum} < 0 THEN -1 ELSE 1 END AS sign, {', '.join(f'v_{a}' for a in ASSETS)}
   FROM power JOIN moments USING ({by}) WHERE i = {rounds})"""


SCORE = "sign * (" + " + ".join(f"v_{a} / sqrt(cov_{a}__{a}) * {_OFF[a]}" for a in ASSETS) + ")"

SQL = {
    "row_sum": f"""SELECT id_ruta, visit_1, visit_2, CASE WHEN visit_1 IS NOT NULL OR visit_2 IS NOT NULL
 THEN coalesce(visit_1, 0) + coalesce(visit_2, 0) END AS "ANC_total_visit" FROM ({SURVEY_SQL})""",
    "row_count_of": f"""SELECT id_ruta, food_1, food_2, CASE WHEN food_1 IS NOT NULL OR food_2 IS NOT NULL
 THEN CAST(coalesce(food_1 = 1, false)::INT + coalesce(food_2 = 1, false)::INT AS DOUBLE) END AS food_diversity_score FROM ({SURVEY_SQL})""",
    "threshold_flag": f"""SELECT id_ruta, ttd_count, CAST(ttd_count >= 90 AS BIGINT) AS "TTD_compliance" FROM ({SURVEY_SQL})""",
    "all_equal_flag": f"""SELECT id_ruta, imm_1, imm_2, CAST(coalesce(imm_1 = 1, false) AND coalesce(imm_2 = 1, false) AS BIGINT)
 AS imunisasi_lengkap FROM ({SURVEY_SQL})""",
    "wealth_moments": f"""WITH {moments_sql(SURVEY_SQL)} SELECT source_flag, n, {', '.join(f'round(mean_{a}, 6) AS mean_{a}' for a in ASSETS)},
 {', '.join(f'round(cov_{a}__{b}, 6) AS cov_{a}__{b}' for a, b in _PAIRS)} FROM moments""",
    "wealth_moments_far": f"""WITH {moments_sql(SURVEY_SQL)} SELECT source_flag, n, {', '.join(f'round(mean_{a}, 4) AS mean_{a}' for a in ASSETS)},
 {', '.join(f'round(cov_{a}__{b}, 6) AS cov_{a}__{b}' for a, b in _PAIRS)} FROM moments""",
    "wealth_index": f"""WITH RECURSIVE {moments_sql(SURVEY_SQL)}, {weights_sql()}
 SELECT source_flag, id_ruta, {', '.join(ASSETS)}, round({SCORE}, 6) AS wealth_index
 FROM ({SURVEY_SQL}) JOIN moments USING (source_flag) JOIN weights USING (source_flag)""",
}
