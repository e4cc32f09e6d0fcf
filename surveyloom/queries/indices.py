"""Reference lookup, LMS scores and growth indices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.columns import lms_z as lms_z_expr
from surveyloom.functions.columns import numeric
from surveyloom.operators import indices as ops
from surveyloom.operators.cleaning import null_outside
from surveyloom.queries.base import SURVEY_SQL, load, survey
from surveyloom.sources.tables import LMS
from surveyloom.specs import Measures

RANGES = {"height_child_cm": (40, 130), "weight_child_kg": (1, 40), "age_child_months": (0, 60)}


def lms_rows() -> list[tuple[str, int, float, float, float, float]]:
    """A growth reference by rule, with skewness 1, 0 and negative, and uneven steps."""
    rows = []
    for sex in (1, 2):
        rows += [("haz_l", sex, float(x), 1.0, 50.5 + 1.5 * x - sex, 0.04) for x in range(0, 25, 3)]
        rows += [("haz_h", sex, float(x), 1.0, 60.5 + 0.75 * x - sex, 0.0425) for x in range(24, 61, 4)]
        rows += [("waz", sex, float(x), round(-0.35 + 0.01 * x, 2), 3.5 + 0.25 * x, 0.125 + 0.001 * x) for x in range(0, 61, 5)]
        rows += [("whz_l", sex, 45 + 2.5 * i, -0.35 * (sex - 1), 2.5 + 0.5 * i, 0.09) for i in range(27)]
        rows += [("whz_h", sex, 65.0 + 5 * i, 0.0 if sex == 1 else -0.35, 7.0 + 1.5 * i, 0.0875) for i in range(12)]
    return rows


def lms_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(lms_rows(), LMS)


def lms_lookup(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    indicator = F.when(F.col("p_size") < 24, "haz_l").otherwise("waz")
    x = F.col("p_size") + F.when(F.col("p_partkey") % 2 == 0, 0.25).otherwise(F.when(F.col("p_partkey") % 5 == 0, 30.0).otherwise(0.0))
    keyed = part.select("p_partkey", indicator.alias("i"), x.cast("double").alias("x"), (1 + F.col("p_partkey") % 3).cast("double").alias("sex"))
    found = ops.lookup(keyed, ops.segments(lms_table(spark)), "sex", {"ref": ("i", "x")})
    return found.select("p_partkey", *[F.round(f"ref_{n}", 9).alias(n) for n in ("l", "m", "s")])


def lms_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The formula alone, on every branch of the skewness."""
    li = load(spark, sf, "lineitem")
    value = F.col("l_extendedprice") - F.when(F.col("l_linenumber") == 7, 60_000.0).otherwise(0.0)
    skew = F.when(F.col("l_linenumber") % 3 == 0, 0.0).when(F.col("l_linenumber") % 3 == 1, 1.0).otherwise(-0.35)
    median = 30_000.0 + F.col("l_quantity") * 100.0
    z = lms_z_expr(value, skew, median, F.lit(0.125))
    return li.select("l_orderkey", "l_linenumber", F.round(z, 9).alias("z"))


def standing_height(spark: SparkSession, sf: str) -> DataFrame:
    df = survey(spark, sf)
    corrected = ops.standing_height(
        numeric(df, "height_child_cm"), numeric(df, "age_child_months"), numeric(df, "measure_position"), 24.0, 0.7
    )
    return df.select("id_ruta", "height_child_cm", F.round(corrected, 6).alias("corrected"))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return ops.growth_indices(null_outside(survey(spark, sf), RANGES), lms_table(spark), Measures())


def growth_indices(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(
        "source_flag", "id_ruta", "age_child_months",
        *[F.round(c, 6).alias(c) for c in ("haz_score", "waz_score", "whz_score")], "stunting_binary",
    )


def index_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ops.index_counts(_scored(spark, sf), "stunting_binary", ["source_flag"])


QUERIES = {f.__name__: f for f in (lms_lookup, lms_scores, standing_height, growth_indices, index_counts)}

_VALUES = ", ".join(f"('{i}', {s}, {x!r}e0, {l!r}e0, {m!r}e0, {v!r}e0)" for i, s, x, l, m, v in lms_rows())
SEGMENTS = f"""lms(indicator, sex, x, l, m, s) AS (VALUES {_VALUES}),
 seg AS (SELECT *, lead(x) OVER w AS x1, lead(l) OVER w AS l1, lead(m) OVER w AS m1, lead(s) OVER w AS s1
   FROM lms WINDOW w AS (PARTITION BY indicator, sex ORDER BY x))"""


def on_segment(alias: str, indicator: str, x: str) -> str:
    return (
        f"{alias}.indicator = {indicator} AND {alias}.sex = sx AND {x} >= {alias}.x AND "
        f"({x} < {alias}.x1 OR ({alias}.x1 IS NULL AND {x} = {alias}.x))"
    )


def mixed(alias: str, n: str, x: str) -> str:
    return (
        f"CASE WHEN {x} = {alias}.x THEN {alias}.{n} ELSE {alias}.{n} + ({x} - {alias}.x) / ({alias}.x1 - {alias}.x) "
        f"* ({alias}.{n}1 - {alias}.{n}) END"
    )


def z_of(value: str, l: str, m: str, s: str) -> str:
    return (
        f"CASE WHEN {value} > 0 THEN CASE WHEN {l} = 0 THEN ln({value} / {m}) / {s} "
        f"ELSE (pow({value} / {m}, {l}) - 1) / ({l} * {s}) END END"
    )


_CORRECTED = """CASE WHEN age_child_months < 24 AND measure_position <> 1 THEN height_child_cm + 0.7e0
 WHEN age_child_months >= 24 AND measure_position = 1 THEN height_child_cm - 0.7e0 ELSE height_child_cm END"""
_RANGED = ", ".join(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}" for c, (lo, hi) in RANGES.items())


def scores_sql(rows: str) -> str:
    """CTEs from rows with measurements to rows with scores, as ``scored``."""
    parts = {
        "haz": ("CASE WHEN age_child_months < 24 THEN 'haz_l' ELSE 'haz_h' END", "age_child_months", "hc", -6, 6),
        "waz": ("'waz'", "age_child_months", "weight_child_kg", -6, 5),
        "whz": ("CASE WHEN age_child_months < 24 THEN 'whz_l' WHEN age_child_months >= 24 THEN 'whz_h' END", "height_child_cm", "weight_child_kg", -5, 5),
    }
    joins = " ".join(f"LEFT JOIN seg {a} ON {on_segment(a, i, x)}" for a, (i, x, *_) in parts.items())
    lms = ", ".join(f"{mixed(a, n, x)} AS {a}_{n}" for a, (_, x, *_r) in parts.items() for n in "lms")
    z = ", ".join(f"{z_of(v, f'{a}_l', f'{a}_m', f'{a}_s')} AS {a}_z" for a, (_, _x, v, *_r) in parts.items())
    kept = ", ".join(
        f"CASE WHEN {a}_z BETWEEN {lo} AND {hi} THEN {a}_z END AS {a}_score" for a, (_, _x, _v, lo, hi) in parts.items()
    )
    return f"""{SEGMENTS},
 keyed AS (SELECT *, CASE WHEN sex_child IN (1, 2) THEN CAST(sex_child AS INT) END AS sx, {_CORRECTED} AS hc FROM ({rows})),
 found AS (SELECT keyed.*, {lms} FROM keyed {joins}),
 raw AS (SELECT *, {z} FROM found),
 flagged AS (SELECT *, {kept} FROM raw),
 scored AS (SELECT *, CASE WHEN haz_score < -2 THEN 1 WHEN haz_score IS NOT NULL THEN 0 END::BIGINT AS stunting_binary FROM flagged)"""


_ROWS = f"SELECT * REPLACE ({_RANGED}) FROM ({SURVEY_SQL})"

SQL = {
    "lms_lookup": f"""WITH {SEGMENTS},
 v AS (SELECT p_partkey, CASE WHEN p_size < 24 THEN 'haz_l' ELSE 'waz' END AS ind,
   CASE WHEN 1 + p_partkey % 3 < 3 THEN 1 + p_partkey % 3 END AS sx,
   p_size + CASE WHEN p_partkey % 2 = 0 THEN 0.25e0 WHEN p_partkey % 5 = 0 THEN 30e0 ELSE 0e0 END AS key FROM part)
 SELECT p_partkey, {', '.join(f"round({mixed('seg', n, 'key')}, 9) AS {n}" for n in 'lms')}
 FROM v LEFT JOIN seg ON {on_segment('seg', 'ind', 'key')}""",
    "lms_scores": f"""WITH v AS (SELECT l_orderkey, l_linenumber,
   l_extendedprice - CASE WHEN l_linenumber = 7 THEN 60000e0 ELSE 0e0 END AS v,
   CASE l_linenumber % 3 WHEN 0 THEN 0e0 WHEN 1 THEN 1e0 ELSE -0.35e0 END AS l, 30000e0 + l_quantity * 100e0 AS m FROM lineitem)
 SELECT l_orderkey, l_linenumber, round({z_of('v', 'l', 'm', '0.125e0')}, 9) AS z FROM v""",
    "standing_height": f"SELECT id_ruta, height_child_cm, round({_CORRECTED}, 6) AS corrected FROM ({SURVEY_SQL})",
    "growth_indices": f"""WITH {scores_sql(_ROWS)}
 SELECT source_flag, id_ruta, age_child_months, round(haz_score, 6) AS haz_score, round(waz_score, 6) AS waz_score,
 round(whz_score, 6) AS whz_score, stunting_binary FROM scored""",
    "index_counts": f"""WITH {scores_sql(_ROWS)}
 SELECT source_flag, count(*) AS n_rows, count(haz_score) AS n_valid, CAST(coalesce(sum(stunting_binary), 0) AS BIGINT) AS n_positive
 FROM scored GROUP BY 1""",
}
