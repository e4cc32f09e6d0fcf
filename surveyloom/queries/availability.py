"""Availability of variables by source and cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import availability as ops
from surveyloom.operators.cleaning import add_cohort, assign_cohort, null_codes, null_outside
from surveyloom.queries.base import DICTIONARY_SQL, SURVEY_SQL, dictionary, load, survey
from surveyloom.specs import CohortRule

SOURCES = ("A", "N", "R")
CODES = (2, 8, 88, 98, 99, 998)
RANGES = {"height_child_cm": (40, 130), "weight_child_kg": (1, 40), "age_child_months": (0, 60)}
COHORT = CohortRule(young_only=frozenset({"food_1", "food_2"}))
VARIABLES = (
    "height_child_cm", "weight_child_kg", "measure_position", "asset_a", "asset_c", "visit_1", "visit_2",
    "food_1", "food_2", "imm_2", "ttd_count", "not_there",
)
THERE = [v for v in VARIABLES if v != "not_there"]
CELLS = [f"{s}_{k}" for s in SOURCES for k in ("baduta", "balita_tua")]
_IN_CODES = ", ".join(str(c) for c in CODES)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    df = null_outside(survey(spark, sf), RANGES)
    df = add_cohort(df, COHORT, null_is_old=True)
    return null_codes(df, CODES, ("source_flag", "id_ruta", "svy_weight", "age_child_months"))


def availability_shares(spark: SparkSession, sf: str) -> DataFrame:
    return ops.availability(cleaned(spark, sf), VARIABLES, "source_flag", "kohort")


def availability_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return ops.availability_matrix(availability_shares(spark, sf), SOURCES, "baduta", "balita_tua")


def feature_sets(spark: SparkSession, sf: str) -> DataFrame:
    return ops.feature_sets(availability_matrix(spark, sf), "baduta", "balita_tua")


def cell_labels(spark: SparkSession, sf: str) -> DataFrame:
    return ops.cell_labels(availability_matrix(spark, sf), CELLS)


def rows_per_cell(spark: SparkSession, sf: str) -> DataFrame:
    return ops.rows_per_cell(availability_shares(spark, sf))


def candidate_variables(spark: SparkSession, sf: str) -> DataFrame:
    return ops.candidates(dictionary(spark, sf), "META", ["asset_0", "food_3"])


def structural_gaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "part").select(
        (F.col("p_size") * 1.0).alias("age_child_months"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_size")).alias("food_1"),
        F.col("p_brand").alias("brand"),
        F.when((F.col("p_size") >= 24) | (F.col("p_partkey") % 4 == 0), F.col("p_retailprice")).alias("price"),
    )
    df = assign_cohort(rows, COHORT)
    return ops.structural_gaps(df, "kohort", "baduta", "balita_tua", sorted(COHORT.young_only), ["age_child_months"])


QUERIES = {
    f.__name__: f
    for f in (
        availability_matrix, availability_shares, feature_sets, cell_labels, rows_per_cell, candidate_variables,
        structural_gaps,
    )
}


def _known(c: str) -> str:
    inside = ""
    if c in RANGES:
        lo, hi = RANGES[c]
        inside = f" AND {c} BETWEEN {lo} AND {hi}"
    return f"count(CASE WHEN {c} NOT IN ({_IN_CODES}){inside} THEN 1 END)"


_AGE = "CASE WHEN age_child_months BETWEEN 0 AND 60 AND age_child_months < 24 THEN 'baduta' ELSE 'balita_tua' END"
_WIDE = f"""SELECT source_flag AS source, {_AGE} AS cohort, count(*) AS n,
 {', '.join(f'{_known(c)} AS "{c}"' for c in THERE)}, CAST(0 AS BIGINT) AS not_there
 FROM ({SURVEY_SQL}) GROUP BY 1, 2"""
_SHARES = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, source, cohort, n, \"{c}\" AS filled, \"{c}\" / n AS share FROM wide"
    for c in VARIABLES
)
_CELL = ", ".join(
    f"coalesce(max(CASE WHEN source || '_' || cohort = '{c}' THEN share END), 0) AS \"{c}\"" for c in CELLS
)


def _enough(k: str) -> str:
    return " + ".join(f"CASE WHEN \"{s}_{k}\" >= 0.5 THEN 1 ELSE 0 END" for s in SOURCES)


_MATRIX = f"""WITH wide AS ({_WIDE}), shares AS ({_SHARES}),
 pivoted AS (SELECT variable AS variabel, {_CELL} FROM shares GROUP BY 1),
 counted AS (SELECT *, {_enough('baduta')} AS nb, {_enough('balita_tua')} AS nt FROM pivoted),
 matrix AS (SELECT variabel, {', '.join(f'round_even("{c}", 3) AS "{c}"' for c in CELLS)},
   CAST(nb AS INT) AS n_sumber_baduta, CAST(nt AS INT) AS n_sumber_balita_tua,
   CASE nb WHEN 3 THEN 'kuat' WHEN 2 THEN 'sebagian' WHEN 1 THEN 'lemah' ELSE 'tidak' END AS lintas_sumber_baduta
   FROM counted)"""

SQL = {
    "availability_matrix": f"{_MATRIX} SELECT * FROM matrix",
    "availability_shares": f"WITH wide AS ({_WIDE}) {_SHARES}",
    "feature_sets": f"""{_MATRIX}
 SELECT 'universal' AS feature_set, variabel, n_sumber_baduta, n_sumber_balita_tua FROM matrix WHERE n_sumber_baduta = 3
 UNION ALL SELECT 'heterogen', variabel, n_sumber_baduta, n_sumber_balita_tua FROM matrix WHERE n_sumber_baduta IN (1, 2)
 UNION ALL SELECT 'baduta_only', variabel, n_sumber_baduta, n_sumber_balita_tua FROM matrix
   WHERE n_sumber_baduta >= 1 AND n_sumber_balita_tua = 0""",
    "cell_labels": f"""{_MATRIX}, long AS ({' UNION ALL '.join(
        f"SELECT variabel, '{c}' AS cell, " + f'"{c}" AS share FROM matrix' for c in CELLS)})
 SELECT *, CASE WHEN share >= 0.5 THEN 'tersedia' WHEN share < 0.05 THEN 'absen' ELSE 'parsial' END AS label FROM long""",
    "rows_per_cell": f"SELECT source_flag AS source, {_AGE} AS cohort, count(*) AS n FROM ({SURVEY_SQL}) GROUP BY 1, 2",
    "candidate_variables": f"""SELECT standard_name, min(category) AS category, min(pos) AS pos FROM ({DICTIONARY_SQL})
 WHERE role <> 'META' AND standard_name NOT IN ('asset_0', 'food_3') GROUP BY 1""",
    "structural_gaps": """WITH c AS (SELECT CASE WHEN p_size < 24 THEN 'baduta' ELSE 'balita_tua' END AS kohort,
   CASE WHEN p_partkey % 3 <> 0 AND p_size < 24 THEN p_size END AS food_1, p_brand AS brand,
   CASE WHEN p_size >= 24 OR p_partkey % 4 = 0 THEN p_retailprice END AS price FROM part),
 r AS (SELECT kohort, (count(*) - count(food_1)) / count(*) AS food_1, (count(*) - count(brand)) / count(*) AS brand,
   (count(*) - count(price)) / count(*) AS price FROM c GROUP BY 1),
 u AS (UNPIVOT r ON food_1, brand, price INTO NAME variable VALUE rate),
 g AS (SELECT variable, max(CASE WHEN kohort = 'baduta' THEN rate END) AS null_young,
   max(CASE WHEN kohort = 'balita_tua' THEN rate END) AS null_old FROM u GROUP BY 1)
 SELECT variable, null_young, null_old, null_old - null_young AS gap, variable IN ('food_1', 'food_2') AS declared
 FROM g WHERE abs(null_old - null_young) >= 0.5""",
}
