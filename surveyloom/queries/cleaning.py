"""Coercion, ranges, cohorts, special codes, recodes and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import cleaning as ops
from surveyloom.queries.base import SURVEY_SQL, derive, load, select, survey
from surveyloom.specs import CohortRule, Encoding, Recodes

TEXT = {
    "event_id": "event_id",
    "answer": (
        "CASE event_id % 12 WHEN 0 THEN CAST(event_id AS STRING) WHEN 1 THEN ' ' || CAST(event_id % 100 AS STRING) || ' ' "
        "WHEN 2 THEN '5d' WHEN 3 THEN 'x' WHEN 4 THEN '' WHEN 5 THEN '1e3' WHEN 6 THEN '.5' WHEN 7 THEN '-3.' "
        "WHEN 8 THEN '+7' WHEN 9 THEN '1,000' WHEN 10 THEN '0x1F' ELSE props END"
    ),
    "measured": "CASE WHEN event_id % 50 = 0 THEN '?' ELSE CAST(event_id % 7 AS STRING) END",
    "seldom": "CASE WHEN event_id % 3 = 0 THEN '1' ELSE event_type END",
}
ANSWERS = {
    "o_orderkey": "o_orderkey",
    "source": "o_orderstatus",
    "code": "substr(o_orderpriority, 1, 1)",
    "score": "CAST(o_custkey % 10 AS DOUBLE)",
}
RANGES = {"height_child_cm": (40, 130), "weight_child_kg": (1, 40), "age_child_months": (0, 60)}
COHORT = CohortRule(age="p_size", young_only=frozenset({"p_brand", "p_retailprice"}))
RECODES = Recodes(
    swap={"F": {"code": {1: 2, 2: 1}}, "P": {"code": {1: 2, 2: 1}}},
    codes={"O": {"code": {1: 1, 2: 1, 3: 2, 4: None}}, "P": {"code": {1: 5, 5: 1}, "score": {0: 7}}},
    binary={"score": ((1, 2), (3, 4))},
    binary_by_source={"F": {"score": ((5, 6, 7), (8, 9))}, "O": {"code": ((1, 2, 3), (4,))}},
)
SURVEY_RECODES = Recodes(
    binary_by_source={
        "A": {"occupation_mother": ((2, 3, 4, 5, 6, 7, 8, 9), (1,))},
        "N": {"occupation_mother": ((2, 3, 4, 5, 6, 7, 8, 9), (1,)), "imm_1": ((1, 2, 3), (4,))},
    },
)
SURVEY_ENCODING = Encoding(
    {
        "biner": ("area_type", "sex_child", "asset_a", "food_2", "imm_1", "occupation_mother", "not_there"),
        "ordinal": ("edu_mother",),
        "nominal": ("water_source",),
        "kontinu": ("age_child_months", "height_child_cm", "weight_child_kg", "visit_2", "ttd_count"),
        "meta": ("source_flag", "id_ruta", "svy_weight"),
        "drop": ("measure_position", "asset_b", "asset_c", "asset_d"),
    }
)
CODES = (8, 88, 98, 99, 998)


def coerce_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return ops.coerce(derive(load(spark, sf, "events"), TEXT), ["answer", "measured", "not_there"])


def numbers_from_text(spark: SparkSession, sf: str) -> DataFrame:
    df = derive(load(spark, sf, "events"), {**TEXT, "value": "value"})
    return ops.coerce_text(df, ["measured", "value"])


def null_outside(spark: SparkSession, sf: str) -> DataFrame:
    return ops.null_outside(survey(spark, sf), RANGES).select("source_flag", "id_ruta", *RANGES)


def outside_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ops.outside_counts(survey(spark, sf), RANGES)


def cohorts(spark: SparkSession, sf: str) -> DataFrame:
    return ops.add_cohort(survey(spark, sf).select("id_ruta", "age_child_months"), CohortRule())


def cohort_mask(spark: SparkSession, sf: str) -> DataFrame:
    parts = load(spark, sf, "part").withColumn("p_size", F.expr("CASE WHEN p_partkey % 17 <> 0 THEN p_size END"))
    return ops.assign_cohort(parts, COHORT)


def null_codes(spark: SparkSession, sf: str) -> DataFrame:
    return ops.null_codes(survey(spark, sf), CODES, ["id_ruta", "svy_weight"])


def swap_codes(spark: SparkSession, sf: str) -> DataFrame:
    return ops.swap_codes(derive(load(spark, sf, "orders"), ANSWERS), RECODES, ops.SourceColumn("source"))


def recode_codes(spark: SparkSession, sf: str) -> DataFrame:
    return ops.recode(derive(load(spark, sf, "orders"), ANSWERS), RECODES, ops.SourceColumn("source"))


def binary_default(spark: SparkSession, sf: str) -> DataFrame:
    return ops.encode_binary(derive(load(spark, sf, "orders"), ANSWERS), ["code"], Recodes(), "any")


def binary_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return ops.encode_binary(derive(load(spark, sf, "orders"), ANSWERS), ["code", "score"], RECODES, ops.SourceColumn("source"))


def numeric_shares(spark: SparkSession, sf: str) -> DataFrame:
    return ops.numeric_shares(derive(load(spark, sf, "events"), TEXT))


def infer_types(spark: SparkSession, sf: str) -> DataFrame:
    return ops.infer_types(derive(load(spark, sf, "events"), TEXT))


def encode_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ops.encode(survey(spark, sf), SURVEY_ENCODING, SURVEY_RECODES, ops.SourceColumn("source_flag"), CODES)


QUERIES = {
    f.__name__: f
    for f in (
        coerce_numbers, numbers_from_text, null_outside, outside_counts, cohorts, cohort_mask, null_codes, swap_codes,
        recode_codes, binary_default, binary_by_source, numeric_shares, infer_types, encode_rows,
    )
}


def _number(c: str) -> str:
    return (
        rf"CASE WHEN regexp_matches(trim({c}), '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') "
        f"THEN TRY_CAST(ltrim(trim({c}), '+') AS DOUBLE) END"
    )


_TEXT = select(TEXT, "events")
_ANSWERS = f"SELECT o_orderkey, source, CAST(code AS DOUBLE) AS n, score FROM ({select(ANSWERS, 'orders')})"


def _cleared(c: str) -> str:
    return f"CASE WHEN {c} IN (8, 88, 98, 99, 998) THEN NULL ELSE {c} END"


def _default(c: str) -> str:
    return f"CAST(CASE WHEN {c} = 1 THEN 1 WHEN {c} IN (0, 2) THEN 0 END AS TINYINT)"


_NUMERIC = [
    "age_child_months", "sex_child", "measure_position", "height_child_cm", "weight_child_kg", "area_type", "asset_a",
    "asset_b", "asset_c", "asset_d", "visit_1", "visit_2", "food_1", "food_2", "imm_1", "imm_2", "imm_vit_a_count",
    "ttd_count", "occupation_mother", "edu_mother",
]
_INSIDE = {c: f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END" for c, (lo, hi) in RANGES.items()}

SQL = {
    "coerce_numbers": f"SELECT event_id, {_number('answer')} AS answer, {_number('measured')} AS measured, seldom FROM ({_TEXT})",
    "numbers_from_text": f"""SELECT event_id, answer, {_number('measured')} AS measured, seldom, value
 FROM ({select({**TEXT, 'value': 'value'}, 'events')})""",
    "null_outside": f"SELECT source_flag, id_ruta, {', '.join(f'{e} AS {c}' for c, e in _INSIDE.items())} FROM ({SURVEY_SQL})",
    "outside_counts": f"SELECT {', '.join(f'count(CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 END) AS {c}' for c, (lo, hi) in RANGES.items())} FROM ({SURVEY_SQL})",
    "cohorts": f"""SELECT id_ruta, age_child_months, CASE WHEN age_child_months < 24 THEN 'baduta'
 WHEN age_child_months >= 24 THEN 'balita_tua' END AS kohort FROM ({SURVEY_SQL})""",
    "cohort_mask": """WITH p AS (SELECT * REPLACE (CASE WHEN p_partkey % 17 <> 0 THEN p_size END AS p_size) FROM part)
 SELECT p_partkey, p_name, CASE WHEN p_size IS NULL OR p_size < 24 THEN p_brand END AS p_brand, p_type, p_size,
 CASE WHEN p_size IS NULL OR p_size < 24 THEN p_retailprice END AS p_retailprice,
 CASE WHEN p_size < 24 THEN 'baduta' WHEN p_size >= 24 THEN 'balita_tua' END AS kohort FROM p""",
    "null_codes": f"""SELECT source_flag, id_ruta, water_source, svy_weight,
 {', '.join(f'{_cleared(c)} AS {c}' for c in _NUMERIC)} FROM ({SURVEY_SQL})""",
    "swap_codes": f"""SELECT o_orderkey, source, score, CASE WHEN source IN ('F', 'P') AND n = 1 THEN 2.0::DOUBLE
 WHEN source IN ('F', 'P') AND n = 2 THEN 1.0::DOUBLE ELSE n END AS code FROM ({_ANSWERS})""",
    "recode_codes": f"""SELECT o_orderkey, source,
 CASE source WHEN 'O' THEN CASE WHEN n IN (1, 2) THEN 1.0::DOUBLE WHEN n = 3 THEN 2.0::DOUBLE END
  WHEN 'P' THEN CASE n WHEN 1 THEN 5.0::DOUBLE WHEN 5 THEN 1.0::DOUBLE END ELSE n END AS code,
 CASE WHEN source <> 'P' THEN score WHEN score = 0 THEN 7.0::DOUBLE END AS score FROM ({_ANSWERS})""",
    "binary_default": f"SELECT o_orderkey, source, {_default('n')} AS code, score FROM ({_ANSWERS})",
    "binary_by_source": f"""SELECT o_orderkey, source,
 CASE WHEN source = 'O' THEN CAST(CASE WHEN n IN (1, 2, 3) THEN 1 WHEN n = 4 THEN 0 END AS TINYINT) ELSE {_default('n')} END AS code,
 CAST(CASE WHEN source = 'F' THEN CASE WHEN score IN (5, 6, 7) THEN 1 WHEN score IN (8, 9) THEN 0 END
  ELSE CASE WHEN score IN (1, 2) THEN 1 WHEN score IN (3, 4) THEN 0 END END AS TINYINT) AS score FROM ({_ANSWERS})""",
    "numeric_shares": f"""SELECT {', '.join(f'avg(CASE WHEN {_number(c)} IS NULL THEN 0 ELSE 1 END) AS {c}'
  for c in ('answer', 'measured', 'seldom'))} FROM ({_TEXT})""",
    "infer_types": f"SELECT event_id, answer, {_number('measured')} AS measured, seldom FROM ({_TEXT})",
    "encode_rows": f"""SELECT source_flag, id_ruta, svy_weight,
 {', '.join(f'{_cleared(c)} AS {c}' for c in ('age_child_months', 'height_child_cm', 'weight_child_kg', 'visit_1', 'visit_2', 'food_1', 'imm_2', 'imm_vit_a_count', 'ttd_count', 'edu_mother'))},
 {', '.join(f'{_default(_cleared(c))} AS {c}' for c in ('area_type', 'sex_child', 'asset_a', 'food_2'))},
 CASE WHEN source_flag = 'N' THEN CAST(CASE WHEN imm_1 IN (1, 2, 3) THEN 1 WHEN imm_1 = 4 THEN 0 END AS TINYINT) ELSE {_default('imm_1')} END AS imm_1,
 CASE WHEN source_flag IN ('A', 'N') THEN CAST(CASE WHEN occupation_mother IN (2, 3, 4, 5, 6, 7, 9) THEN 1 WHEN occupation_mother = 1 THEN 0 END AS TINYINT)
  ELSE {_default('occupation_mother')} END AS occupation_mother,
 CAST(water_source AS DOUBLE) AS water_source FROM ({SURVEY_SQL})""",
}
