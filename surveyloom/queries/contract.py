"""Schema contracts and synthetic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import contract as ops
from surveyloom.operators import synthetic
from surveyloom.operators.cleaning import assign_cohort
from surveyloom.operators.impute import value_domains as domains_of
from surveyloom.queries.availability import COHORT, _MATRIX, availability_matrix, CELLS
from surveyloom.queries.base import SURVEY_SQL, load, survey
from surveyloom.specs import Encoding

BY = ["source_flag", "kohort"]
CODED = ["area_type", "food_1", "imm_1", "edu_mother", "water_source", "visit_2"]
ENCODING = Encoding({"biner": ("area_type", "food_1", "food_2", "stunting_binary"), "ordinal": ("edu_mother",), "nominal": ("water_source",)})
LABEL = "stunting_binary"
SHAPES = {"age_child_months": (30.0, 16.0, 0.0, 59.0), "height_child_cm": (85.0, 12.0, 45.0, 125.0)}


def _table(spark: SparkSession, sf: str) -> DataFrame:
    df = assign_cohort(survey(spark, sf), COHORT)
    df = df.withColumn(LABEL, F.when(F.col("imm_1") != 4, (F.col("imm_1") == 1).cast("bigint")))
    return df.withColumn("food_2", F.when(F.col("source_flag") != "R", F.col("food_2"))).drop("id_ruta")


def contract_profile(spark: SparkSession, sf: str) -> DataFrame:
    return ops.contract_profile(_table(spark, sf), *BY)


def value_domains(spark: SparkSession, sf: str) -> DataFrame:
    return domains_of(_table(spark, sf), CODED, ["source_flag"])


def value_domains_whole(spark: SparkSession, sf: str) -> DataFrame:
    return domains_of(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], [], whole=True)


def absent_cells(spark: SparkSession, sf: str) -> DataFrame:
    return ops.absent_cells(availability_matrix(spark, sf), CELLS, ["food_1", "food_2", "asset_c", "not_there"])


def contract_conformance(spark: SparkSession, sf: str) -> DataFrame:
    """A table against a variant with a column more, one less, one retyped and one emptied in a cell."""
    table = _table(spark, sf).select(*BY, "age_child_months", "edu_mother", "food_1", "imm_2")
    other = table.select(
        *BY, "age_child_months", F.col("edu_mother").cast("int").alias("edu_mother"),
        F.when(F.col("source_flag") != "A", F.col("food_1")).alias("food_1"), F.col("imm_2").alias("imm_9"),
    )
    return ops.compare_profiles(ops.contract_profile(table, *BY), ops.contract_profile(other, *BY))


def _contract(spark: SparkSession, sf: str):
    table = _table(spark, sf).withColumn("food_1_missing", F.col("food_1").isNull().cast("tinyint"))
    return ops.contract_from_data(table, ENCODING, *BY, LABEL, {"baduta": 0.1427, "balita_tua": 0.2215})


def synthetic_table(spark: SparkSession, sf: str) -> DataFrame:
    """As many rows as the line items have, from their contract alone."""
    contract = _contract(spark, sf)
    return synthetic.synthetic_table(
        spark, contract, sum(contract.cell_counts.values()), 42, LABEL, frozenset(SHAPES), SHAPES, *BY
    )


def synthetic_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cell sizes, absences and value bounds of the synthetic table against its contract."""
    return synthetic_table(spark, sf).groupBy(*BY).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count("food_2") == 0).alias("food_2_absent"),
        (F.min("age_child_months") >= 0).alias("age_lo"),
        (F.max("age_child_months") <= 59).alias("age_hi"),
        F.count_if(~F.col("area_type").isin(1, 2)).alias("strange_area"),
        F.count_if(F.col("food_1_missing") != F.col("food_1").isNull().cast("int")).alias("strange_flag"),
    )


def synthetic_moments(spark: SparkSession, sf: str) -> DataFrame:
    """Mean, spread and label share of every cell of the synthetic table, as the contract has them."""
    mean, sd, lo, hi = SHAPES["height_child_cm"]
    share = F.avg(F.col(LABEL).cast("double"))
    expected = _table(spark, sf).where("kohort IS NOT NULL").groupBy("kohort").agg(F.avg(F.col(LABEL).cast("double")).alias("p"))
    made = synthetic_table(spark, sf).groupBy(*BY).agg(
        F.count("*").alias("n"), F.avg("height_child_cm").alias("mean"), F.stddev("height_child_cm").alias("sd"), share.alias("share"),
        F.min("height_child_cm").alias("lo"), F.max("height_child_cm").alias("hi"),
    )
    error = F.lit(5.0) / F.sqrt("n")
    return made.join(expected, "kohort").select(
        *BY, "n", (F.abs(F.col("mean") - mean) < sd * error).alias("mean_ok"), (F.abs(F.col("sd") - sd) < sd * error + 0.3).alias("sd_ok"),
        ((F.col("lo") >= lo) & (F.col("hi") <= hi)).alias("bounds_ok"), (F.abs(F.col("share") - F.col("p")) < error).alias("share_ok"),
    )


def _schema_contract(spark: SparkSession, sf: str):
    matrix = availability_matrix(spark, sf)
    encoding = Encoding({**ENCODING.groups, "meta": tuple(BY)})
    return ops.contract_from_schema(
        encoding, matrix, ["A", "N", "R"], ["baduta", "balita_tua"], LABEL, {"A": 0.5, "N": 0.3, "R": 0.2}, 0.4, {"baduta": 0.2}
    )


def contract_of_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Contract without data: columns, types, domains and absent cells, and the cell counts."""
    contract = _schema_contract(spark, sf)
    rows = [
        (c, contract.dtype[c], ",".join(map(str, contract.domains.get(c, []))), ",".join(sorted("|".join(x) for x in contract.struct_absent[c])))
        for c in contract.columns
    ]
    rows += [(cell, "rows", str(n), "") for cell, n in contract.cell_counts.items()]
    return spark.createDataFrame(rows, "name string, kind string, domain string, absent string")


def synthetic_without_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A contract without cell counts: rows by the shares of source and cohort."""
    contract = _schema_contract(spark, sf)
    contract.cell_counts = {}
    n = load(spark, sf, "orders").count()
    shares = {(s, k): p * q for s, p in (("A", 0.5), ("N", 0.3), ("R", 0.2)) for k, q in (("baduta", 0.4), ("balita_tua", 0.6))}
    made = synthetic.synthetic_table(spark, contract, n, 7, LABEL, frozenset(SHAPES), SHAPES, *BY, shares=shares)
    return made.groupBy(*BY).agg(F.count("*").alias("n"), F.count_if(~F.col("edu_mother").between(1, 5)).alias("strange")).withColumn(
        "orders", F.lit(n).cast("long")
    )


def missing_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = survey(spark, sf).select("source_flag", "asset_a", "food_1")
    return synthetic.add_missing_flags(rows, ["asset_a_missing", "food_1_missing", "gone_missing"])


def cast_to_contract(spark: SparkSession, sf: str) -> DataFrame:
    rows = survey(spark, sf).select("source_flag", "asset_a", "food_1", "water_source")
    contract = ops.Contract(
        ["water_source", "food_1", "asset_a", "source_flag"],
        {"water_source": "int", "food_1": "tinyint", "asset_a": "double", "source_flag": "string"},
    )
    return synthetic.cast_to_contract(rows, contract)


QUERIES = {
    f.__name__: f
    for f in (
        contract_profile, value_domains, value_domains_whole, absent_cells, contract_conformance, synthetic_table,
        synthetic_cells, synthetic_moments, contract_of_schema, synthetic_without_counts, missing_flags, cast_to_contract,
    )
}

_COHORT = "CASE WHEN age_child_months < 24 THEN 'baduta' WHEN age_child_months >= 24 THEN 'balita_tua' END"
_OLD = "coalesce(age_child_months >= 24, false)"
TABLE_SQL = f"""SELECT * EXCLUDE (id_ruta) REPLACE (CASE WHEN NOT {_OLD} THEN food_1 END AS food_1,
   CASE WHEN source_flag <> 'R' AND NOT {_OLD} THEN food_2 END AS food_2), {_COHORT} AS kohort,
   CASE WHEN imm_1 <> 4 THEN CAST(imm_1 = 1 AS BIGINT) END AS stunting_binary FROM ({SURVEY_SQL})"""
_TYPES = {
    "age_child_months": "double", "sex_child": "double", "measure_position": "double", "height_child_cm": "double",
    "weight_child_kg": "double", "area_type": "double", "asset_a": "int", "asset_b": "int", "asset_c": "int",
    "asset_d": "int", "visit_1": "double", "visit_2": "double", "food_1": "double", "food_2": "double", "imm_1": "double",
    "imm_2": "double", "imm_vit_a_count": "double", "ttd_count": "double", "occupation_mother": "double",
    "edu_mother": "double", "water_source": "string", "svy_weight": "double", "stunting_binary": "bigint",
}


def _profile(table: str, types: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, source_flag AS source, kohort AS cohort, count(*) AS n, count({c}) AS filled, "
        f"count({c}) = 0 AS absent FROM {table} WHERE kohort IS NOT NULL GROUP BY 3, 4"
        for c, t in types.items()
    )


SQL = {
    "contract_profile": f"WITH t AS ({TABLE_SQL}) {_profile('t', _TYPES)}",
    "value_domains": f"WITH t AS ({TABLE_SQL}) "
    + " UNION ALL ".join(
        f"SELECT DISTINCT source_flag, '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM t WHERE {c} IS NOT NULL" for c in CODED
    ),
    "value_domains_whole": " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS variable, round_even({c}, 0) AS value FROM lineitem WHERE {c} IS NOT NULL"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
    "absent_cells": f"{_MATRIX}, long AS (" + " UNION ALL ".join(
        f"SELECT variabel, '{c}' AS cell, \"{c}\" AS share FROM matrix" for c in CELLS
    ) + ") SELECT variabel, cell FROM long WHERE share <= 0.02 AND variabel IN ('food_1', 'food_2', 'asset_c', 'not_there')",
    "contract_conformance": f"""WITH t AS ({TABLE_SQL}),
 o AS (SELECT source_flag, kohort, age_child_months, edu_mother, CASE WHEN source_flag <> 'A' THEN food_1 END AS food_1, imm_2 AS imm_9 FROM t),
 l AS ({_profile('t', {c: 'double' for c in ('age_child_months', 'edu_mother', 'food_1', 'imm_2')})}),
 r AS ({_profile('o', {'age_child_months': 'double', 'edu_mother': 'int', 'food_1': 'double', 'imm_9': 'double'})}),
 b AS (SELECT "column", source, cohort, l.dtype AS dtype_left, l.absent AS absent_left, r.dtype AS dtype_right, r.absent AS absent_right
   FROM l FULL JOIN r USING ("column", source, cohort))
 SELECT * FROM (SELECT *, CASE WHEN dtype_left IS NULL THEN 'missing_left' WHEN dtype_right IS NULL THEN 'missing_right'
  WHEN dtype_left <> dtype_right THEN 'dtype' WHEN absent_left <> absent_right THEN 'absence' END AS problem FROM b) WHERE problem IS NOT NULL""",
    "synthetic_cells": f"""WITH t AS ({TABLE_SQL})
 SELECT source_flag, kohort, count(*) AS n, count(food_2) = 0 AS food_2_absent, true AS age_lo, true AS age_hi,
 CAST(0 AS BIGINT) AS strange_area, CAST(0 AS BIGINT) AS strange_flag FROM t WHERE kohort IS NOT NULL GROUP BY 1, 2""",
    "synthetic_moments": f"""WITH t AS ({TABLE_SQL}) SELECT source_flag, kohort, count(*) AS n, true AS mean_ok, true AS sd_ok,
 true AS bounds_ok, true AS share_ok FROM t WHERE kohort IS NOT NULL GROUP BY 1, 2""",
    "contract_of_schema": f"""{_MATRIX}, long AS (""" + " UNION ALL ".join(
        f"SELECT variabel, '{c.replace('_', '|', 1)}' AS cell, \"{c}\" AS share FROM matrix" for c in CELLS
    ) + """), gone AS (SELECT variabel, string_agg(cell, ',' ORDER BY cell) AS cells FROM long WHERE share <= 0.02 GROUP BY 1),
 c(name, kind, domain) AS (VALUES ('area_type', 'tinyint', '0,1'), ('food_1', 'tinyint', '0,1'), ('food_2', 'tinyint', '0,1'),
   ('stunting_binary', 'tinyint', ''), ('edu_mother', 'double', '1,2,3,4,5'), ('water_source', 'double', '1,2,3,4,5,6'), ('source_flag', 'string', ''), ('kohort', 'string', ''))
 SELECT name, kind, domain, coalesce(cells, '') AS absent FROM c LEFT JOIN gone ON variabel = name
 UNION ALL SELECT s || '|' || k, 'rows', CAST(CAST(round_even(1000 * p * q, 0) AS INT) AS VARCHAR), '' FROM
   (VALUES ('A', 0.5e0), ('N', 0.3e0), ('R', 0.2e0)) AS a(s, p), (VALUES ('baduta', 0.4e0), ('balita_tua', 0.6e0)) AS b(k, q)""",
    "synthetic_without_counts": """WITH n AS (SELECT count(*) AS orders FROM orders)
 SELECT s AS source_flag, k AS kohort, CAST(round_even(orders * p * q, 0) AS BIGINT) AS n, CAST(0 AS BIGINT) AS strange, orders FROM n,
   (VALUES ('A', 0.5e0), ('N', 0.3e0), ('R', 0.2e0)) AS a(s, p), (VALUES ('baduta', 0.4e0), ('balita_tua', 0.6e0)) AS b(k, q)""",
    "missing_flags": f"""SELECT source_flag, asset_a, food_1, (asset_a IS NULL)::DOUBLE AS asset_a_missing,
 (food_1 IS NULL)::DOUBLE AS food_1_missing, 0::DOUBLE AS gone_missing FROM ({SURVEY_SQL})""",
    "cast_to_contract": f"""SELECT CAST(water_source AS INT) AS water_source, CAST(food_1 AS TINYINT) AS food_1,
 CAST(asset_a AS DOUBLE) AS asset_a, source_flag FROM ({SURVEY_SQL})""",
}
