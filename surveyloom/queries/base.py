"""Stand-in tables, stated once as SQL expressions both engines read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.session import configure, spread


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.expr(e.replace("LIST(", "array(")).alias(n) for n, e in columns.items()])


def select(columns: Mapping[str, str], table: str) -> str:
    inner = ", ".join(f"{e.replace('LIST(', 'list_value(')} AS {n}" for n, e in columns.items())
    return f"SELECT {inner} FROM {table}"


#: Line items as survey rows: three sources (l_returnflag), an age, measurements with codes
#: and impossible values, binary items with "do not know", and text that holds numbers.
SURVEY = {
    "source_flag": "l_returnflag",
    "id_ruta": "CAST(l_orderkey AS STRING)",
    "age_child_months": "CASE WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN 61e0 ELSE l_quantity + 8e0 END",
    "sex_child": "CAST(1 + l_orderkey % 3 AS DOUBLE)",
    "measure_position": "CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE CAST(l_linenumber % 4 AS DOUBLE) END",
    "height_child_cm": "CASE WHEN l_partkey % 29 = 0 THEN 88e0 WHEN l_partkey % 31 = 0 THEN 30e0 ELSE 48e0 + l_quantity * 1.1e0 + l_discount * 80e0 END",
    "weight_child_kg": "CASE WHEN l_suppkey % 23 = 0 THEN 99e0 ELSE 2.5e0 + l_quantity * 0.25e0 + l_tax * 20e0 END",
    "area_type": "CAST(1 + l_partkey % 2 AS DOUBLE)",
    "asset_a": "CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 10 > 5 THEN 2 ELSE 1 END",
    "asset_b": "CASE WHEN l_partkey % 10 > 4 THEN 2 ELSE 1 END",
    "asset_c": "CASE WHEN l_suppkey % 17 = 0 THEN NULL WHEN l_partkey % 10 > 6 THEN 2 ELSE 1 END",
    "asset_d": "CAST(1 + l_suppkey % 2 AS INT)",
    "visit_1": "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END",
    "visit_2": "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_suppkey % 7 = 0 THEN 98e0 ELSE CAST(l_suppkey % 5 AS DOUBLE) END",
    "food_1": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(1 + l_partkey % 2 AS DOUBLE) END",
    "food_2": "CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_suppkey % 9 = 0 THEN 8e0 ELSE CAST(1 + l_suppkey % 2 AS DOUBLE) END",
    "imm_1": "CAST(1 + l_orderkey % 4 AS DOUBLE)",
    "imm_2": "CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE CAST(1 + l_orderkey % 2 AS DOUBLE) END",
    "imm_vit_a_count": "CAST(l_linenumber % 3 AS DOUBLE)",
    "ttd_count": "CASE WHEN l_suppkey % 19 = 0 THEN 998e0 WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_quantity * 3e0 END",
    "occupation_mother": "CAST(1 + l_partkey % 9 AS DOUBLE)",
    "edu_mother": "CAST(l_suppkey % 9 AS DOUBLE)",
    "water_source": "CAST(1 + l_partkey % 15 AS STRING)",
    "svy_weight": "l_extendedprice / 1000e0",
}

SURVEY_SQL = select(SURVEY, "lineitem")


def survey(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spread(load(spark, sf, "lineitem")), SURVEY)


#: Parts as dictionary rows of 25 sources (p_brand), with all shapes a code cell can have.
_K = "CAST(p_partkey AS STRING)"
DICTIONARY = {
    "pos": "CAST(p_partkey AS INT)",
    "standard_name": f"CASE p_partkey % 4 WHEN 0 THEN 'asset_' WHEN 1 THEN 'mother_' WHEN 2 THEN 'father_' ELSE 'food_' END || {_K}",
    "category": "p_type",
    "concept": "p_name",
    "role": "CASE p_size % 7 WHEN 0 THEN 'META' WHEN 1 THEN 'HAPUS_PRIVASI' ELSE 'FITUR' END",
    "source": "p_brand",
    "code_cell": (
        "CASE p_partkey % 10 "
        f"WHEN 0 THEN 'P' || {_K} || 'C​ (WUS)' "
        f"WHEN 1 THEN ' B' || {_K} || 'R1* ' "
        f"WHEN 2 THEN 'ID/' || {_K} "
        "WHEN 3 THEN '—' "
        f"WHEN 4 THEN 'DERIVASI P' || {_K} || 'A+B' || {_K} || '+xx' "
        f"WHEN 5 THEN 'Q' || {_K} "
        f"WHEN 6 THEN 'R' || {_K} "
        f"WHEN 7 THEN 'S_' || {_K} "
        f"WHEN 8 THEN 'T' || {_K} || '*' "
        f"ELSE 'u' || {_K} END"
    ),
}
DICTIONARY_SQL = select(DICTIONARY, "part")

#: The columns of those sources: exact, by case, by squeezed name and with person suffixes.
#: The column ID repeats in every source.
_CODES = (
    "CASE p_partkey % 10 "
    f"WHEN 0 THEN LIST('P' || {_K} || 'C') "
    f"WHEN 1 THEN LIST('b' || {_K} || 'r1') "
    "WHEN 2 THEN LIST('ID', 'id') "
    f"WHEN 4 THEN LIST('p' || {_K} || '_a') "
    f"WHEN 5 THEN LIST('Q' || {_K} || '_ibu') "
    f"WHEN 6 THEN LIST('R' || {_K} || '_ibu', 'R' || {_K} || '_ayah', 'R' || {_K} || '_kk') "
    f"WHEN 7 THEN LIST('S' || {_K}) "
    f"WHEN 9 THEN LIST('U' || {_K}) END"
)
LABEL = "CASE WHEN p_partkey % 10 = 2 THEN '' WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN '' END"
CATALOGUE_SQL = f"""
SELECT source, CAST(p_partkey * 10 + i AS INT) AS pos, codes[i] AS code, label
FROM (SELECT p_brand AS source, p_partkey, {_CODES.replace('LIST(', 'list_value(')} AS codes,
             unnest(generate_series(1, 3)) AS i,
             {LABEL} AS label FROM part)
WHERE codes IS NOT NULL AND i <= len(codes)
"""


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return derive(load(spark, sf, "part"), DICTIONARY)


def catalogue(spark: SparkSession, sf: str, label: str = LABEL) -> DataFrame:
    rows = derive(
        load(spark, sf, "part"),
        {
            "source": "p_brand",
            "p_partkey": "p_partkey",
            "codes": _CODES,
            "label": label,
        },
    )
    return rows.select("source", "p_partkey", "label", F.posexplode("codes").alias("i", "code")).select(
        "source", (F.col("p_partkey") * 10 + F.col("i") + 1).cast("int").alias("pos"), "code", "label"
    )
