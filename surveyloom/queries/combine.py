"""Stacking sources and the validation report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import combine as ops
from surveyloom.queries.base import derive, load, select

CUSTOMERS = {
    "id_ruta": "c_custkey",
    "balance": "c_acctbal",
    "flag": "CAST(c_custkey % 2 AS TINYINT)",
    "segment": "c_mktsegment",
    "code": "CAST(c_custkey % 3 AS DOUBLE)",
    "balance_missing": "CAST(c_custkey % 2 AS TINYINT)",
}
SUPPLIERS = {
    "id_ruta": "s_name",
    "balance": "CAST(s_acctbal AS INT)",
    "flag": "CAST(s_suppkey % 5 AS INT)",
    "code": "'x' || CAST(s_suppkey AS STRING)",
}
ORDERS = {
    "source_flag": "o_orderstatus",
    "kohort": "CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 < 3 THEN 'baduta' ELSE 'balita_tua' END",
    "stunting_binary": "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_totalprice > 300000 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END",
    "price": "o_totalprice",
}


def stack_sources(spark: SparkSession, sf: str) -> DataFrame:
    return ops.stack(
        {
            "customer": derive(load(spark, sf, "customer"), CUSTOMERS),
            "supplier": derive(load(spark, sf, "supplier"), SUPPLIERS),
        },
        "source_flag",
    )


def fill_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return ops.fill_indicators(stack_sources(spark, sf))


def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    return ops.validation_report(derive(load(spark, sf, "orders"), ORDERS), "source_flag", "kohort", "stunting_binary")


def prevalence(spark: SparkSession, sf: str) -> DataFrame:
    return ops.prevalence(derive(load(spark, sf, "orders"), ORDERS), "kohort", "stunting_binary")


def rows_per_cell_label(spark: SparkSession, sf: str) -> DataFrame:
    cells = ops.cell_counts(derive(load(spark, sf, "orders"), ORDERS), ["source_flag", "kohort"], "stunting_binary")
    return cells.withColumn("total", F.col("total").cast("bigint"))


QUERIES = {f.__name__: f for f in (stack_sources, fill_indicators, validation_report, prevalence, rows_per_cell_label)}

_STACK = f"""SELECT CAST(id_ruta AS VARCHAR) AS id_ruta, balance, CAST(flag AS INT) AS flag, segment,
  CAST(code AS BIGINT) || '.0' AS code, balance_missing, 'customer' AS source_flag FROM ({select(CUSTOMERS, 'customer')})
 UNION ALL SELECT id_ruta, CAST(balance AS DOUBLE), flag, NULL, code, NULL, 'supplier'
 FROM ({select({**SUPPLIERS, 'balance': 'CAST(trunc(s_acctbal) AS INT)'}, 'supplier')})"""
_O = select(ORDERS, "orders")

SQL = {
    "stack_sources": _STACK,
    "fill_indicators": f"SELECT * REPLACE (CAST(coalesce(balance_missing, 0) AS TINYINT) AS balance_missing) FROM ({_STACK})",
    "validation_report": f"""WITH o AS ({_O})
 SELECT 'total_baris' AS metric, NULL::VARCHAR AS key, count(*)::DOUBLE AS value FROM o
 UNION ALL SELECT 'total_kolom', NULL, 4.0::DOUBLE
 UNION ALL SELECT 'baris_per_sumber', source_flag, count(*)::DOUBLE FROM o GROUP BY 2
 UNION ALL SELECT 'baris_per_kohort', kohort, count(*)::DOUBLE FROM o GROUP BY 2
 UNION ALL SELECT 'prevalensi_per_kohort', kohort, round_even(avg(stunting_binary), 4) FROM o WHERE kohort IS NOT NULL GROUP BY 2""",
    "prevalence": f"SELECT kohort, round_even(avg(stunting_binary), 4) AS prevalence FROM ({_O}) WHERE kohort IS NOT NULL GROUP BY 1",
    "rows_per_cell_label": f"""SELECT source_flag, kohort, count(*) AS n, count(stunting_binary) AS n_known,
 CAST(sum(stunting_binary) AS BIGINT) AS total FROM ({_O}) GROUP BY 1, 2""",
}
