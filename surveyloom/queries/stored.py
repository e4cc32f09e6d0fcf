"""Questions answered from stored profiles, beside the same questions about the rows."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import stored as ops
from surveyloom.queries import availability, contract, impute
from surveyloom.queries.availability import SOURCES, THERE, cleaned
from surveyloom.queries.base import SURVEY_SQL, survey
from surveyloom.session import checkpoint_root

BY = ["source_flag", "kohort"]
MERGED = ["age_child_months", "height_child_cm", "weight_child_kg", "visit_1", "visit_2", "edu_mother", "svy_weight"]


def _stored(spark: SparkSession, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Each source profiled by itself, one of them twice."""
    path = os.path.join(checkpoint_root(spark), f"profiles-{uuid.uuid4().hex}")
    for source in (*SOURCES, SOURCES[0]):
        ops.store_profile(rows.where(F.col("source_flag") == source), columns, BY, path)
    return ops.read_profile(spark, path)


def eligibility_from_store(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaned(spark, sf).select(*BY, *impute.FEATURES)
    return ops.eligible(_stored(spark, rows, impute.FEATURES), BY, impute.RULE)


def shares_from_store(spark: SparkSession, sf: str) -> DataFrame:
    return ops.shares(_stored(spark, cleaned(spark, sf), list(THERE)), *BY)


def contract_from_store(spark: SparkSession, sf: str) -> DataFrame:
    rows = contract._table(spark, sf)
    return ops.contract_rows(_stored(spark, rows, [c for c in rows.columns if c not in BY]), *BY)


def profiles_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables, of which one lacks a column, profiled apart and put together."""
    rows = survey(spark, sf)
    even = F.coalesce(F.col("age_child_months") % 2 == 0, F.lit(False))
    halves = [(rows.where(even), MERGED), (rows.where(~even), [c for c in MERGED if c != "visit_2"])]
    found = ops.merge_profiles([ops.profile_rows(df, columns, BY[:1]) for df, columns in halves], BY[:1])
    sd = F.sqrt(F.col("squares") / F.col("known"))
    return found.select(
        "source_flag", "column", "n", "filled", "known", F.round("min", 6).alias("low"), F.round("max", 6).alias("high"),
        F.round("mean", 6).alias("mean"), F.round(sd, 6).alias("sd"),
    )


QUERIES = {f.__name__: f for f in (eligibility_from_store, shares_from_store, contract_from_store, profiles_merged)}

_PART = " UNION ALL ".join(
    f"SELECT source_flag, '{c}' AS \"column\", count(*) AS n, count({v}) AS filled, count({v}) AS known, round(min(CAST({v} AS DOUBLE)), 6) AS low,"
    f" round(max(CAST({v} AS DOUBLE)), 6) AS high, round(avg({v}), 6) AS mean, round(stddev_pop({v}), 6) AS sd FROM t GROUP BY 1"
    for c, v in ((c, "CASE WHEN age_child_months % 2 = 0 THEN visit_2 END" if c == "visit_2" else c) for c in MERGED)
)

SQL = {
    "eligibility_from_store": impute.SQL["feature_eligibility"],
    "shares_from_store": f"SELECT * FROM ({availability.SQL['availability_shares']}) WHERE variable <> 'not_there'",
    "contract_from_store": contract.SQL["contract_profile"],
    "profiles_merged": f"WITH t AS ({SURVEY_SQL}) {_PART}",
}
