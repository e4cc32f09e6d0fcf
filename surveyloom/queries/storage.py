"""Writing and reading back: partitioned Parquet, ORC, JSON, CSV reports, the dictionary file."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.plans.harmonise import finish
from surveyloom.profiles.nutrition import PROFILE
from surveyloom.queries.base import DICTIONARY, DICTIONARY_SQL, derive, load
from surveyloom.session import checkpoint_root
from surveyloom.sources.outputs import write_encoding, write_report, write_table
from surveyloom.sources.tables import (
    load_dictionary, load_encoding, load_lms, read_any, read_source, value_labels_of, with_labels,
)
from surveyloom.specs import GROUPS, Encoding


def _fresh(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def table_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _fresh(spark, "table")
    rows = load(spark, sf, "orders").withColumnsRenamed({"o_orderstatus": "source_flag", "o_orderpriority": "kohort"})
    write_table(rows, path)
    return read_source(spark, path).withColumn("o_orderdate", F.unix_micros(F.col("o_orderdate").cast("timestamp")))


def one_source_again(spark: SparkSession, sf: str) -> DataFrame:
    """A table by cell of which one source is written again, changed; the others' folders stay."""
    path = _fresh(spark, "again")
    rows = load(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("source_flag"), F.col("o_orderpriority").alias("kohort"), "o_totalprice"
    )
    write_table(rows, path)
    changed = rows.where("source_flag = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_table(changed, path, keep_others=True)
    return read_source(spark, path)


def csv_report_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _fresh(spark, "report")
    write_report(load(spark, sf, "customer"), path)
    return read_source(spark, path, "csv", schema="c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


def csv_numbers_from_text(spark: SparkSession, sf: str) -> DataFrame:
    path = _fresh(spark, "untyped")
    write_report(load(spark, sf, "supplier"), path)
    return read_source(spark, path, "csv")


def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _fresh(spark, "json")
    load(spark, sf, "part").write.json(path)
    kinds = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return read_any(spark, path, "json", schema=kinds)


def orc_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _fresh(spark, "orc")
    load(spark, sf, "events").write.orc(path)
    return read_any(spark, path, "orc").withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))


def dictionary_long(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary file with code cells of three sources, read into long form."""
    path = _fresh(spark, "dictionary")
    wide = derive(load(spark, sf, "part"), DICTIONARY)
    wide = wide.withColumns({"s1": F.col("code_cell"), "s2": F.lit("—"), "s3": F.concat(F.lit("X"), "pos")})
    write_report(wide.select("pos", "standard_name", "category", "concept", "role", "s1", "s2", "s3"), path)
    return load_dictionary(spark, path, ["s1", "s2", "s3"], position="pos").drop("other_code")


def growth_files(spark: SparkSession, sf: str) -> DataFrame:
    """Growth reference files, JSON arrays of records of text, read into one table."""
    files = {}
    for indicator, sex, key in (("haz_l", 1, "Month"), ("whz_l", 2, "Length"), ("whz_h", 1, "Height")):
        files[indicator, sex] = path = _fresh(spark, "growth")
        record = F.struct(
            F.col("s_suppkey").cast("string").alias(key), F.format_string("%.2f", F.col("s_acctbal")).alias("L"),
            F.col("s_nationkey").cast("string").alias("M"), F.lit("0.5").alias("S"),
        )
        parts = load(spark, sf, "supplier").groupBy(F.expr("s_suppkey div 50")).agg(F.to_json(F.collect_list(record)).alias("value"))
        # a document to a file
        parts.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return load_lms(spark, files)


def encoding_file(spark: SparkSession, sf: str) -> DataFrame:
    """An encoding schema written as JSON and read back: group and column."""
    path = _fresh(spark, "encoding")
    found = load(spark, sf, "part").select("p_brand", "p_type").distinct().collect()
    groups = {"biner": sorted({r["p_brand"] for r in found}), "nominal": sorted({r["p_type"] for r in found})}
    write_encoding(spark, Encoding(groups), path)
    back = load_encoding(spark, path)
    rows = [(g, c) for g in GROUPS for c in back[g]]
    return spark.createDataFrame(rows, "grp string, variable string")


def value_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Value labels as column metadata, kept by Parquet, as a table."""
    path = _fresh(spark, "labelled")
    orders = load(spark, sf, "orders")
    names = {c: sorted(r[c] for r in orders.select(c).distinct().collect()) for c in ("o_orderstatus", "o_orderpriority")}
    labels = {c: {float(i): v for i, v in enumerate(values)} for c, values in names.items()}
    with_labels(orders, {"o_orderstatus": "Status"}, labels).write.parquet(path)
    return value_labels_of(spark.read.parquet(path), "orders")


def last_stage(spark: SparkSession, sf: str) -> DataFrame:
    """The last stage: table, report, gaps and encoding are written; the report and gaps read back."""
    path = _fresh(spark, "finished")
    rows = load(spark, sf, "orders").withColumnsRenamed({"o_orderstatus": "source_flag"})
    rows = rows.withColumn("kohort", F.expr("IF(o_custkey % 3 = 0, 'baduta', 'balita_tua')"))
    rows = rows.withColumn("stunting_binary", F.expr("CAST(o_custkey % 2 AS DOUBLE)"))
    rows = rows.withColumn("only_young", F.expr("IF(kohort = 'baduta', o_totalprice, NULL)"))
    found = finish(rows, path, PROFILE)
    assert read_source(spark, f"{path}/table").columns
    report = read_source(spark, f"{path}/report", "csv", schema="metric string, key string, value double")
    gaps = read_any(spark, f"{path}/gaps", "csv")
    gap = gaps.select(F.lit("gap").alias("metric"), F.col("variable").alias("key"), F.col("gap").cast("double").alias("value"))
    rows_back = read_source(spark, found).agg(
        F.lit("rows").alias("metric"), F.lit(None).cast("string").alias("key"), F.count("*").cast("double").alias("value")
    )
    return report.unionByName(gap).unionByName(rows_back)


QUERIES = {
    f.__name__: f
    for f in (
        table_round_trip, one_source_again, csv_report_round_trip, csv_numbers_from_text, json_round_trip, orc_round_trip,
        dictionary_long, growth_files, encoding_file, value_labels, last_stage,
    )
}

SQL = {
    "table_round_trip": """SELECT o_orderkey, o_custkey, o_orderstatus AS source_flag, o_orderpriority AS kohort,
 o_totalprice, epoch_us(o_orderdate) AS o_orderdate FROM orders""",
    "one_source_again": """SELECT o_orderkey, o_orderstatus AS source_flag, o_orderpriority AS kohort,
 CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
    "csv_report_round_trip": "SELECT * FROM customer",
    "csv_numbers_from_text": """SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey, s_name,
 CAST(s_nationkey AS DOUBLE) AS s_nationkey, s_acctbal FROM supplier""",
    "json_round_trip": "SELECT * FROM part",
    "orc_round_trip": "SELECT * REPLACE (epoch_us(ts) AS ts) FROM events",
    "dictionary_long": f"""WITH d AS ({DICTIONARY_SQL}),
 c AS (SELECT pos, standard_name, category, concept, role,
   code_cell, pos AS k FROM d)
 SELECT pos, standard_name, category, concept, role, 's1' AS source, trim(code_cell) AS code_cell FROM c
 UNION ALL SELECT pos, standard_name, category, concept, role, 's2', '—' FROM c
 UNION ALL SELECT pos, standard_name, category, concept, role, 's3', 'X' || k FROM c""",
    "growth_files": """WITH s AS (SELECT CAST(s_suppkey AS DOUBLE) AS x, round(s_acctbal, 2) AS l, CAST(s_nationkey AS DOUBLE) AS m, 0.5e0 AS s FROM supplier)
 SELECT i.indicator, CAST(i.sex AS INT) AS sex, s.* FROM s, (VALUES ('haz_l', 1), ('whz_l', 2), ('whz_h', 1)) AS i(indicator, sex)""",
    "encoding_file": """SELECT DISTINCT 'biner' AS grp, p_brand AS variable FROM part UNION ALL SELECT DISTINCT 'nominal', p_type FROM part""",
    "value_labels": " UNION ALL ".join(
        f"SELECT 'orders' AS source, '{c}' AS code, CAST(row_number() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS value, {c} AS text FROM (SELECT DISTINCT {c} FROM orders)"
        for c in ("o_orderstatus", "o_orderpriority")
    ),
    "last_stage": """WITH o AS (SELECT o_orderstatus AS s, CASE WHEN o_custkey % 3 = 0 THEN 'baduta' ELSE 'balita_tua' END AS k,
   o_custkey % 2 AS y FROM orders)
 SELECT 'total_baris' AS metric, NULL AS key, CAST(count(*) AS DOUBLE) AS value FROM o
 UNION ALL SELECT 'total_kolom', NULL, 9e0
 UNION ALL SELECT 'baris_per_sumber', s, count(*) FROM o GROUP BY s
 UNION ALL SELECT 'baris_per_kohort', k, count(*) FROM o GROUP BY k
 UNION ALL SELECT 'prevalensi_per_kohort', k, round_even(avg(y), 4) FROM o GROUP BY k
 UNION ALL SELECT 'gap', 'only_young', 1e0
 UNION ALL SELECT 'rows', NULL, count(*) FROM o""",
}
