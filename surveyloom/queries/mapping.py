"""Dictionary cells, column matching, renames and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import mapping as ops
from surveyloom.queries.base import CATALOGUE_SQL, DICTIONARY_SQL, catalogue, dictionary, load
from surveyloom.sources.tables import catalogue_of

#: A dictionary of one source, for the table orders.
ORDERS_DICTIONARY = [
    ("order_id", "O_ORDERKEY (key)"),
    ("customer", "o_custkey*"),
    ("order_status", "o_orderstatus/x"),
    ("price", "DERIVASI a+b"),
    ("order_date", "—"),
    ("priority", "O_OrderPriority"),
    ("priority_again", "o_orderpriority"),
]


def clean_column_names(spark: SparkSession, sf: str) -> DataFrame:
    dirty = load(spark, sf, "supplier").withColumnsRenamed(
        {"s_name": " s_name​ ", "s_acctbal": "s_acctbal é"}
    )
    return ops.clean_names(dirty)


def clean_code_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = dictionary(spark, sf)
    return rows.select("source", "pos", ops.clean_cell(F.col("code_cell")).alias("code"))


def parse_code_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = dictionary(spark, sf)
    cell = ops.parse_cell(F.col("code_cell"))
    return rows.select(
        "source", "pos", cell["status"].alias("status"), cell["main_code"].alias("main_code"),
        F.array_join(cell["components"], "|").alias("components"), cell["needs_check"].alias("needs_check"),
    )


def match_columns(spark: SparkSession, sf: str) -> DataFrame:
    matched = ops.match_mapping(dictionary(spark, sf), catalogue(spark, sf))
    return matched.select("source", "pos", "standard_name", "code")


def match_columns_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = dictionary(spark, sf)
    wanted = rows.withColumn("main_code", ops.parse_cell(F.col("code_cell"))["main_code"])
    return ops.match_audit(wanted.select("source", "pos", "main_code"), catalogue(spark, sf), "main_code")


def rename_claims(spark: SparkSession, sf: str) -> DataFrame:
    return ops.rename_map(dictionary(spark, sf), catalogue(spark, sf))


def rename_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    rows = [(i, n, "orders", c) for i, (n, c) in enumerate(ORDERS_DICTIONARY, 1)]
    spec = spark.createDataFrame(rows, "pos int, standard_name string, source string, code_cell string")
    outcome = ops.rename_map(spec, catalogue_of(orders, "orders"))
    renamed = ops.apply_rename(orders, ops.rename_pairs(outcome)["orders"])
    return ops.allow_list(renamed, [n for n, _ in ORDERS_DICTIONARY])


def drop_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    customer = load(spark, sf, "customer")
    rows = [(1, "name", "c", "c_name", "HAPUS_PRIVASI"), (2, "address", "c", "—", "HAPUS_PRIVASI"),
            (3, "balance", "c", "c_acctbal", "FITUR")]
    spec = spark.createDataFrame(rows, "pos int, standard_name string, source string, code_cell string, role string")
    return ops.drop_columns(customer, ops.pii_codes(spec, "HAPUS_PRIVASI")["c"])


def allow_listed(spark: SparkSession, sf: str) -> DataFrame:
    return ops.allow_list(load(spark, sf, "lineitem"), ["l_orderkey", "l_quantity", "not_there"])


def drop_listed(spark: SparkSession, sf: str) -> DataFrame:
    return ops.drop_columns(load(spark, sf, "part"), ["p_name", "p_brand", "not_there"])


def dictionary_names(spark: SparkSession, sf: str) -> DataFrame:
    return ops.dictionary_rows(dictionary(spark, sf), prefix="asset_", role="FITUR", category="ECONOMY")


def near_names(spark: SparkSession, sf: str) -> DataFrame:
    return ops.near_names(catalogue(spark, sf), {"P10C": ["p1", "ayah"], "ID": ["id"], "zzz": ["kk"]})


QUERIES = {
    f.__name__: f
    for f in (
        clean_column_names, clean_code_cells, parse_code_cells, match_columns, match_columns_audit, rename_claims,
        rename_orders, drop_personal_data, allow_listed, drop_listed, dictionary_names, near_names,
    )
}

_INVISIBLE = r"[\x{200b}\x{200c}\x{200d}\x{200e}\x{200f}\x{feff}\x{00a0}]"
_CODE = rf"trim(regexp_replace(replace(trim(regexp_replace(code_cell, '{_INVISIBLE}', '', 'g')), '*', ''), '\s*[(/].*$', ''))"
_CLEAN = "replace(trim(code_cell), '*', '')"
_MAIN = rf"trim(regexp_replace({_CLEAN}, '\s*[(/].*$', ''))"
_STATUS = f"CASE WHEN {_CLEAN} IN ('—', '') THEN 'tidak_tersedia' WHEN upper({_CLEAN}) LIKE 'DERIVASI%' THEN 'derivasi' ELSE 'tersedia' END"
_MATCH = f"""d AS (SELECT *, {_CODE} AS cell, lower({_CODE}) AS norm FROM ({DICTIONARY_SQL})),
 c AS ({CATALOGUE_SQL}),
 same AS (SELECT source, lower(trim(code)) AS norm, arg_max(code, pos) AS same_code FROM c GROUP BY 1, 2),
 offer AS (SELECT d.source, d.pos, c.code, c.pos AS place, substr(lower(c.code), length(d.norm) + 2) AS suffix
   FROM d JOIN c ON c.source = d.source AND starts_with(lower(c.code), d.norm || '_') AND length(c.code) > length(d.norm) + 1),
 person AS (SELECT pos, CASE WHEN contains(standard_name, 'mother') THEN 'ibu' WHEN contains(standard_name, 'father') THEN 'ayah'
   ELSE 'anak' END AS subject FROM d),
 picked AS (SELECT offer.source, offer.pos, CASE WHEN count(*) = 1 THEN min(code)
   ELSE arg_min(code, place) FILTER (WHERE suffix = subject) END AS code
   FROM offer JOIN person ON person.pos = offer.pos GROUP BY 1, 2),
 matched AS (SELECT d.*, CASE WHEN d.norm <> '' THEN coalesce(same_code, picked.code) END AS code FROM d
   LEFT JOIN same ON same.source = d.source AND same.norm = d.norm
   LEFT JOIN picked ON picked.source = d.source AND picked.pos = d.pos)"""
_SQUEEZE = r"regexp_replace(lower({}), '[_\s]', '', 'g')"

SQL = {
    "clean_column_names": "SELECT * FROM supplier",
    "clean_code_cells": f"SELECT source, pos, {_CODE} AS code FROM ({DICTIONARY_SQL})",
    "parse_code_cells": rf"""SELECT source, pos, {_STATUS} AS status,
 CASE WHEN {_STATUS} = 'tersedia' THEN {_MAIN} END AS main_code,
 CASE {_STATUS} WHEN 'tidak_tersedia' THEN ''
  WHEN 'derivasi' THEN array_to_string(list_filter(regexp_split_to_array(trim(substr({_CLEAN}, 9)), '[+\s]+'),
    lambda k: regexp_matches(k, '[A-Za-z].*\d|\d.*[A-Za-z]|[a-z]{{3,}}')), '|')
  ELSE array_to_string(regexp_extract_all({_MAIN}, '[A-Za-z][A-Za-z0-9_]+'), '|') END AS components,
 {_STATUS} <> 'tidak_tersedia' AND contains(code_cell, '*') AS needs_check
 FROM ({DICTIONARY_SQL})""",
    "match_columns": f"WITH {_MATCH} SELECT source, pos, standard_name, code FROM matched",
    "match_columns_audit": f"""WITH d AS (SELECT source, pos, CASE WHEN {_STATUS} = 'tersedia' THEN {_MAIN} END AS main_code
   FROM ({DICTIONARY_SQL})), c AS ({CATALOGUE_SQL}),
 e AS (SELECT source, code AS k, arg_max(code, pos) AS code FROM c GROUP BY 1, 2),
 l AS (SELECT source, lower(code) AS k, arg_max(code, pos) AS code FROM c GROUP BY 1, 2),
 b AS (SELECT source, {_SQUEEZE.format('code')} AS k, arg_max(code, pos) AS code FROM c GROUP BY 1, 2)
 SELECT d.source, d.pos, d.main_code, coalesce(e.code, l.code, b.code) AS found FROM d
 LEFT JOIN e ON e.source = d.source AND e.k = main_code
 LEFT JOIN l ON l.source = d.source AND l.k = lower(main_code)
 LEFT JOIN b ON b.source = d.source AND b.k = {_SQUEEZE.format('main_code')}""",
    "rename_claims": f"""WITH {_MATCH},
 m AS (SELECT source, pos, standard_name, code_cell, trim(code_cell) AS cell2,
   trim(code_cell) IN ('—', '', 'nan') OR upper(trim(code_cell)) LIKE 'DERIVASI%' AS skipped, code AS raw FROM matched),
 n AS (SELECT *, CASE WHEN NOT skipped THEN raw END AS code FROM m),
 o AS (SELECT *, CASE WHEN code IS NOT NULL THEN first_value(standard_name) OVER (PARTITION BY source, code ORDER BY pos) END
   AS owner FROM n),
 s AS (SELECT *, CASE WHEN skipped THEN 'skipped' WHEN code IS NULL THEN 'unmatched'
   WHEN owner <> standard_name THEN 'claimed' ELSE 'mapped' END AS status FROM o)
 SELECT source, pos, standard_name, code_cell, code, status,
  CASE status WHEN 'unmatched' THEN cell2 WHEN 'claimed' THEN cell2 || '->' || code || ' bentrok ' || owner END AS reason
 FROM s""",
    "rename_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer, o_orderstatus AS order_status,
 o_orderpriority AS priority FROM orders""",
    "drop_personal_data": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "allow_listed": "SELECT l_orderkey, l_quantity FROM lineitem",
    "drop_listed": "SELECT p_partkey, p_type, p_size, p_retailprice FROM part",
    "dictionary_names": f"""SELECT standard_name, min(pos) AS pos FROM ({DICTIONARY_SQL})
 WHERE starts_with(standard_name, 'asset_') AND role = 'FITUR' AND category = 'ECONOMY' GROUP BY 1""",
    "near_names": f"""WITH c AS ({CATALOGUE_SQL}),
 w(required) AS (VALUES ('P10C'), ('ID'), ('zzz')),
 lacks AS (SELECT s.source, w.required FROM (SELECT DISTINCT source FROM c) s JOIN w ON true
   WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source = s.source AND c.code = w.required)),
 offers AS (SELECT c.source, l.required, c.pos, c.code FROM c JOIN lacks l ON l.source = c.source
   WHERE CASE l.required WHEN 'P10C' THEN contains(lower(c.code), 'p1') OR contains(lower(c.code), 'ayah')
     WHEN 'ID' THEN contains(lower(c.code), 'id') ELSE contains(lower(c.code), 'kk') END)
 SELECT source, required, CAST(row_number() OVER (PARTITION BY source, required ORDER BY pos) AS INT) AS rank, code
 FROM offers QUALIFY row_number() OVER (PARTITION BY source, required ORDER BY pos) <= 10""",
}
