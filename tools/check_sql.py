"""Run queries beside their SQL in DuckDB and compare rows: check_sql.py <sf_dir> [name...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canon(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        if value != value:
            return (3, "nan")
        return (2, round(float(value), 9) + 0.0)
    return (4, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(canon(r[i]) for i in order) for r in rows], key=repr)


KINDS = {
    "tinyint": "TINYINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def compare(spark_df, con, sql: str) -> str:
    """Empty if equal, else what differs."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    expected = con.execute(sql).fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    sql_types = {d[0]: d[1] for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = {c: (types[c], sql_types[c]) for c in types if types[c] != sql_types[c]}
    if len(expected) != len(got):
        return f"rows: spark {len(got)} sql {len(expected)}"
    a, b = rows_of(spark_df.columns, got), rows_of(names, expected)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        cols = sorted(names)
        x, y = bad[0]
        diff = {c: (u[1], v[1]) for c, u, v in zip(cols, x, y) if u != v}
        return f"{len(bad)} rows differ, first: {diff}"
    if wrong:
        return f"types {wrong}"
    return ""


def session():
    from pyspark.sql import SparkSession

    from surveyloom.session import DEFAULTS, STATIC

    builder = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**DEFAULTS, **STATIC}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import importlib

    entry = importlib.import_module("__spark_entry__")
    sf, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in wanted or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            outcome = compare(df, con, sqls[name]) if name in sqls else f"(rows only) {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            outcome = "ERROR " + str(e).strip().split("\n")[0][:300]
            if wanted:
                traceback.print_exc()
        ok = outcome == "" or outcome.startswith("(rows only)")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {outcome}", flush=True)
    print(f"{failed} failed of {len(wanted or queries)}; without SQL: {sorted(set(queries) - set(sqls))}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
