"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores of the local master.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "availability_matrix",
    "structural_gaps",
    "rename_claims",
    "null_codes",
    "encode_rows",
    "infer_types",
    "growth_indices",
    "row_sum",
    "wealth_index",
    "feature_eligibility",
    "snap_many_codes",
    "impute_linear",
    "imputation_trace",
    "convergence_verdicts",
    "stack_sources",
    "validation_report",
    "pii_scan",
    "audit_report",
    "contract_profile",
    "value_domains",
    "synthetic_table",
    "availability_of_sources",
    "harmonised_rows",
    "harmonised_imputed",
    "convergence_of_sources",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from surveyloom.queries import all_queries
    from surveyloom.session import DEFAULTS, STATIC

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("surveyloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**DEFAULTS, **STATIC}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    # start the JVM's compiler and the Python workers before the clock
    for name in ("stack_sources", "label_similarity"):
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
