"""Session defaults, the shared checkpoint folder and the tables written there."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the wide harmonised table (more than 130 columns) profits from.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # larger batches for numpy, bounded in bytes: each core holds a batch in the JVM and in Python
    "spark.sql.execution.arrow.maxRecordsPerBatch": "50000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # whole-stage codegen is off above this many columns; the default is 100
    "spark.sql.codegen.maxFields": "400",
    # The JVM does not compile methods above 8000 bytes, and wide projections generate such
    # methods. Past this limit Spark evaluates the same operators through split functions,
    # which are compiled: eight to ten times faster on a projection of 23 columns.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Settings to start a session with.
STATIC = {
    # call sites in expressions cost more than building a wide plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # one run of all stages generates more classes than the default cache of 100 keeps
    "spark.sql.codegen.cache.maxEntries": "2000",
}

_local_checkpoints: dict[str, str] = {}
_folders: dict[str, set[str]] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime defaults on an existing session."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage: what ``spark.checkpoint.dir`` names.

    Only a local master may fall back to a folder on this machine. On a cluster such
    a folder would be lost with its executor, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_checkpoints:
        _local_checkpoints[app] = tempfile.mkdtemp(prefix="run-")
    return _local_checkpoints[app]


def materialise(df: DataFrame, name: str, by: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder, a folder for each value of ``by``, and read it back.

    Unlike ``checkpoint()`` the written table keeps column pruning, so later passes
    read only the columns they use, and a lost executor costs a re-read, not a re-run. ``options`` are the writer's.
    """
    path = os.path.join(checkpoint_root(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path, partitionBy=by)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    note_folder(df.sparkSession, path)
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a table that ``materialise`` wrote, once nothing reads it any more."""
    delete_folder(df.sparkSession, df.written_to)


def note_folder(spark: SparkSession, path: str) -> None:
    """Remember an intermediate folder for ``release``."""
    _folders.setdefault(spark.sparkContext.applicationId, set()).add(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _folders.get(spark.sparkContext.applicationId, set()).discard(path)


def release(spark: SparkSession) -> None:
    """Remove all intermediate folders this application has written and not removed.

    To be called when results are written: frames that operators returned may still read them.
    """
    for path in sorted(_folders.get(spark.sparkContext.applicationId, ())):
        delete_folder(spark, path)


def join_small(left: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a table expected to be small. It is written first, so that Spark knows its bytes: below its threshold
    it is broadcast, above it both sides are shuffled and hot keys left to AQE."""
    return left.join(materialise(small, "pinned"), on, how)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for per-row heavy work when a scan has fewer splits than cores.

    On a large input the scan already has more splits than cores, so nothing moves. Only for
    plain scans: counting the partitions of a plan with a shuffle would run the shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
