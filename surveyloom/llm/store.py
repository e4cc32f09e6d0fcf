"""Tables an operator writes on the way, in the folder the cluster shares."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from surveyloom.session import checkpoint_root, delete_folder, note_folder


#: Rows and bytes of a batch that goes to Python: documents are long, and a task holds several copies of a batch.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to a size that suits documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Scratch:
    """Intermediate tables as Parquet under ``spark.checkpoint.dir``.

    A lost executor then costs a re-read, not a re-run, and later passes read only the
    columns they use. ``drop`` removes a table once what follows from it is written;
    tables the returned frame still reads stay until ``close``.
    """

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.root = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
        note_folder(spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_folder(self.spark, f"{self.root}/{name}")

    def close(self) -> None:
        delete_folder(self.spark, self.root)
