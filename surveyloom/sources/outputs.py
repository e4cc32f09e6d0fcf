"""Writing the harmonised table, reports and schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from surveyloom.operators.contract import Contract
from surveyloom.specs import Encoding


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("source_flag", "kohort"),
    rows_per_file: int = 5_000_000,
    keep_others: bool = False,
) -> None:
    """Parquet, overwritten, one folder per cell so that later reads prune to it.

    With ``keep_others`` only the cells that ``df`` has rows of are replaced: a source that is run again leaves the
    folders of the others as they are.

    Rows are rebalanced by cell: AQE splits a large cell over tasks and puts small ones together, so there are
    few files of even size. The row cap only splits large files; every row is written.
    """
    there = [c for c in partition_by if c in df.columns]
    df = df.hint("rebalance", *there) if there else df.hint("rebalance")
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if keep_others:
        if not there:
            raise ValueError("a table without cells can only be replaced as a whole")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*there) if there else writer).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """CSV with header."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_encoding(spark: SparkSession, encoding: Encoding, path: str) -> None:
    """The encoding schema as one JSON document."""
    _write_document(spark, encoding.to_json(), path)


def write_contract(spark: SparkSession, contract: Contract, path: str) -> None:
    _write_document(spark, contract.to_json(), path)


def read_contract(spark: SparkSession, path: str) -> Contract:
    return Contract.from_json(spark.read.text(path, wholetext=True).first()["value"])


def _write_document(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
