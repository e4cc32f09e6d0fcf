"""A training corpus from documents, stage by stage.

Every stage reads what the one before it wrote. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.filters import either, filter_of
from surveyloom.llm.line_dedup import LineRule, drop_repeated_lines
from surveyloom.llm.mixing import mix_sources
from surveyloom.llm.near_dups import near_duplicates
from surveyloom.llm.packing import pack
from surveyloom.llm.store import Scratch
from surveyloom.llm.toxicity import ToxicRule, score, train


def _row(docs: DataFrame) -> F.Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.5 or more go."""
    rule = ToxicRule()
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), rule)
    return score(docs, machine, rule, _row(docs)).where("predicted = 0").select("carried.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go from the text; a document that keeps only blank lines goes."""
    cut = drop_repeated_lines(docs, LineRule(short=True), _row(docs))
    cut = cut.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"\S"))
    new = {"text": F.when(F.col("n_removed") == 0, F.col("carried.text")).otherwise(F.col("kept_text"))}
    if "n_chars" in docs.columns:
        size = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") == 0, F.col("carried.n_chars")).otherwise(size)
    return cut.select(*[new.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id, and one row of that.

    Rows without id have no group and stay.
    """
    scratch = Scratch(spark, "near-dedup")
    found = near_duplicates(docs).where("doc_id is not null")
    found = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    marked = scratch.keep(found.where("not kept or rows > 1").select("doc_id", "kept"), "marked")
    flags = filter_of(marked.select("doc_id"))
    # rows the filter passes by are not moved
    missing = F.lit(-(1 << 63))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), missing).alias("__id"), _row(docs).alias("__row"))
    alone = rows.mapInArrow(either(flags, False), rows.schema)
    hit = rows.mapInArrow(either(flags, True), rows.schema)
    hit = hit.join(marked.withColumnRenamed("doc_id", "__id"), "__id", "left")
    single = hit.where("kept is null").select("__id", "__row")
    again = hit.where("kept").groupBy("__id").agg(F.min("__row").alias("__row"))
    return alone.unionByName(single).unionByName(again).select("__row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, also not at all."""
    key = ["doc_id", "text_key", "source"]
    mixed = mix_sources(docs).groupBy(*key).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    chosen = Scratch(spark, "mix").keep(mixed.where("copies > 0"), "chosen")
    text_key = F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key.alias("text_key"), "source", _row(docs).alias("row")
    ).alias("d")
    chosen = chosen.alias("c")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key]
    found = keyed.join(chosen, same).select(*[f"d.{k}" for k in key], "row", "copies", "rows")
    # rows alike in id, text and source are one row with all their copies
    alike = found.where("rows > 1").groupBy(*key).agg(F.min("row").alias("row"), F.max("copies").alias("copies"))
    all_rows = found.where("rows = 1").select("row", "copies").unionByName(alike.select("row", "copies"))
    repeated = all_rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return repeated.select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("near-duplicates", near_dedup),
    ("mixing", mix),
    ("packing", pack_sequences),
]

#: Neither a fitted model nor similarity joins of whole texts can be put in SQL that ends in time.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
