"""Mixing sources to target weights by pivotal rounding of copies.

Every document of a source is owed the same number of copies: the source's target over its size. The whole
part is given; the fraction is a probability, and a source's fractions are rounded together: two
documents at a time pass words from one to the other, by a weighted coin that keeps
both expectations, until one of them has no fraction left. The words of the pair stay the same.
Documents are paired within buckets of a source, what is left of the buckets is paired in the next
level of a tree, and the last fraction of a source falls by its own coin. A source's words are
then off its target by less than one document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.store import Scratch
from surveyloom.llm.words import U64, mix

#: Documents of a bucket on average, and what is left of buckets that meets in the next level.
BUCKET = 2048
#: Rows that are alike and numbered by one task.
ALIKE = 1 << 16


@dataclass(frozen=True)
class MixRule:
    """``weights`` repeat over the sources by code point, null last; no source grows beyond ``most`` times."""

    weights: tuple[float, ...] = (1.0, 2.0, 3.0)
    most: float = 3.0
    share: float = 1.0
    seed: int = 0


def targets(sizes: dict, rule: MixRule) -> dict:
    """Words of each source: by weight, no more than ``most`` times its size, the excess reshared.

    That is the smaller of the limit and a common level times the weight; sources at their limit
    are those with the smallest limit per weight.
    """
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    weight = {s: rule.weights[i % len(rule.weights)] for i, s in enumerate(names)}
    limit = {s: rule.most * sizes[s] for s in names}
    left, weights, out = rule.share * sum(sizes.values()), sum(weight.values()), {}
    for s in sorted(names, key=lambda s: (limit[s] / weight[s], weight[s])):
        out[s] = float(min(limit[s], left * weight[s] / weights))
        left, weights = left - out[s], weights - weight[s]
    return out


def pivot(chance: np.ndarray, size: np.ndarray, coins: np.ndarray) -> np.ndarray:
    """Round fractions so that the sum of ``chance * size`` stays; at most one fraction is left."""
    out, held = chance.copy(), -1
    for i in range(len(out)):
        if not 0 < out[i] < 1:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        up = min((1 - out[a]) * size[a], out[b] * size[b])
        down = min(out[a] * size[a], (1 - out[b]) * size[b])
        move = up if coins[i] * (up + down) < down else -down
        p, q = out[a] + move / size[a], out[b] - move / size[b]
        # one of the two has reached a bound; it is set to it, whatever the last digit says
        ends = [abs(p), abs(1 - p), abs(q), abs(1 - q)]
        at = int(np.argmin(ends))
        out[a], out[b] = ((0.0, 1.0)[at] if at < 2 else p), ((0.0, 1.0)[at - 2] if at >= 2 else q)
        held = b if at < 2 else a
        if not 0 < out[held] < 1:
            out[held], held = round(out[held]), -1
    return out


ROW = "source_no int, bucket long, doc_id long, text_key long, ordinal long, size long, chance double"


def _key(rows: pd.DataFrame) -> np.ndarray:
    """What a row's coins hang on: id, text, and its number among rows alike."""
    doc, text, ordinal = (rows[c].fillna(-1).to_numpy(np.int64).view(U64) for c in ("doc_id", "text_key", "ordinal"))
    return doc ^ text ^ mix(ordinal)


def _level(seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        key = _key(rows)
        order = np.lexsort((rows["ordinal"], rows["size"], rows["text_key"], rows["doc_id"].fillna(-1), mix(key ^ U64(seed))))
        rows = rows.iloc[order].reset_index(drop=True)
        coins = (mix(key[order] ^ mix(np.full(len(order), seed + 1, dtype=U64))) >> U64(11)) / 2.0**53
        chance, size = rows["chance"].to_numpy(float), rows["size"].to_numpy(float)
        # a document without words changes no sum: its own coin decides
        out = np.where(size > 0, chance, coins < chance)
        out[size > 0] = pivot(chance[size > 0], size[size > 0], coins[size > 0])
        rows["chance"] = out
        return rows

    return run


def _last(seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        key = _key(rows)
        coins = (mix(key ^ mix(np.full(len(rows), seed + 2, dtype=U64))) >> U64(11)) / 2.0**53
        rows["chance"] = (coins < rows["chance"].to_numpy(float)).astype(float)
        return rows

    return run


def _numbered(sized: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with their number among rows alike, however they are split: rows alike are counted and dealt out again."""
    alike = scratch.keep(sized.groupBy(*sized.columns).agg(F.count("*").alias("alike")), "alike")
    number = F.sequence(F.lit(0).cast("long"), F.col("alike") - 1)
    few = alike.where(F.col("alike") <= ALIKE).withColumn("ordinal", F.explode(number)).drop("alike")
    # many rows alike are numbered in several tasks
    last = F.floor((F.col("alike") - 1) / ALIKE)
    blocks = alike.where(F.col("alike") > ALIKE).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    blocks = blocks.repartition(*[c for c in blocks.columns if c != "alike"])
    ends = F.least(F.col("alike"), (F.col("block") + 1) * ALIKE) - 1
    many = blocks.withColumn("ordinal", F.explode(F.sequence(F.col("block") * ALIKE, ends))).drop("alike", "block")
    return few.unionByName(many)


def mix_sources(docs: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """Copies of every document: ``doc_id, text_key, source, size, source_size, target, copies, taken``.

    ``docs`` needs ``doc_id`` (integer), ``text`` and ``source``; other columns are left out. A row per input
    row. Size is the number of words ``[^\\x20\\x09-\\x0D]+``; ``taken`` is ``copies * size``. Coins are
    hashes of id, text and the number among rows alike, so reruns agree however the rows are split, and rows alike
    are dealt to all buckets of their source.

    Defined cases: null and empty texts have size 0 and take nothing; a null source is a source,
    the last one; a source without words has target 0 and no copies; rows that repeat id and text are
    documents of their own; a null ``doc_id`` is mixed like any other. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"), F.lit(0)).alias("size"),
    )
    sized = scratch.keep(_numbered(sized, scratch), "sized")
    # a row per source
    found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).collect()
    sizes = {r["source"]: r["size"] for r in found}
    aims = targets(sizes, rule)
    buckets = {r["source"]: max(1, -(-r["docs"] // BUCKET)) for r in found}
    per_source = [
        (i, s, sizes[s], aims[s], min(rule.most, aims[s] / sizes[s]) if sizes[s] else 0.0, buckets[s])
        for i, s in enumerate(sizes)
    ]
    kind = "source_no int, source string, source_size long, target double, owed double, buckets long"
    sources = scratch.keep(spark.createDataFrame(per_source, kind), "sources")
    own = F.pmod(F.xxhash64("doc_id", "text_key", F.lit(rule.seed)).bitwiseXOR(F.col("ordinal")), F.col("buckets"))
    rows = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "source_no", own.alias("bucket"), "doc_id", "text_key", "ordinal", "size", (F.col("owed") - F.floor("owed")).alias("chance")
    )
    done, most, level = [], max(buckets.values(), default=1), 0
    open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
    while True:
        level += 1
        rows = scratch.keep(
            rows.groupBy("source_no", "bucket").applyInPandas(_level(rule.seed + 10 * level), ROW), f"level-{level}"
        )
        done.append(rows.where(~open_))
        rows = rows.where(open_)
        if most == 1:
            break
        most = -(-most // BUCKET)
        rows = rows.withColumn("bucket", F.floor(F.col("bucket") / BUCKET))
    # one fraction of a source at most is left
    done.append(rows.groupBy("source_no").applyInPandas(_last(rule.seed), ROW))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.floor("owed") + F.col("chance")).cast("long")
    out = out.join(sources.drop("buckets"), "source_no").withColumn("copies", copies)
    return out.select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
