"""Exact top-k inner products, a block of documents at a time.

Vectors in ranges of their id make a shard; within it like vectors are put next to one another and
cut into blocks. A block keeps the largest and smallest value of every term (component) and its vectors as a
forward index. A query bounds what any vector of a block can score by the sum of its terms' best products,
takes the blocks in order of the bound and stops when the bound is below the kth score so far.
A first pass over the shard of the highest bound gives every query a score to beat in all others. Shards keep the
largest and smallest value of every term as well; a chunk of queries is sent only to shards whose bound is not below the
score to beat of all its queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.store import Scratch


@dataclass(frozen=True)
class TopRule:
    """Scores per query, vectors of a shard and a block, queries that go together."""

    k: int = 20
    shard: int = 8192
    block: int = 128
    chunk: int = 1024
    #: shards whose extremes are looked at together
    group: int = 256


#: No score: lower than any, and safe to negate.
FLOOR = -(1 << 62)


def _dense(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _neighbours(matrix: np.ndarray, groups: int) -> np.ndarray:
    """An order that puts like vectors together: by the nearest of some of the vectors, then of their means."""
    if len(matrix) <= 1 or groups <= 1:
        return np.arange(len(matrix))
    real = matrix.astype(np.float64)
    centres = real[np.linspace(0, len(real) - 1, groups).astype(int)]
    for _ in range(3):
        near = np.argmax(real @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)
        for g in np.unique(near):
            centres[g] = real[near == g].mean(axis=0)
    return np.argsort(near, kind="stable")


PACKED = "no long, ids binary, width int, vectors binary, high binary, low binary"


def _pack(size: int, block: int):
    """Rows of up to ``size`` vectors; with a block size in an order of likeness."""

    def flush(rows) -> pa.RecordBatch:
        ids, matrix = np.array([r[0] for r in rows], np.int64), _dense([r[1] for r in rows])
        if block:
            order = _neighbours(matrix, -(-len(ids) // block))
            ids, matrix = ids[order], matrix[order]
        extremes = [[matrix.max(axis=0).tobytes()], [matrix.min(axis=0).tobytes()]]
        values = [[int(ids.min())], [ids.tobytes()], [matrix.shape[1]], [matrix.tobytes()], *extremes]
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        names = ["no", "ids", "width", "vectors", "high", "low"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows.append(row)
                if len(rows) == size:
                    yield flush(rows)
                    rows = []
        if rows:
            yield flush(rows)

    return run


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where that is exact."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if width * float(np.abs(a).max()) * float(np.abs(b).max()) < 2.0**52:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def search(queries, ids, beat, vectors, docs, rule: TopRule) -> tuple[np.ndarray, np.ndarray]:
    """Best ``k`` scores and documents of each query in a shard, ``FLOOR`` where there are fewer."""
    n, k = len(ids), rule.k
    cuts = np.arange(0, len(docs), rule.block)
    high, low = np.maximum.reduceat(vectors, cuts), np.minimum.reduceat(vectors, cuts)
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    bound = _products(positive, high) + _products(negative, low)
    order = np.argsort(-bound, axis=1, kind="stable")
    best = np.full((n, k), FLOOR)
    who = np.full((n, k), np.iinfo(np.int64).max)
    active = np.arange(n)
    for step in range(len(cuts)):
        block = order[active, step]
        least = np.maximum(best[active, -1], beat[active])
        go = bound[active, block] >= least
        active, block, least = active[go], block[go], least[go]
        if not len(active):
            break
        for b in np.unique(block):
            rows, floor = active[block == b], least[block == b]
            part = slice(cuts[b], cuts[b] + rule.block)
            own = docs[part]
            scores = _products(queries[rows], vectors[part])
            scores[own[None, :] == ids[rows][:, None]] = FLOOR
            hit = (scores >= floor[:, None]) & (scores > FLOOR)
            some = np.flatnonzero(hit.any(axis=1))
            if not len(some):
                continue
            rows = rows[some]
            merged = np.concatenate([best[rows], np.where(hit[some], scores[some], FLOOR)], axis=1)
            names = np.concatenate([who[rows], np.broadcast_to(own, (len(rows), len(own)))], axis=1)
            pick = np.lexsort((names, -merged), axis=1)[:, :k]
            best[rows] = np.take_along_axis(merged, pick, axis=1)
            who[rows] = np.take_along_axis(names, pick, axis=1)
    return best, who


def _matrix(ids: bytes, width: int, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    docs = np.frombuffer(ids, np.int64)
    return docs, np.frombuffer(vectors, np.int64).reshape(len(docs), width)


MEETS = "no long, shard int, bound double"


def _meets(first: bool):
    """Shards of a group that a chunk of queries has to see; or only the one of the highest bounds, for the first pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                _, queries = _matrix(r["ids"], r["width"], r["vectors"])
                limits = r["limits"]
                high, low = (_dense([np.frombuffer(x[c], np.int64) for x in limits]) for c in ("high", "low"))
                bound = _products(np.maximum(queries, 0), high) + _products(np.minimum(queries, 0), low)
                total = bound.astype(float).sum(axis=0)
                if first:
                    take = np.array([int(np.argmax(total))])
                else:
                    take = np.flatnonzero((bound >= np.frombuffer(r["beat"], np.int64)[:, None]).any(axis=0))
                shard = np.array([x["shard"] for x in limits], np.int32)[take]
                columns = [pa.array(np.full(len(take), r["no"])), pa.array(shard), pa.array(total[take])]
                yield pa.RecordBatch.from_arrays(columns, ["no", "shard", "bound"])

    return run


def meetings(chunks: DataFrame, limits: DataFrame, groups: int, first: bool) -> DataFrame:
    """``no, shard, bound``: the shards that chunks of queries meet. Vectors go to each group of shards' extremes, not to shards."""
    spread = chunks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return spread.join(limits, "group").mapInArrow(_meets(first), MEETS)


FOUND = "query_id long, vec_id long, score long"


def _search(rule: TopRule, floor: bool):
    """Hits of chunks of queries in shards; or only each query's kth score, for the first pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, queries = _matrix(r["ids"], r["width"], r["vectors"])
                docs, vectors = _matrix(r["doc_ids"], r["doc_width"], r["doc_vectors"])
                beat = np.frombuffer(r["beat"], np.int64) if r["beat"] else np.full(len(ids), FLOOR)
                best, who = search(queries, ids, beat, vectors, docs, rule)
                if floor:
                    columns = [pa.array([r["no"]]), pa.array([best[:, -1].tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["no", "beat"])
                else:
                    good = best > FLOOR
                    query = np.broadcast_to(ids[:, None], best.shape)[good]
                    columns = [pa.array(query), pa.array(who[good]), pa.array(best[good])]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return run


def top_scores(vectors: DataFrame, queries: DataFrame, rule: TopRule = TopRule()) -> DataFrame:
    """The ``k`` highest integer inner products of every query: ``query_id, rank, vec_id, score``.

    Both frames have ``vec_id`` (integer) and ``vector`` (array of long). A vector is no candidate of a query of
    the same id; ties go to the smaller id; a query with fewer candidates has fewer rows.

    Defined cases: rows without id or vector, or with a null in it, take no part; of vectors that
    repeat an id the smallest stays; a shorter vector has zeros behind it. Empty tables give an empty one.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "top")
    whole = "vec_id is not null and vector is not null and forall(vector, x -> x is not null)"

    def packed(rows: DataFrame, size: int, block: int, name: str) -> DataFrame:
        rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "vector").where(whole)
        rows = scratch.keep(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), f"{name}-rows")
        parts = max(1, -(-rows.count() // size))
        rows = rows.repartitionByRange(parts, "vec_id").sortWithinPartitions("vec_id")
        return scratch.keep(rows.mapInArrow(_pack(size, block), PACKED), name)

    shards = packed(vectors, rule.shard, rule.block, "shards")
    chunks = packed(queries, rule.chunk, 0, "chunks").drop("high", "low")
    # a number for every shard
    numbers = shards.select("no").withColumn("one", F.lit(1))
    numbers = numbers.withColumn("shard", F.row_number().over(Window.partitionBy("one").orderBy("no")) - 1).drop("one")
    forward = shards.join(scratch.keep(numbers, "numbers"), "no").select(
        "shard", F.col("ids").alias("doc_ids"), F.col("width").alias("doc_width"), F.col("vectors").alias("doc_vectors"), "high", "low"
    )
    forward, count = scratch.keep(forward, "forward"), shards.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    limit = F.collect_list(F.struct("shard", "high", "low")).alias("limits")
    limits = forward.groupBy(F.floor(F.col("shard") / rule.group).cast("int").alias("group")).agg(limit)
    limits, groups = scratch.keep(limits, "limits"), -(-count // rule.group)
    forward = forward.drop("high", "low")
    mine = meetings(chunks, limits, groups, True).groupBy("no").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))
    first = chunks.withColumn("beat", F.lit(None).cast("binary")).join(scratch.keep(mine, "mine"), "no").join(forward, "shard")
    beat = scratch.keep(first.drop("shard").mapInArrow(_search(rule, True), "no long, beat binary"), "beat")
    eager = scratch.keep(chunks.join(beat, "no"), "eager")
    met = scratch.keep(meetings(eager, limits, groups, False), "meetings")
    pairs = met.drop("bound").join(eager, "no").join(forward, "shard")
    found = pairs.drop("shard").mapInArrow(_search(rule, False), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= rule.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def quantised(embeddings: DataFrame) -> DataFrame:
    """``floor(64 * x)`` of every component; vectors with a component that is not finite become null."""
    finite = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    return embeddings.select(
        "vec_id",
        F.when(F.expr(finite), F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("long"))).alias("vector"),
    )
