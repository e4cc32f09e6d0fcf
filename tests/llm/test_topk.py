import math
import random

import numpy as np
from pyspark.sql import functions as F

from surveyloom.llm.topk import TopRule, quantised, top_scores


def brute(rows, queries, k):
    out = {}
    for q, a in queries:
        scored = [(-sum(x * y for x, y in zip(a, b)), d) for d, b in rows if d != q]
        out[q] = [(i + 1, d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return out


def grouped(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_like_all_products_with_many_ties(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randint(-3, 3) for _ in range(5)]) for i in range(700)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    queries = [r for r in rows if r[0] % 20 == 0]
    rule = TopRule(k=20, shard=150, block=16, chunk=9)
    got = grouped(top_scores(df, df.where("vec_id % 20 = 0"), rule).collect())
    assert got == brute(rows, queries, 20)


def test_large_values_stay_exact(spark):
    rows = [(i, [(1 << 29) + i * i, -(1 << 28) + i]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = grouped(top_scores(df, df.where("vec_id < 5"), TopRule(k=3, block=8)).collect())
    assert got == brute(rows, rows[:5], 3)


def test_quantised_and_odd_rows(spark):
    data = [
        (0, [0.5, -0.26], 1), (20, [1.0, 2.0], 1), (3, None, 1), (4, [float("nan"), 1.0], 1), (5, [None, 1.0], 1),
        (6, [math.inf, 0.0], 1), (7, [0.02, 0.0], 1), (None, [1.0, 1.0], 1), (40, [1.0, 2.0], 1), (40, [1.0, 2.0], 2),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    q = quantised(df)
    values = {(r.vec_id, tuple(r.vector)) for r in q.collect() if r.vector is not None}
    assert (0, (32, -17)) in values and (7, (1, 0)) in values and not any(v[0] in (3, 4, 5, 6) for v in values)
    got = grouped(top_scores(q, q.where(F.col("vec_id") % 20 == 0)).collect())
    rows = [(0, [32, -17]), (7, [1, 0]), (20, [64, 128]), (40, [64, 128])]
    assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert top_scores(q.limit(0), q.limit(0)).collect() == []
    assert top_scores(q, q.limit(0)).collect() == []


def test_blocks_are_skipped(monkeypatch):
    from surveyloom.llm import topk

    rng = np.random.default_rng(5)
    centres = rng.integers(-60, 60, (20, 16))
    vectors = np.repeat(centres, 64, axis=0) + rng.integers(-2, 3, (1280, 16))
    docs, seen = np.arange(1280), []
    real = topk._products
    monkeypatch.setattr(topk, "_products", lambda a, b: (seen.append(len(b)), real(a, b))[1])
    order = topk._neighbours(vectors, 20)
    rule = TopRule(k=10, block=64)
    beat = np.full(8, topk.FLOOR)
    best, _ = topk.search(vectors[:8], docs[:8], beat, vectors[order], docs[order], rule)
    scored = sum(seen[2:])
    assert scored < 1280 * 4
    want = np.sort(np.where(docs[None, :] == docs[:8, None], topk.FLOOR, vectors[:8] @ vectors.T), axis=1)[:, ::-1][:, :10]
    assert (best == want).all()


def test_shards_that_cannot_reach_are_not_met(spark, monkeypatch):
    from surveyloom.llm import topk

    rng = np.random.default_rng(6)
    centres = rng.integers(-60, 60, (10, 24))
    vectors = np.repeat(centres, 60, axis=0) + rng.integers(-2, 3, (600, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    met, kept = [], topk.Scratch.keep

    def keep(self, frame, name):
        out = kept(self, frame, name)
        if name == "meetings":
            met.append(out.count())
        return out

    monkeypatch.setattr(topk.Scratch, "keep", keep)
    rule = TopRule(k=5, shard=60, block=20, chunk=3, group=4)
    got = grouped(top_scores(df, df.where("vec_id % 20 = 0"), rule).collect())
    assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 5)
    # 30 queries in chunks of one cluster each, 10 shards
    assert met[0] <= 60
