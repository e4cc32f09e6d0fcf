from collections import Counter, defaultdict

import numpy as np
from corpus import words_of

from surveyloom.llm import mixing
from surveyloom.llm.mixing import MixRule, mix_sources, pivot, targets


def fill(sizes, weights, most):
    """Reshare the excess until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, left, free = {}, sum(sizes.values()), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return got | share
        for s in over:
            got[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return got


def test_targets_like_repeated_resharing():
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = {f"s{i}": int(rng.integers(1, 1000) ** 2) for i in range(9)} | {None: int(rng.integers(1, 500))}
        want = fill(sizes, (1, 2, 3), 3)
        got = targets(sizes, MixRule())
        assert all(abs(got[s] - want[s]) < 1e-6 * sum(sizes.values()) for s in sizes)
    assert targets({"a": 0, None: 0}, MixRule()) == {"a": 0.0, None: 0.0}


def check(got, rows):
    taken, source = Counter(), {r[0]: r[3] for r in rows}
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    aims, largest = targets(sizes, MixRule()), defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.size == len(words_of(next(x[1] for x in rows if x[0] == r.doc_id)))
        assert r.source_size == sizes[s] and abs(r.target - aims[s]) < 1e-6
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - aims[s]) <= largest[s] + 1e-6


def test_words_come_near_targets_and_reruns_agree(docs, rows, monkeypatch):
    got = mix_sources(docs).collect()
    check(got, rows)
    again = mix_sources(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    # a tree of several levels
    monkeypatch.setattr(mixing, "BUCKET", 4)
    check(mix_sources(docs).collect(), rows)


def test_pivots_keep_the_sum_and_the_chance():
    rng = np.random.default_rng(3)
    size, chance = np.array([5.0, 1, 9, 2, 30, 4]), np.array([0.3, 0.9, 0.5, 0.01, 0.4, 0.75])
    total = np.zeros(6)
    for _ in range(4000):
        out = pivot(chance, size, rng.random(6))
        assert abs((out * size).sum() - (chance * size).sum()) < 1e-9
        assert ((out > 0) & (out < 1)).sum() <= 1 and out.min() >= 0 and out.max() <= 1
        total += out
    assert np.abs(total / 4000 - chance).max() < 0.04


def test_odd_rows(odd, empty):
    got = mix_sources(odd).collect()
    assert len(got) == 7
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mix_sources(empty).collect() == []


def test_rows_alike_are_dealt_to_all_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 16)
    monkeypatch.setattr(mixing, "ALIKE", 50)
    data = [(None, "three words here", "a")] * 301 + [(None, None, "a")] * 120 + [(i, "w " * (i % 9), "b") for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    largest = []
    real = mixing._level

    def level(seed):
        run = real(seed)
        return lambda rows: run(rows).assign(bucket=len(rows))

    monkeypatch.setattr(mixing, "_level", level)
    kept = mixing.Scratch.keep

    def keep(self, frame, name):
        out = kept(self, frame, name)
        if name == "level-1":
            largest.append(out.agg({"bucket": "max"}).first()[0])
        return out

    monkeypatch.setattr(mixing.Scratch, "keep", keep)
    got = mix_sources(df).collect()
    assert len(got) == len(data) and largest and largest[0] < 80
    sizes = {"a": 903, "b": sum(i % 9 for i in range(200))}
    aims = targets(sizes, MixRule())
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    assert len([r for r in got if r.size == 3 and r.source == "a" and r.doc_id is None]) == 301
    monkeypatch.undo()
    again = Counter()
    for r in mix_sources(df.repartition(3)).collect():
        again[r.source] += r.taken
    assert all(abs(again[s] - aims[s]) <= 8 for s in sizes)
