from collections import defaultdict

import numpy as np
import pytest
from corpus import words_of

from surveyloom.llm.components import connected
from surveyloom.llm import near_dups
from surveyloom.llm.near_dups import NearRule, common_counts, likeness, near_duplicates, sketch
from surveyloom.llm.store import Scratch
from surveyloom.llm.words import U64, mix


def shingles(text, size):
    own = words_of(text, lower=True)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def parts(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("size", [2, 5])
def test_classes_are_those_of_all_pairs(docs, rows, size):
    sets = {r[0]: shingles(r[1], size) for r in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = parts(sets, links)
    got = near_duplicates(docs, NearRule(size)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        d: (len(sets[d]), want[d], want[d] == d) for d in sets
    }


def test_odd_rows(odd, empty):
    got = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd).collect()
    )
    assert [g for g in got if g[1] == 1] == [(False, 1, 56, 1, True)] * 2
    assert [g for g in got if g[1] == 2] == [(False, 2, 2, 1, False), (False, 2, 57, 1, False)]
    assert [g[2:] for g in got if g[0]] == [(0, None, True), (56, None, True)]
    assert (False, 7, 0, 7, True) in got
    assert near_duplicates(empty).collect() == []


def test_a_family_whose_first_member_is_not_its_centre_is_whole(spark):
    """All are linked to the base alone, which has the largest id; some bucket's first is another."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(60):
        own = list(base)
        for at in range(k % 10, 200, 12):
            own[at] = f"x{k}_{at}_{rng.integers(1000)}"
        texts.append(" ".join(own))
    texts.append(" ".join(base))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: shingles(t, 1) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = parts(sets, links)
    assert len(set(want.values())) == 1
    got = near_duplicates(df, NearRule(1)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def family(n, edits, seed=4):
    """Texts with edits of their own: no two of them are linked, yet their estimates allow it."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(400)]
    out = []
    for k in range(n):
        own = list(base)
        for at in rng.choice(400, edits, replace=False):
            own[at] = f"x{k}_{at}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [near_dups.BLOCK, 20])
def test_families_at_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    texts = family(90, 25) + family(40, 23, 5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: shingles(t, 1) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = parts(sets, links)
    got = near_duplicates(df.repartition(3), NearRule(1)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_rows_of_a_family_do_not_grow_with_its_square(spark, monkeypatch):
    """What the steps write is counted for a family of texts whose pairs lie just below the threshold."""
    written = []
    keep = Scratch.keep

    def counted(self, df, name):
        out = keep(self, df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "keep", counted)
    most = []
    for n in (150, 300):
        written.clear()
        df = spark.createDataFrame(list(enumerate(family(n, 27))), "doc_id long, text string")
        found = near_duplicates(df, NearRule(1))
        assert found.where("kept").count() == n
        most.append(sum(written))
    assert most[1] < 2.6 * most[0]


def test_common_counts(monkeypatch):
    monkeypatch.setattr(near_dups, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    left, right = ([np.unique(rng.integers(0, 90, rng.integers(0, 40)).astype(U64)) for _ in range(n)] for n in (9, 13))
    got = common_counts(left, right)
    assert [[len(np.intersect1d(a, b)) for b in right] for a in left] == got.tolist()


def test_sketches_estimate_jaccard():
    rng = np.random.default_rng(1)
    for n in (6, 50, 700, 5000):
        both = mix(rng.integers(0, 1 << 62, n).astype(U64))
        a, b = np.sort(both[: n * 9 // 10]), np.sort(both[n // 10 :])
        want = len(np.intersect1d(a, b)) / n
        got = likeness(np.array([(sketch(a) == sketch(b)).mean()]))[0]
        assert abs(got - want) < 0.09


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(9, 8), (8, 7), (7, 9), (3, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.part for r in connected(df, Scratch(spark, "test")).collect()}
    want = parts({x for p in links for x in p} - {3}, [p for p in links if p[0] != p[1]])
    assert got == want
    assert connected(df.limit(0), Scratch(spark, "test")).collect() == []
    groups = defaultdict(set)
    for node, part in got.items():
        groups[part].add(node)
    assert sorted(map(len, groups.values())) == [3, 61, 200]


def test_members_of_a_family_are_joined_once(spark, monkeypatch):
    """Joins of members with their registers or sets make a row for each, not one for each block or pass that reads them."""
    monkeypatch.setattr(near_dups, "BLOCK", 10)
    looked = []
    kept = Scratch.keep

    def counted(self, df, name):
        if name in ("near", "left", "forest"):
            looked.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        out = kept(self, df, name)
        if name in ("mixed", "mixed-2"):
            looked.append((name, out.count()))
        return out

    monkeypatch.setattr(Scratch, "keep", counted)
    df = spark.createDataFrame(list(enumerate(family(60, 25) + family(40, 60, 5))), "doc_id long, text string")
    assert near_duplicates(df, NearRule(1)).count() == 100
    # one join with the registers, however many blocks a member is in, and one with the sets
    for name in ("near", "left", "forest"):
        plan = dict(looked)[name]
        assert sum("Join Inner" in x and "doc_id" in x for x in plan.splitlines()) == 1, plan
        blocks = min(i for i, x in enumerate(plan.splitlines()) if "Generate" in x)
        assert all("doc_id" not in x for x in plan.splitlines()[:blocks] if "Join" in x), plan
    # the second pass reads those that had somebody to touch
    assert dict(looked)["mixed-2"] < dict(looked)["mixed"]


def test_a_large_part_is_not_copied_for_its_own_members(spark, monkeypatch):
    """Rows made for blocks: the largest part of a bucket meets the few others, and grows no faster than itself."""
    monkeypatch.setattr(near_dups, "BLOCK", 20)
    made = {}
    for n in (200, 400):
        rows = [(7, k, 0 if k >= 10 else 1 + k) for k in range(n)]
        mixed = near_dups._outside(spark.createDataFrame(rows, "band long, doc_id long, part long"))
        sized = spark.createDataFrame([(k, 5, bytes(near_dups.BUCKETS)) for k in range(n)], "doc_id long, n long, registers binary")
        blocks = near_dups._blocked(mixed, sized)._df.collect()
        met = defaultdict(lambda: (set(), set()))
        for r in blocks:
            for side, there in zip(met[r.own, r.other], (r.left, r.right), strict=True):
                side |= {r.doc_id} if there else set()
        # every two members of different parts meet once and more
        pairs = {(min(a, b), max(a, b)) for left, right in met.values() for a in left for b in right if a != b}
        assert pairs == {(a, b) for a in range(10) for b in range(a + 1, n)}
        made[n] = len(blocks)
    # the ten others are copied to each block of twenty; a member of the largest part is there once
    assert made == {200: 190 + 10 * 10, 400: 390 + 10 * 20}


def test_equal_registers():
    rng = np.random.default_rng(5)
    many = rng.integers(0, 3, (50, near_dups.BUCKETS)).astype(np.uint8)
    many[7] = many[3]
    got = near_dups.equal_registers(many, many[3])
    assert got.tolist() == (many == many[3]).sum(axis=1).tolist() and got[7] == near_dups.BUCKETS
