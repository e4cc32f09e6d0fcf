import hashlib
import random
import zlib

import numpy as np
import pytest

from surveyloom.llm import prefix_trie as pt
from surveyloom.llm.prefix_trie import DoubleArray, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, parent string"


def brute(rows, share):
    convs = {}
    for c, t, role, text, *_ in rows:
        if c is None:
            continue
        role, text = role or "", text or ""
        key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        convs.setdefault(c, []).append((t is not None, t, key, (role, text)))
    convs = {c: [x[3] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, v in convs.items()}
    if share:
        whole = {}
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 9
            base = c - (c % 5 if c >= 0 else -(-c % 5))
            whole[c] = convs.get(base, [])[:h] + own[h:]
        convs = whole
    nodes = {}
    for c, own in convs.items():
        for d in range(len(own) + 1):
            nodes.setdefault(tuple(own[:d]), set()).add(c)
    out = []
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    below = {}
    for p in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        under = [below[k] for k in kids.get(p, [])]
        below[p] = (sum(u[0] for u in under) or 1, own + sum(u[1] for u in under))
        ends = sorted(c for c in nodes[p] if len(convs[c]) == len(p))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        up = min(nodes[p[:-1]]) if p else None
        out.append((min(nodes[p]), len(p), up, len(nodes[p]), len(kids.get(p, [])), *below[p], sha))
    return sorted(out, key=str)


def got(frame):
    return sorted([tuple(r)[:8] for r in frame.collect()], key=str)


def conversations(n=300, seed=2):
    rng = random.Random(seed)
    out = []
    for c in range(-7, n):
        if rng.random() < 0.1:
            continue
        depth = rng.choice([0, 1, 1, 2, 3, 3, 5, 9, 14])
        for t in range(depth):
            text = rng.choice(["hi", "yes", "no", "", None, "éß", "x" * 30]) if rng.random() < 0.8 else f"own {c} {t}"
            out.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", "user", None]), text, 1, "p"))
    # copies of one conversation, and long ones that part late
    for c in range(1000, 1400):
        out += [(c, t, "user", f"same {t}", None, None) for t in range(4)]
    for c in range(2000, 2006):
        out += [(c, t, "user", f"long {t}" if t < 150 + c % 7 else f"end {c}", 1, None) for t in range(160)]
    out += [(None, 1, "user", "lost", 1, None), (1, None, None, None, 1, None), (1, None, None, None, 1, None)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("share", [False, True])
@pytest.mark.parametrize("nodes", [pt.SHARD_NODES, 60])
def test_against_all_prefixes(spark, monkeypatch, share, nodes):
    """Also with shards so small that paths are merged in several rounds."""
    monkeypatch.setattr(pt, "SHARD_NODES", nodes)
    rows = conversations()
    frame = prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), share)
    assert got(frame) == brute(rows, share)


def test_small_packs_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(pt, "PACK", 7)
    rows = [(c, 0, "user", "hi", 1, "x") for c in range(500, 0, -1)]
    frame = prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(4), False)
    assert got(frame) == brute(rows, False)


def test_odd_rows(spark):
    rows = [(3, None, None, None, 1, None)] * 2 + [(-1, 5, "a", "z" * 2_000_000, 1, None), (-4, 5, "a", "z", 1, "q"), (None, None, None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for share in (False, True):
        assert got(prefix_trie(frame, share)) == brute(rows, share)
    assert prefix_trie(frame.limit(0)).collect() == []
    assert prefix_trie(frame.where("conv_id is null")).collect() == []
    # role and text are told apart
    rows = [(1, 0, "ab", "c", 1, ""), (2, 0, "a", "bc", 1, "")]
    assert got(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_walks_of_a_double_array():
    rng = random.Random(4)
    words = sorted({tuple(rng.randrange(40) for _ in range(rng.randrange(1, 7))) for _ in range(800)})
    sizes = np.array([len(w) for w in words])
    codes = np.concatenate([np.array(w) for w in words])
    trie = DoubleArray.of(codes, sizes)
    nodes = {w[:d] for w in words for d in range(len(w) + 1)}
    assert 1 + sum(map(len, trie.places)) == len(nodes) == len(np.unique(np.concatenate([[0], *trie.places])))
    path, at, seen = trie.walk(codes, sizes), 0, {}
    for w in words:
        for d in range(len(w) + 1):
            assert seen.setdefault(w[:d], path[at + d]) == path[at + d] >= 0
        at += len(w) + 1
    assert len(set(seen.values())) == len(nodes)
    for _ in range(300):
        w = tuple(rng.randrange(40) for _ in range(rng.randrange(1, 7)))
        last = trie.walk(np.array(w), np.array([len(w)]))
        assert [x >= 0 for x in last] == [w[:d] in nodes for d in range(len(w) + 1)]
