"""Trie of conversation prefixes: double arrays per shard, upper nodes merged up a tree of shards.

A conversation is a sequence of turns; a turn is a digest of its role and text with the text's length.
Equal sequences are one record. Records are dealt out by ranges of their order, so a prefix that very many
conversations share is spread over neighbouring shards. A shard numbers its turns densely, packs their trie into
two arrays (``base[node] + turn`` is the child's place, ``check`` there names its parent) and walks every record
down them. Nodes off the shard's first and last record are complete there. Nodes on these two paths may go on
in the shards beside it: the two paths, with what they hold, are the records of the next round, until
one shard is left.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.store import Scratch

#: Bytes of a turn in a sequence: 16 of its digest, 4 of its text's length.
TURN = 20
#: Nodes a shard is meant to hold, and conversations of a task put together before equal sequences are packed.
SHARD_NODES = 400_000
PACK = 1 << 16
PACK_BYTES = 32 << 20

EMPTY_HASH = hashlib.sha256(b"").digest()
_FAR = np.iinfo(np.int64).max
#: What a record knows of the node at each of its depths: conversations, the smallest of them, complete children,
#: leaves and saved bytes below these, and the digest of the conversations that end there.
PART = np.dtype([("n", "<i8"), ("low", "<i8"), ("kids", "<i8"), ("leaves", "<i8"), ("saved", "<i8"), ("ends", "u1", 32), ("ended", "u1")])
_NODES = (
    "kind int, seq binary, parts binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, turn_key string, node binary, parent binary"
)


def turn_key() -> F.Column:
    """A digest of ``role`` and ``text``, null as empty, by which turns are told apart."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def _rebuild(batches: Iterator[pa.RecordBatch], share: bool) -> Iterator[pa.RecordBatch]:
    """Packs of equal sequences from turns in order of (group, conversation, place)."""
    found: dict[bytes, list[int]] = {}
    size = count = 0

    def packs() -> pa.RecordBatch:
        rows = list(found.items())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([s for s, _ in rows], pa.binary()),
                pa.array([i[0] for _, i in rows], pa.int64()),
                pa.array([len(i) for _, i in rows], pa.int64()),
                pa.array([",".join(map(str, i)).encode() for _, i in rows], pa.binary()),
            ],
            ["seq", "first", "n", "ids"],
        )

    def close(own: dict[int, list[bytes]], group: int) -> None:
        nonlocal size, count
        turns = {c: b"".join(t) for c, t in own.items()}
        for conv, body in turns.items():
            if share:
                cut = zlib.crc32(str(conv).encode()) % 9 * TURN
                body = turns.get(group, b"")[:cut] + body[cut:]
            if body not in found:
                size += len(body)
            found.setdefault(body, []).append(conv)
            count += 1

    own: dict[int, list[bytes]] = {}
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        group, conv = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        turns = b"".join(batch.column(2).to_pylist())
        cuts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(conv)), strict=True):
            if group[a] != last:
                close(own, last)
                own, last = {}, int(group[a])
                if count >= PACK or size >= PACK_BYTES:
                    yield packs()
                    found, size, count = {}, 0, 0
            own.setdefault(int(conv[a]), []).append(turns[a * TURN : b * TURN])
    close(own, last)
    if found:
        yield packs()


@dataclass
class DoubleArray:
    """``base`` and ``check`` of a trie over turns ``0 .. n - 1``; the root is at 0.

    ``places`` lists the nodes level by level, without the root.
    """

    base: np.ndarray
    check: np.ndarray
    places: list[np.ndarray]

    @classmethod
    def of(cls, codes: np.ndarray, sizes: np.ndarray) -> DoubleArray:
        """From sequences in order, one after the other in ``codes``; equal beginnings stand together."""
        at = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        wide = int(codes.max()) + 1 if len(codes) else 1
        base, check = np.zeros(wide + 64, np.int64), np.full(wide + 64, -1, np.int64)
        check[0], high, places = -2, 1, []
        node = np.zeros(len(sizes), np.int64)
        for depth in range(int(sizes.max()) if len(sizes) else 0):
            on = np.flatnonzero(sizes > depth)
            parent, code = node[on], codes[at[on] + depth]
            new = np.append(True, (parent[1:] != parent[:-1]) | (code[1:] != code[:-1]))
            p, c = parent[new], code[new]
            first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
            count = np.diff(np.append(first, len(p)))
            room = high + (wide + 1) * 2 + len(p)
            if room > len(check):
                more = max(room, 2 * len(check)) - len(check)
                base, check = np.append(base, np.zeros(more, np.int64)), np.append(check, np.full(more, -1))
            # siblings first: the first free place that suits all of them, else behind all others
            for f, k in zip(first[count > 1], count[count > 1], strict=True):
                own = np.sort(c[f : f + k])
                away = own - own[0]
                free = np.flatnonzero(check[:high] == -1)[:64] if high <= 4096 else np.flatnonzero(check[high - 4096 : high] == -1)[:64] + high - 4096
                start = next((s for s in free if (check[s + away] == -1).all()), high)
                if start + away[-1] + wide + 1 >= len(check):
                    more = len(check)
                    base, check = np.append(base, np.zeros(more, np.int64)), np.append(check, np.full(more, -1))
                base[p[f]] = start - own[0]
                check[start + away] = p[f]
                high = max(high, int(start + away[-1]) + 1)
            # then nodes with one child, into the places left free
            alone = first[count == 1]
            free = np.flatnonzero(check[:high] == -1)[: len(alone)]
            free = np.append(free, np.arange(high, high + len(alone) - len(free)))
            if len(free):
                high = max(high, int(free[-1]) + 1)
                if high + wide + 1 > len(check):
                    more = high + wide + 1
                    base, check = np.append(base, np.zeros(more, np.int64)), np.append(check, np.full(more, -1))
            base[p[alone]] = free - c[alone]
            check[free] = p[alone]
            places.append(base[p] + c)
            node[on] = base[parent] + code
        return cls(base[: high + wide], check[: high + wide], places)

    def walk(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Nodes along every sequence, the root first; -1 from where a sequence leaves the trie."""
        at = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        out = np.full(int((sizes + 1).sum()), -1, np.int64)
        to = at + np.arange(len(sizes))
        node = np.zeros(len(sizes), np.int64)
        out[to] = 0
        for depth in range(int(sizes.max()) if len(sizes) else 0):
            on = np.flatnonzero((sizes > depth) & (node >= 0))
            child = self.base[node[on]] + codes[at[on] + depth]
            inside = (child >= 0) & (child < len(self.check))
            child[~inside] = 0
            child[~inside | (self.check[child] != node[on])] = -1
            node[on] = child
            out[to[on] + depth + 1] = child
        return out


def _dense(turns: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers of turns in order of their first place, level by level: siblings then mostly follow one another."""
    _, code = np.unique(turns, return_inverse=True)
    depth = np.arange(len(turns)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)
    order = np.argsort(depth, kind="stable")
    _, first = np.unique(code[order], return_index=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    return rank[code]


def _keys(seq: bytes) -> list[bytes]:
    """Digests of a sequence's beginnings, from the empty one on."""
    out = [bytes(16)]
    for i in range(0, len(seq), TURN):
        out.append(hashlib.blake2b(out[-1] + seq[i : i + TURN], digest_size=16).digest())
    return out


def _shard(seqs: list[bytes], parts: np.ndarray, whole: bool, named: bool) -> pa.RecordBatch:
    """Complete nodes of records in order, and the two paths that may go on elsewhere (none if ``whole``).

    ``named``: nodes carry their own digest, as their children of other rounds ask for it.
    """
    sizes = np.array([len(s) // TURN for s in seqs], np.int64)
    turns = np.frombuffer(b"".join(seqs), f"S{TURN}")
    codes = _dense(turns, sizes)
    trie = DoubleArray.of(codes, sizes)
    path = trie.walk(codes, sizes)
    start = np.concatenate([[0], np.cumsum(sizes + 1)])
    total = len(trie.check)
    n, kids, leaves, saved = (np.zeros(total, np.int64) for _ in range(4))
    low = np.full(total, _FAR)
    for name, out in (("n", n), ("kids", kids), ("leaves", leaves), ("saved", saved)):
        np.add.at(out, path, parts[name])
    np.minimum.at(low, path, parts["low"])
    ends, ended = np.zeros((total, 32), np.uint8), np.zeros(total, bool)
    at = np.flatnonzero(parts["ended"])
    ends[path[at]], ended[path[at]] = parts["ends"][at], True
    # the turn that leads to a node: any record's
    below = np.ones(len(path), bool)
    below[start[:-1]] = False
    turn_of = np.zeros(total, np.int64)
    turn_of[path[below]] = np.arange(len(turns))
    raw = np.frombuffer(b"".join(seqs), np.uint8).reshape(-1, TURN)
    length = np.zeros(total, np.int64)
    nodes = np.concatenate([np.zeros(1, np.int64), *trie.places])
    depth = np.repeat(np.arange(len(trie.places) + 1), [1, *map(len, trie.places)])
    if len(turns):
        length[nodes[1:]] = raw[turn_of[nodes[1:]], 16:].copy().view(">u4").ravel()
    open_ = np.zeros(total, bool)
    if not whole:
        open_[path[start[0] : start[1]]] = open_[path[start[-2] : start[-1]]] = True
    for level in [*reversed(trie.places), np.zeros(1, np.int64)]:
        done = level[~open_[level]]
        leaves[done] += kids[done] == 0
        saved[done] += (n[done] - 1) * length[done]
        done = done[done != 0]
        up = trie.check[done]
        np.add.at(kids, up, 1)
        np.add.at(leaves, up, leaves[done])
        np.add.at(saved, up, saved[done])
    keys: dict[int, bytes] = {}
    for i in range(len(seqs)) if named else {0, len(seqs) - 1}:
        keys.update(zip(path[start[i] : start[i + 1]].tolist(), _keys(seqs[i]), strict=True))
    done = ~open_[nodes]
    v, d = nodes[done], depth[done]
    up = trie.check[v]
    root = v == 0
    up[root] = 0
    outer = open_[up] & ~root
    hidden = root | outer
    turn_hex = [None if r else raw[turn_of[x], :16].tobytes().hex() for x, r in zip(v, root, strict=True)]
    columns = {
        "kind": pa.array(np.zeros(len(v), np.int32)),
        "seq": pa.nulls(len(v), pa.binary()),
        "parts": pa.nulls(len(v), pa.binary()),
        "conv_id": pa.array(low[v]),
        "depth": pa.array(d.astype(np.int64)),
        "parent_conv_id": pa.array(low[up], mask=hidden),
        "n_convs": pa.array(n[v]),
        "n_children": pa.array(kids[v]),
        "n_leaves": pa.array(leaves[v]),
        "saved_tokens": pa.array(saved[v]),
        "ends_sha256": pa.array([(ends[x].tobytes() if ended[x] else EMPTY_HASH).hex() for x in v], pa.string()),
        "turn_key": pa.array(turn_hex, pa.string()),
        "node": pa.array([keys[x] for x in v.tolist()] if named else [None] * len(v), pa.binary()),
        "parent": pa.array([keys[u] if o else None for u, o in zip(up.tolist(), outer, strict=True)], pa.binary()),
    }
    out = pa.table(columns)
    if not whole:
        again = []
        told = np.zeros(total, bool)
        for i in sorted({0, len(seqs) - 1}):
            own = path[start[i] : start[i + 1]]
            part = np.zeros(len(own), PART)
            part["low"] = _FAR
            fresh = ~told[own]
            told[own] = True
            for name, value in (("n", n), ("low", low), ("kids", kids), ("leaves", leaves), ("saved", saved), ("ends", ends), ("ended", ended)):
                part[name][fresh] = value[own[fresh]]
            again.append((seqs[i], part.tobytes()))
        more = {name: pa.nulls(len(again), column.type) for name, column in zip(out.column_names, out.columns, strict=True)}
        more["kind"] = pa.array([1] * len(again), pa.int32())
        more["seq"], more["parts"] = (pa.array(x, pa.binary()) for x in zip(*again, strict=True))
        out = pa.concat_tables([out, pa.table(more)])
    return out.combine_chunks()


def _first_round(batches: Iterator[pa.RecordBatch]) -> tuple[list[bytes], np.ndarray]:
    """Records from packs in order: conversations of equal sequences are counted, the list of their ids hashed as it comes."""
    seqs, parts, told = [], [], None
    for batch in batches:
        for seq, first, n, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if not seqs or seq != seqs[-1]:
                if seqs:
                    parts[-1]["ends"][-1] = np.frombuffer(told.digest(), np.uint8)
                seqs.append(seq)
                part = np.zeros(len(seq) // TURN + 1, PART)
                part["low"], part["ended"][-1] = first, 1
                parts.append(part)
                told = hashlib.sha256(ids)
            else:
                told.update(b"," + ids)
            parts[-1]["n"] += n
    if seqs:
        parts[-1]["ends"][-1] = np.frombuffer(told.digest(), np.uint8)
    return seqs, np.concatenate(parts) if parts else np.zeros(0, PART)


def _later_round(batches: Iterator[pa.RecordBatch]) -> tuple[list[bytes], np.ndarray]:
    seqs, parts = [], [np.zeros(0, PART)]
    for batch in batches:
        seqs += batch.column(0).to_pylist()
        parts += [np.frombuffer(p, PART) for p in batch.column(1).to_pylist()]
    return seqs, np.concatenate(parts)


def _round(first: bool, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seqs, parts = (_first_round if first else _later_round)(batches)
        if seqs:
            yield from _shard(seqs, parts, whole, not first).to_batches()

    return run


def prefix_trie(turns: DataFrame, share: bool = False) -> DataFrame:
    """Nodes of the trie of all conversations, a row each: ``conv_id`` (its smallest conversation), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256`` and
    ``turn_key``, the beginning of the digest (``turn_key()``) of the turn that leads to it.

    ``turns`` needs ``conv_id`` (integer), ``turn``, ``role`` and ``text``; other columns are left out. With
    ``share`` a conversation c is rebuilt first: the first h turns of conversation ``c - c % 5``, then c's own
    after its first h, h being the remainder by nine of crc32 of c's digits.

    Defined cases: turns go by ``turn``, null first, and where that is equal by ``turn_key()``; rows that repeat are
    turns each; null role or text is empty; rows without ``conv_id`` are left out. An empty table gives an empty one, else
    there is a root of depth 0. A turn's identity is 128 bits of its digest and the text's length. A task
    holds one conversation's turns (20 bytes each) at a time, and a shard's.
    """
    spark = turns.sparkSession
    scratch = Scratch(spark, "prefix-trie")
    conv = F.col("conv_id").cast("long")
    size = F.hex(F.octet_length(F.coalesce("text", F.lit(""))).cast("int"))
    rows = turns.where("conv_id is not null").select(
        (conv - conv % 5 if share else conv).alias("group"),
        conv.alias("conv"),
        F.unhex(F.concat(F.substring(turn_key(), 1, 32), F.lpad(size, 8, "0"))).alias("key"),
        F.col("turn").alias("place"),
    )
    rows = rows.repartitionByRange("group").sortWithinPartitions("group", "conv", F.col("place").asc_nulls_first(), "key")
    rows = rows.select("group", "conv", "key")
    packs = scratch.keep(rows.mapInArrow(lambda b: _rebuild(b, share), "seq binary, first long, n long, ids binary"), "packs")
    found, records, first = [], packs, True
    while True:
        turns_in = F.sum(F.length("seq") / TURN + 1).cast("long")
        records_in, nodes_in = records.agg(F.count("*"), F.coalesce(turns_in, F.lit(0))).first()
        if not records_in:
            break
        shards = -(-nodes_in // SHARD_NODES)
        if first:
            shards = max(shards, min(spark.sparkContext.defaultParallelism, -(-records_in // 64)))
        else:
            # a shard gives two records at most: with eight and more in it, rounds come to an end
            shards = min(shards, records_in // 8)
        whole = shards <= 1
        dealt = records.repartition(1) if whole else records.repartitionByRange(shards, "seq")
        dealt = dealt.sortWithinPartitions("seq", "first") if first else dealt.sortWithinPartitions("seq")
        name = f"round-{len(found)}"
        done = scratch.keep(dealt.mapInArrow(_round(first, whole), _NODES), name)
        found.append(done.where("kind = 0"))
        if whole:
            break
        records, first = done.where("kind = 1").select("seq", "parts"), False
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_key"]
    if not found:
        return spark.createDataFrame([], _NODES).select(*out)
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    # parents that were complete in a later round than their child
    named = scratch.keep(nodes.where("node is not null").select(F.col("node").alias("parent"), F.col("conv_id").alias("up")), "named")
    apart = nodes.where("parent is not null").join(named, "parent", "left").withColumn("parent_conv_id", F.col("up"))
    return nodes.where("parent is null").select(*out).unionByName(apart.select(*out))
