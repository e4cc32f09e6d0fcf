"""Packing token sequences: combinations of lengths by non-negative least squares.

A document's ids are cut every ``window``; these pieces are sequences of their own. What is left, the
tails, is packed by length alone. Combinations of two to four lengths that fill the window
exactly are listed, non-negative repeat counts are fitted to the histogram of tail lengths, rounded
down and filled up greedily. Tails no combination took are cut at powers of two, which
pack without gaps from large to small; the last sequence ends at powers of two.

Only the histogram (one count per length) and the chosen combinations (a bounded number) pass the
driver. Places follow from ranks: of a tail among those of its length in its task, and of
tasks among one another.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.store import Scratch


def _vocabulary(kind: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(f"byte_bpe_50k.{kind}")


@dataclass(frozen=True)
class PackRule:
    """Tokens of a sequence, the id that ends a document, and the vocabulary's ranks.

    Without ``ranks`` it is the public 50k byte-level vocabulary, whose ids are those of
    the ``tokenizers`` file of the same name. Where a text spells a token that ``added``, a ``tokenizers`` file, adds to
    its vocabulary, it has that token's id. With ``ranks`` and no ``added`` there are none.
    """

    window: int = 1024
    end_id: int = 0
    ranks: str | None = None
    added: str | None = None


_encoders: dict = {}


def _encoder(rule: PackRule):
    if rule not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(rule.ranks or _vocabulary("tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {}
        if rule.added or not rule.ranks:
            with open(rule.added or _vocabulary("json"), encoding="utf-8") as file:
                special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        _encoders[rule] = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
    return _encoders[rule]


def token_ids(text: str | None, rule: PackRule) -> np.ndarray:
    ids = _encoder(rule).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids, rule.end_id).astype("<u4")


def powers_in(length: int) -> list[int]:
    """Powers of two that add up to ``length``, the largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


CUTS = "doc_id long, part int, doc_tokens long, full array<long>, full_rank long, tail int, tail_rank long, tail_crc long, split array<long>"


def _cut(rule: PackRule):
    """Checks of every piece a document may be cut into, and ranks within the task."""

    def crc(ids: np.ndarray) -> int:
        return zlib.crc32(ids.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fulls, ranks = 0, np.zeros(rule.window, dtype=np.int64)
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for text in batch.column(1):
                ids = token_ids(text.as_py(), rule)
                whole = len(ids) // rule.window
                tail = ids[whole * rule.window :]
                split, at = [], 0
                for size in powers_in(len(tail)):
                    split.append(crc(tail[at : at + size]))
                    at += size
                row = (
                    part, len(ids), [crc(x) for x in ids[: whole * rule.window].reshape(whole, rule.window)], fulls,
                    len(tail), ranks[len(tail)], crc(tail), split,
                )
                for values, value in zip(out, row, strict=True):
                    values.append(value)
                fulls += whole
                ranks[len(tail)] += 1
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            names = [x.split()[0] for x in CUTS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, k) for v, k in zip(out, kinds, strict=True)]], names
            )

    return run


#: Combinations looked at together for those that still fit.
CHOSEN = 1 << 12


def combinations(window: int, lengths: np.ndarray) -> np.ndarray:
    """Combinations of two to four of the lengths that add up to the window, zero-padded to four.

    All pairs and triples; of fours those with a length twice or more.
    """
    have = np.zeros(window + 1, dtype=bool)
    have[lengths] = True
    out = [np.zeros((0, 4), dtype=np.int64)]
    a = lengths[have[window - lengths] & (2 * lengths <= window)]
    out.append(np.stack([a, window - a, 0 * a, 0 * a], axis=1))
    x, y = np.meshgrid(lengths, lengths, indexing="ij")
    for twice in (False, True):
        # x <= y <= z, or x, x, y, z
        z = window - x - y - (x if twice else 0)
        good = (z >= y) & ((x <= y) | twice) & (z > 0)
        good[good] = have[z[good]]
        p, q, r = x[good], y[good], z[good]
        out.append(np.stack([p, q, r, p if twice else 0 * p], axis=1))
    return np.unique(np.sort(np.concatenate(out), axis=1), axis=0)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares: how often each combination best explains the histogram.

    Multiplicative steps, which keep counts positive and never make the fit worse.
    """
    target = histogram.astype(np.float64)
    target[0] = 0
    flat = combos.ravel()

    def back(values: np.ndarray) -> np.ndarray:
        return values[combos].sum(axis=1)

    def forth(counts: np.ndarray) -> np.ndarray:
        made = np.bincount(flat, np.repeat(counts, combos.shape[1]), minlength=len(target))
        made[0] = 0
        return made

    aim = back(target)
    x = np.where(aim > 0, 1.0, 0.0) * max(1.0, target.sum()) / max(1, len(combos))
    for _ in range(rounds):
        x *= aim / np.maximum(back(forth(x)), 1e-12)
    return x


def choose(histogram: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Combinations and whole repeat counts that the tails suffice for."""
    combos = combinations(window, np.flatnonzero(histogram[:window]))
    combos = combos[combos.max(axis=1) < window] if len(combos) else combos
    if not len(combos):
        return combos, np.zeros(0, dtype=np.int64)
    fitted = repeat_counts(combos, histogram[: window + 1])
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(len(combos), dtype=np.int64)
    # how often each length occurs in its combination; padding never limits one
    times = np.where(combos > 0, (combos[:, :, None] == combos[:, None, :]).sum(axis=2), 1)
    whole = np.floor(fitted).astype(np.int64)

    def fitting(some: np.ndarray) -> np.ndarray:
        return np.where(combos[some] > 0, left[combos[some]] // times[some], np.iinfo(np.int64).max).min(axis=1)

    # rounded down, the fullest first; then one more by what rounding took; then whatever still fits
    for order, most in (
        (np.argsort(-whole, kind="stable"), whole),
        (np.argsort(whole - fitted, kind="stable"), np.ones_like(whole)),
        (np.argsort(-fitted, kind="stable"), np.full_like(whole, np.iinfo(np.int64).max)),
    ):
        for at in range(0, len(order), CHOSEN):
            some = order[at : at + CHOSEN]
            # what is left only shrinks, so what does not fit now is passed by
            for i in some[(most[some] > 0) & (fitting(some) > 0)]:
                n = min(int(most[i]), int(fitting(i[None])[0]))
                if n:
                    np.subtract.at(left, combos[i][combos[i] > 0], n)
                    taken[i] += n
    return combos[taken > 0], taken[taken > 0]


@dataclass
class Plan:
    """Where the tails go: of each length by rank, first into combinations, then cut at powers of two."""

    window: int
    #: per length and combination: first key (length and rank), times per sequence, first sequence, offset
    key: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    planned: np.ndarray
    #: of the cut tails: rank by length and power, first position by power, number of the first sequence
    rank: np.ndarray
    first: np.ndarray
    cut_sequence: int
    total: int

    SHIFT = 40

    @classmethod
    def of(cls, histogram: np.ndarray, window: int, sequence: int) -> Plan:
        combos, counts = choose(histogram, window)
        planned = np.zeros(window, dtype=np.int64)
        rows = []
        for row, n in zip(combos.tolist(), counts.tolist(), strict=True):
            at = 0
            for length in sorted({x for x in row if x}, reverse=True):
                times = row.count(length)
                rows.append(((length << cls.SHIFT) + int(planned[length]), times, sequence, at))
                planned[length] += n * times
                at += length * times
            sequence += n
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 4)
        rest = histogram[:window] - planned
        rest[0] = 0
        bits = window.bit_length()
        rank, first = np.zeros((window, bits), dtype=np.int64), np.zeros(bits, dtype=np.int64)
        total = 0
        for b in range(bits - 1, -1, -1):
            with_bit = np.where(np.arange(window) >> b & 1, rest, 0)
            rank[:, b] = np.cumsum(with_bit) - with_bit
            first[b] = total
            total += int(with_bit.sum()) << b
        return cls(window, *table.T, planned, rank, first, sequence, total)

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Pieces of a tail: start in it, length, sequence, offset."""
        if rank < self.planned[length]:
            key = (length << self.SHIFT) + rank
            i = int(np.searchsorted(self.key, key, "right")) - 1
            copy, which = divmod(key - int(self.key[i]), int(self.times[i]))
            return [(0, length, int(self.sequence[i]) + copy, int(self.offset[i]) + which * length)]
        out, start = [], 0
        for size in powers_in(length):
            b = size.bit_length() - 1
            at = int(self.first[b] + ((self.rank[length, b] + rank - self.planned[length]) << b))
            sequence, offset = divmod(at, self.window)
            if sequence == self.total // self.window:
                # the last one ends at powers of two, so that nothing is padded
                end = 0
                for k, part in enumerate(powers_in(self.total % self.window)):
                    if offset < end + part:
                        sequence, offset = sequence + k, offset - end
                        break
                    end += part
            out.append((start, size, self.cut_sequence + sequence, offset))
            start += size
        return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _place(shared, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(**shared.value)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for r in batch.to_pylist():
                pieces = [
                    (k * window, window, crc, r["full_base"] + r["full_rank"] + k, 0) for k, crc in enumerate(r["full"])
                ]
                if r["tail"]:
                    tail = plan.place(r["tail"], r["tail_base"] + r["tail_rank"])
                    checks = [r["tail_crc"]] if len(tail) == 1 else r["split"]
                    begin = r["doc_tokens"] - r["tail"]
                    pieces += [(begin + s, n, crc, q, o) for (s, n, q, o), crc in zip(tail, checks, strict=True)]
                for start, length, crc, sequence, offset in pieces:
                    row = (r["doc_id"], start, length, crc, r["doc_tokens"], sequence, offset)
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
            names = [x.split()[0] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], names)

    return run


def pack(docs: DataFrame, rule: PackRule = PackRule()) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are left out. A document's ids are its
    tokens and then ``end_id``; every id is in exactly one piece. Sequences are full, but for
    the last few, which hold a power of two; ``offset`` is gapless from 0. ``ids_crc32`` is taken
    over the piece's ids as little-endian unsigned 32-bit integers.

    Defined cases: a null or empty text is its end id alone; rows that repeat a ``doc_id`` are packed
    each on its own; a null ``doc_id`` stays null. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cuts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut(rule), CUTS)
    cuts = scratch.keep(cuts, "cuts")
    counts = cuts.groupBy("part", "tail").agg(F.count("*").alias("n"))
    before = Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tails = counts.withColumn("tail_base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    tails = scratch.keep(tails, "tails")
    # a row per task: how many whole windows the tasks before it have
    whole = cuts.groupBy("part").agg(F.sum(F.size("full")).alias("n")).withColumn("one", F.lit(1))
    before = Window.partitionBy("one").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = scratch.keep(whole.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("full_base")), "whole")
    histogram = np.zeros(rule.window + 1, dtype=np.int64)
    for r in tails.groupBy("tail").agg(F.sum("n").alias("n")).collect():
        histogram[r["tail"]] = r["n"]
    sequences = whole.agg(F.sum("n")).first()[0] or 0
    # plain arrays: workers without the package can read them
    plan = spark.sparkContext.broadcast(vars(Plan.of(histogram, rule.window, sequences)))
    placed = cuts.join(tails.drop("n"), ["part", "tail"]).join(whole.drop("n"), "part")
    return placed.mapInArrow(_place(plan, rule.window), PIECES)
