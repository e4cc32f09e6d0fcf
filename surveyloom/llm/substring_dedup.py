"""Repeated passages: difference-cover anchors, then every window they let through.

A window is a run of ``length`` consecutive words. The cover holds residues modulo a period
such that any two positions have a common shift, smaller than the period, that brings both onto
it. So two equal windows share an anchor: a shorter gram at cover positions of both.
Only grams at cover positions are hashed and compared; a window without a repeated
anchor has no equal. The others are extended to their full length and compared as a whole, by 128 bits.

Grams and windows travel as packs: a task puts the hashes of many documents together, each
hash once, split by ranges of the hash. A passage in a third of all documents is then one
entry per pack, and the answer to a pack goes back to its documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.filters import either, filter_of
from surveyloom.llm.store import Scratch
from surveyloom.llm.words import BLANKS, U64, split_words, windows

#: Smallest sets of residues whose differences are all residues, by period.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Hashes in a pack, and bytes of text per hash range; both bound a task's memory.
PACK = 1 << 18
RANGE_BYTES = 8 << 20
#: Ranges at least, so that a small input is spread as well.
RANGES = 64
#: Seed of the words and base of the windows of the second 64 bits of a window's hash.
CHECK, CHECK_BASE = 1, 0xD6E8FEB86659FD93
#: Stands for a missing doc_id: after all others.
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class RepeatRule:
    """Words of a window, and the period of the cover.

    An anchor has ``length - period + 1`` words; a common shift is below the period.
    """

    length: int = 20
    period: int = 13

    @property
    def anchor(self) -> int:
        return self.length - self.period + 1


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(0).to_numpy(), batch.column(1).to_numpy()


class _Pack:
    """Hashes with the place of their first occurrence, until there are enough to send."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.parts.append(columns)
            self.size += len(columns[0])

    def take(self) -> list[np.ndarray]:
        out = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        self.__init__()
        return out


def _order(high: np.ndarray, check: np.ndarray | None = None, *ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by hash, its second half if there is one and then place, and where a new hash begins in it."""
    hashes = (high,) if check is None else (high, check)
    order = np.lexsort((*reversed(ties), *reversed(hashes)))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for part in hashes:
        new[1:] |= part[order[1:]] != part[order[:-1]]
    return order, np.flatnonzero(new)


def _ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    """Cuts of sorted hashes into ``n`` equal ranges of the hash."""
    bounds = (np.arange(1, n, dtype=object) * (1 << 64) // n).astype(U64)
    return np.concatenate([[0], np.searchsorted(hashes, bounds), [len(hashes)]])


PACK_NAMES = ["part", "hash", "check", "doc", "text_key", "start"]
PACKED = "part int, hash binary, check binary, doc binary, text_key binary, start binary"


def _send(hashes, check, doc, key, start, n) -> Iterator[pa.RecordBatch]:
    """Rows of a pack, its hashes sorted, one for each range with hashes. Anchors have no second half."""
    cuts = _ranges(hashes, n)
    filled = np.flatnonzero(np.diff(cuts))
    columns = [
        pa.array([c[cuts[i] : cuts[i + 1]].tobytes() for i in filled], pa.binary())
        for c in (hashes, hashes[:0] if check is None else check, doc, key, start.astype(np.int32))
    ]
    yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), *columns], PACK_NAMES)


def _known(doc, key, start) -> Iterator[pa.RecordBatch]:
    """A row of places that need no other pack to be known."""
    if len(doc):
        columns = [pa.array([c.tobytes()], pa.binary()) for c in (doc[:0], doc[:0], doc, key, start.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), *columns], PACK_NAMES)


def _anchors(rule: RepeatRule, ranges: int):
    """Packs of anchor grams; places of grams that repeat within a pack are known at once."""
    on_cover = np.isin(np.arange(rule.period), COVERS[rule.period])

    def flush(pack: _Pack) -> Iterator[pa.RecordBatch]:
        hashes, doc, key, start = pack.take()
        order, new = _order(hashes)
        count = np.diff(np.append(new, len(order)))
        again = order[np.repeat(count > 1, count)]
        yield from _known(doc[again], key[again], start[again])
        one = order[new]
        yield from _send(hashes[one], None, doc[one], key[one], start[one], ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _Pack()
        for batch in batches:
            doc, key = _ids(batch)
            for words in split_words(batch.column(2), BLANKS):
                grams = windows(words.hashes(), rule.anchor)
                row = words.row_of()[: len(grams)]
                at = np.arange(len(grams)) - words.first[:-1][row]
                size = np.diff(words.first)[row]
                take = on_cover[at % rule.period] & (at + rule.anchor <= size) & (size >= rule.length)
                take = np.flatnonzero(take)
                row = row[take] + words.low
                pack.add(grams[take], doc[row], key[row], at[take])
                if pack.size >= PACK:
                    yield from flush(pack)
        if pack.size:
            yield from flush(pack)

    return run


def _unpack(rows: pd.DataFrame) -> list[np.ndarray]:
    kinds = (U64, U64, np.int64, np.int64, np.int32)
    names = ("hash", "check", "doc", "text_key", "start")
    return [np.frombuffer(b"".join(rows[n]), k) for n, k in zip(names, kinds, strict=True)]


def _places(doc: np.ndarray, key: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """A row per document with its starts."""
    order = np.lexsort((key, doc))
    doc, key, start = doc[order], key[order], start[order].astype(np.int32)
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))[: len(doc)])
    ends = np.append(new[1:], len(doc))[: len(new)]
    return pd.DataFrame(
        {
            "doc": doc[new],
            "text_key": key[new],
            "starts": [start[a:b].tobytes() for a, b in zip(new, ends, strict=True)],
        }
    )


PLACES = "doc long, text_key long, starts binary"


def _answer(pick):
    """What a range of hashes answers to its packs; known places go on as they are."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        hashes, check, doc, key, start = _unpack(rows)
        hit = slice(None) if len(rows) and rows["part"].iloc[0] < 0 else pick(hashes, check, doc, start)
        return _places(doc[hit], key[hit], start[hit])

    return run


def _repeated(hashes: np.ndarray, check: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Grams that more than one pack holds."""
    order, new = _order(hashes)
    count = np.diff(np.append(new, len(order)))
    return order[np.repeat(count > 1, count)]


def _later(hashes: np.ndarray, check: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Windows that also start earlier."""
    order, new = _order(hashes, check, doc, start)
    lead = np.repeat(order[new], np.diff(np.append(new, len(order))))
    return order[(doc[order] > doc[lead]) | ((doc[order] == doc[lead]) & (start[order] > start[lead]))]


def _starts(column: pa.Array) -> list[np.ndarray]:
    """Starts of each row, from lists of packed starts."""
    return [np.frombuffer(b"".join(x), np.int32) if x else np.zeros(0, np.int32) for x in column.to_pylist()]


def _extend(rule: RepeatRule, ranges: int):
    """Packs of the windows a repeated anchor lets through; those later in a pack are known at once."""

    def flush(pack: _Pack) -> Iterator[pa.RecordBatch]:
        hashes, check, doc, key, start = pack.take()
        late = _later(hashes, check, doc, start)
        yield from _known(doc[late], key[late], start[late])
        rest = np.ones(len(hashes), dtype=bool)
        rest[late] = False
        rest = np.flatnonzero(rest)
        rest = rest[np.argsort(hashes[rest], kind="stable")]
        yield from _send(hashes[rest], check[rest], doc[rest], key[rest], start[rest], ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _Pack()
        for batch in batches:
            doc, key = _ids(batch)
            starts = _starts(batch.column(3))
            for words in split_words(batch.column(2), BLANKS):
                grams = windows(words.hashes(), rule.length)
                checks = windows(words.hashes(CHECK), rule.length, CHECK_BASE)
                for i in range(words.high - words.low):
                    a, b = words.first[i], words.first[i + 1]
                    n = b - a - rule.length + 1
                    if n <= 0 or not len(starts[words.low + i]):
                        continue
                    # an anchor at p speaks for the windows that start at most period - 1 before it
                    edge = np.zeros(b - a + 2, dtype=np.int32)
                    p = starts[words.low + i].astype(np.int64)
                    np.add.at(edge, np.maximum(p - rule.period + 1, 0), 1)
                    np.add.at(edge, p + 1, -1)
                    at = np.flatnonzero(np.cumsum(edge)[:n] > 0)
                    row = words.low + i
                    pack.add(grams[a + at], checks[a + at], np.full(len(at), doc[row]), np.full(len(at), key[row]), at)
                if pack.size >= PACK:
                    yield from flush(pack)
        if pack.size:
            yield from flush(pack)

    return run


def _cut(rule: RepeatRule):
    """What is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = _starts(batch.column(3))
            n_words, n_removed, kept, sha = [], [], [], []
            for words in split_words(batch.column(2), BLANKS):
                for i in range(words.high - words.low):
                    a, b = words.first[i], words.first[i + 1]
                    edge = np.zeros(b - a + 1, dtype=np.int32)
                    at = starts[words.low + i]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + rule.length, -1)
                    stay = a + np.flatnonzero(np.cumsum(edge)[: b - a] == 0)
                    body = words.data
                    text = b" ".join(
                        [body[s:e].tobytes() for s, e in zip(words.starts[stay].tolist(), words.ends[stay].tolist(), strict=True)]
                    )
                    n_words.append(b - a)
                    n_removed.append(b - a - len(stay))
                    kept.append(text.decode() if len(stay) < b - a else None)
                    sha.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array(kept, pa.string()),
                ],
                ["doc", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def _flat(places: DataFrame) -> DataFrame:
    return places.groupBy("doc", "text_key").agg(F.collect_list("starts").alias("starts"))


def _answers(packs: DataFrame, pick, ranges: int) -> DataFrame:
    known = -1 - F.pmod(F.xxhash64("doc"), F.lit(ranges))
    grouped = packs.withColumn("group", F.when(F.col("part") < 0, known).otherwise(F.col("part"))).groupBy("group")
    return grouped.applyInPandas(_answer(pick), PLACES)


def remove_repeats(docs: DataFrame, rule: RepeatRule = RepeatRule()) -> DataFrame:
    """Texts without the words of windows that also start earlier.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are left out. Returns
    ``doc_id, n_words, n_removed, kept_sha256, kept_text``, a row per input row: ``kept_text`` is the
    kept words joined by one space, null where nothing was removed. Earlier means a smaller
    ``doc_id``, or the same and an earlier start; windows are judged on the input.

    Defined cases: null and empty texts have no words; a text shorter than a window stays; rows with one
    ``doc_id`` are one document, so equal places in them are the same place and stay; a null
    ``doc_id`` counts as the largest long, after all others. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        "text",
    )
    rows = "doc long, text_key long, text string"
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(RANGES, -(-size // RANGE_BYTES))
    # anchors that repeat
    hits = scratch.keep(_answers(docs.mapInArrow(_anchors(rule, ranges), PACKED), _repeated, ranges), "hits")
    flags = filter_of(hits.select(F.col("doc").alias("doc_id")))
    # the windows around them; a text without such an anchor is not moved
    near = docs.mapInArrow(either(flags, True), rows).join(_flat(hits), ["doc", "text_key"], "left")
    near = scratch.keep(near.select("doc", "text_key", "text", "starts"), "near")
    late = scratch.keep(_answers(near.mapInArrow(_extend(rule, ranges), PACKED), _later, ranges), "late")
    scratch.drop("hits")
    # take the words out
    moved = near.drop("starts").join(_flat(late), ["doc", "text_key"], "left").select("doc", "text_key", "text", "starts")
    alone = docs.mapInArrow(either(flags, False), rows).withColumn("starts", F.lit(None).cast("array<binary>"))
    out = "doc long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    cut = moved.mapInArrow(_cut(rule), out).unionByName(alone.mapInArrow(_cut(rule), out))
    return cut.withColumn("doc_id", F.when(F.col("doc") != F.lit(int(LAST)), F.col("doc"))).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"
    )
