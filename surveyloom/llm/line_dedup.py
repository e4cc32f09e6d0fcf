"""Line dedup: a segment-partition join of lines within a few edits of one another.

A line is cut into one segment more than edits allowed, so two lines within the threshold
agree in a whole segment, near its place. Every distinct line puts its segments into an index, by
length and place, and probes the indexes of its own and the next smaller lengths with
the substrings an equal segment may be. Whatever meets and has nearly the same bag of
characters is compared exactly, with one bit per diagonal of the band.

Index entries and probes of many lines travel together, by ranges of the entry's hash. Lines are taken for equal
if 128 bits agree, of hashes that mix every character before it is summed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveyloom.llm.components import connected
from surveyloom.llm.filters import either, filter_of, may_hold
from surveyloom.llm.store import Scratch
from surveyloom.llm.words import U64, as_long, mix, slices

_BASE = 0x9E3779B97F4A7C15 | 1
#: Entries in a pack, bytes of text for a range, and ranges at least.
PACK = 1 << 18
RANGE_BYTES = 8 << 20
RANGES = 64
#: Pairs looked at in one go by the bag filter, and characters of a batch of comparisons.
PAIRS = 1 << 18
CELLS = 2 << 20
#: Characters, or sums of characters, summed before they are mixed.
BLOCK = 64
#: Characters of text worked on at a time.
CHUNK_CHARS = 1 << 18


@dataclass(frozen=True)
class LineRule:
    """Lines of ``least`` characters and more are the same within ``edits``.

    With ``short``, shorter ones that are not blank are the same within fewer edits, in proportion to their length (by
    default one from 20 characters on, none below); without, they are left alone.
    """

    edits: int = 2
    least: int = 40
    short: bool = False

    def tiers(self) -> list[tuple[int, int, int]]:
        """``(edits, shortest, longest)`` of the lines compared within so many edits; a pair goes by its shorter line."""
        low = [-(-self.least * k // max(self.edits, 1)) for k in range(1, self.edits + 1)]
        ends = [*(n - 1 + k for k, n in enumerate(low[1:], 1)), 1 << 62]
        found = [(k, n, end) for k, (n, end) in enumerate(zip(low, ends, strict=True), 1)]
        return found if self.short else found[-1:]

    def allowed(self, size: int) -> int:
        """Edits within which lines are the same whose shorter one has so many characters."""
        return min(self.edits, size * self.edits // self.least) if self.short or size >= self.least else 0


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_CHARS + 1)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, dtype=U64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=U64))
        _powers[:] = tables
    return _powers[0], _powers[1]


@dataclass
class Lines:
    """Lines of some texts: place of each in ``chars``, and the row and number it has there."""

    chars: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    number: np.ndarray
    sums: np.ndarray

    def substring(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A hash of the characters from ``at`` on."""
        back = _power_tables(len(self.sums))[1]
        return (self.sums[at + size] - self.sums[at]) * back[at]

    def ids(self, seed: int = 0) -> np.ndarray:
        """64 bits of each line: characters are mixed, summed in blocks, and blocks' sums mixed and summed again."""
        size = self.ends - self.starts
        count = np.maximum(size, 1)
        begin = np.cumsum(count) - count
        at = np.arange(int(count.sum())) - np.repeat(begin, count) + np.repeat(self.starts, count)
        values = mix(np.append(self.chars, np.uint32(0))[at].astype(U64) + U64(seed * 0x632BE59BD9B4E019 & (1 << 64) - 1))
        values[begin[size == 0]] = 0
        weights = _power_tables(BLOCK)[0][:BLOCK]
        while len(count) and count.max() > 1:
            begin = np.cumsum(count) - count
            place = np.arange(len(values)) - np.repeat(begin, count)
            first = np.flatnonzero(place % BLOCK == 0)
            sums = mix(np.add.reduceat(values * weights[place % BLOCK], first) + U64(_BASE))
            # a line that is one sum already does not depend on how long the others are
            one, count = count == 1, -(-count // BLOCK)
            sums[(np.cumsum(count) - count)[one]] = values[begin[one]]
            values = sums
        return mix(values ^ mix(size.astype(U64)))

    def bags(self) -> np.ndarray:
        """How often characters of 16 kinds occur, four bits each, as one wrapping sum."""
        kind = mix(self.chars.astype(U64)) >> U64(60)
        sums = np.zeros(len(self.chars) + 1, dtype=U64)
        np.cumsum(np.left_shift(U64(1), kind * U64(4)), out=sums[1:])
        return sums[self.ends] - sums[self.starts]


def long_lines(texts: list[str], least: int) -> Iterator[Lines]:
    """Lines of at least ``least`` characters of whole texts."""
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) < CHUNK_CHARS):
            size += len(texts[high]) + 1
            high += 1
        chars = np.frombuffer("\n".join(texts[low:high]).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.append(np.flatnonzero(chars == 10), len(chars))
        starts = np.append(0, ends[:-1] + 1)
        count = np.array([t.count("\n") + 1 for t in texts[low:high]])
        row = np.repeat(np.arange(low, high), count)
        number = np.arange(len(ends)) - np.repeat(np.cumsum(count) - count, count)
        keep = ends - starts >= least
        powers = _power_tables(len(chars) + 1)[0]
        sums = np.zeros(len(chars) + 1, dtype=U64)
        np.cumsum((chars.astype(U64) + U64(1)) * powers[: len(chars)], out=sums[1:])
        yield Lines(chars, starts[keep], ends[keep], row[keep], number[keep], sums)
        low = high


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _segments(size: np.ndarray, edits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Starts and sizes of the segments of lines of the given sizes; the last ones are longer by one."""
    parts = edits + 1
    short, extra = size // parts, size % parts
    starts, sizes, at = [], [], np.zeros_like(size)
    for i in range(parts):
        own = short + (i >= parts - extra)
        starts.append(at)
        sizes.append(own)
        at = at + own
    return starts, sizes


def entries(lines: Lines, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """``(hash, which lines, whether a probe)`` of all index entries and probes."""
    size = lines.ends - lines.starts

    def keyed(which, at, own, length, i):
        return mix(lines.substring(lines.starts[which] + at, own) ^ mix(length.astype(U64) * U64(64) + U64(i + 8 * edits)))

    everything = np.arange(len(size))
    starts, sizes = _segments(size, edits)
    for i in range(edits + 1):
        yield keyed(everything, starts[i], sizes[i], size, i), everything, False
    for less in range(edits + 1):
        which = np.flatnonzero(size > less)
        own = size[which]
        starts, sizes = _segments(own - less, edits)
        for i in range(edits + 1):
            # edits before the segment shift it by at most i, those after it by at most edits - i
            low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
            for shift in range(low, high + 1):
                at = starts[i] + shift
                fits = (at >= 0) & (at + sizes[i] <= own)
                hit = which[fits]
                yield keyed(hit, at[fits], sizes[i][fits], own[fits] - less, i), hit, True


def _listed(texts: list[str], rule: LineRule) -> Iterator[Lines]:
    """Lines that can be in a class: long ones, and with ``short`` all that are not blank."""
    if not rule.short:
        yield from long_lines(texts, rule.least)
        return
    for lines in long_lines(texts, 1):
        blank = (lines.chars == 32) | ((lines.chars >= 9) & (lines.chars <= 13))
        signs = np.append(0, np.cumsum(~blank))
        size = lines.ends - lines.starts
        keep = (size >= rule.least) | (signs[lines.ends] > signs[lines.starts])
        for name in ("starts", "ends", "row", "number"):
            setattr(lines, name, getattr(lines, name)[keep])
        yield lines


def _list(rule: LineRule):
    """Ids of the listed lines of each text, two each, with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            ids, checks, numbers = [b""] * n, [b""] * n, [b""] * n
            for lines in _listed(_texts(batch.column(2)), rule):
                cut = np.flatnonzero(np.append(True, lines.row[1:] != lines.row[:-1])[: len(lines.row)])
                own, other = lines.ids(), lines.ids(1)
                for a, b in zip(cut, np.append(cut[1:], len(own)), strict=False):
                    ids[lines.row[a]], checks[lines.row[a]] = own[a:b].tobytes(), other[a:b].tobytes()
                    numbers[lines.row[a]] = lines.number[a:b].astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.binary()) for x in (ids, checks, numbers))],
                ["doc", "text_key", "ids", "checks", "numbers"],
            )

    return run


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each listed line."""
    for batch in batches:
        ids = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(2)]
        checks = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(3)]
        numbers = [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column(4)]
        if not ids:
            continue
        count = [len(x) for x in ids]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(ids)),
                pa.array(np.concatenate(checks)),
                pa.array(np.repeat(batch.column(0).to_numpy(), count)),
                pa.array(np.repeat(batch.column(1).to_numpy(), count)),
                pa.array(np.concatenate(numbers)),
            ],
            ["id", "check", "doc", "text_key", "line"],
        )


PACKED = "part int, hash binary, id binary, bag binary, probe binary"
PACK_NAMES = ["part", "hash", "id", "bag", "probe"]


def _index(rule: LineRule, ranges: int):
    """Packs of index entries and probes, each once per pack."""
    bounds = (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(U64)

    def flush(parts) -> Iterator[pa.RecordBatch]:
        hashes, ids, bags, probe = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((probe, ids, hashes))
        hashes, ids, bags, probe = hashes[order], ids[order], bags[order], probe[order]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1]) | (probe[1:] != probe[:-1]))
        columns = [x[new] for x in (hashes, ids, bags, probe)]
        cuts = np.concatenate([[0], np.searchsorted(columns[0], bounds), [len(columns[0])]])
        filled = np.flatnonzero(np.diff(cuts))
        packed = [pa.array([c[cuts[i] : cuts[i + 1]].tobytes() for i in filled], pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), *packed], PACK_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in slices(batches):
            tiers = rule.tiers()
            for lines in long_lines(_texts(batch.column(0)), tiers[0][1] if tiers else 1 << 62):
                ids, first = np.unique(lines.ids(), return_index=True)
                bags = lines.bags()[first]
                starts, ends = lines.starts[first], lines.ends[first]
                for edits, low, high in tiers:
                    own = np.flatnonzero((ends - starts >= low) & (ends - starts <= high))
                    lines.starts, lines.ends = starts[own], ends[own]
                    for hashes, which, probe in entries(lines, edits):
                        parts.append((hashes, ids[own[which]], bags[own[which]], np.full(len(which), probe)))
                        size += len(which)
                if size >= PACK:
                    yield from flush(parts)
                    parts, size = [], 0
        if size:
            yield from flush(parts)

    return run


_NIBBLES = np.abs(np.arange(256) % 16 - 8) + np.abs(np.arange(256) // 16 - 8)


def bags_near(a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    """Whether bags differ by no more than so many edits can: two counts each."""
    digits = (a - b) + U64(0x8888888888888888)
    return _NIBBLES[digits.view(np.uint8).reshape(-1, 8)].sum(axis=1) <= 2 * edits


def _meet(edits: int):
    """Pairs of an index entry and a probe of the same hash, with bags that are near."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        kinds = (U64, U64, U64, bool)
        hashes, ids, bags, probe = (
            np.frombuffer(b"".join(rows[n]), k) for n, k in zip(PACK_NAMES[1:], kinds, strict=True)
        )
        order = np.lexsort((ids, probe, hashes))
        hashes, ids, bags, probe = hashes[order], ids[order], bags[order], probe[order]
        same = (hashes[1:] == hashes[:-1]) & (ids[1:] == ids[:-1]) & (probe[1:] == probe[:-1])
        keep = np.append(True, ~same)[: len(hashes)]
        hashes, ids, bags, probe = hashes[keep], ids[keep], bags[keep], probe[keep]
        new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        total = np.diff(np.append(new, len(hashes)))
        probes = np.add.reduceat(probe.astype(np.int64), new) if len(new) else total
        index = total - probes
        # each index entry meets its group's probes: rows [begin, begin + many)
        entry = np.flatnonzero(~probe)
        group = np.repeat(np.arange(len(new)), total)[entry]
        begin, many = new[group] + index[group], probes[group]
        use = (many > 1) | ((many == 1) & (ids[np.minimum(begin, len(ids) - 1)] != ids[entry]))
        entry, begin, many = entry[use], begin[use], many[use]
        found, done = [], np.cumsum(many)
        at = 0
        while at < len(entry):
            base = done[at] - many[at]
            end = max(at + 1, int(np.searchsorted(done, base + PAIRS, "right")))
            a = np.repeat(entry[at:end], many[at:end])
            b = np.arange(len(a)) - np.repeat(done[at:end] - many[at:end] - base, many[at:end]) + np.repeat(begin[at:end], many[at:end])
            good = (ids[a] != ids[b]) & bags_near(bags[a], bags[b], edits)
            x, y = as_long(ids[a[good]]), as_long(ids[b[good]])
            found.append(np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0))
            at = end
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def within(left: list[str], right: list[str], edits: int) -> np.ndarray:
    """Whether the pairs are within ``edits`` insertions, deletions and replacements.

    A bit for each of the ``2 * edits + 1`` diagonals of the band and a set of bits for each
    number of edits; all pairs take a step along their right line together.
    """
    n = len(left)
    size = np.array([[len(a), len(b)] for a, b in zip(left, right, strict=True)]).reshape(n, 2)
    width, out = 2 * edits + 1, np.zeros(n, dtype=bool)
    order = np.argsort(size[:, 1], kind="stable")
    at = 0
    while at < n:
        end = at + 1
        while end < n and (end - at + 1) * (size[order[end]].max() + width) <= CELLS:
            end += 1
        part = order[at:end]
        at = end
        high = int(size[part].max()) + width + 1
        s = np.zeros((len(part), high + edits), dtype=np.uint32)
        t = np.zeros((len(part), high), dtype=np.uint32)
        for k, i in enumerate(part):
            own = np.frombuffer(left[i].encode("utf-32-le", "surrogatepass"), "<u4") + 2
            s[k, edits : edits + len(own)] = own
            own = np.frombuffer(right[i].encode("utf-32-le", "surrogatepass"), "<u4") + 2
            t[k, : len(own)] = own
            t[k, len(own) :] = 1
        # bit d: that many of left's characters more (d - edits) than of right's are used up
        reach = [np.zeros(len(part), dtype=np.uint32) for _ in range(edits + 1)]
        for e in range(edits + 1):
            for d in range(e + 1):
                reach[e] |= np.uint32(1 << (edits + d))
        band = np.uint32((1 << width) - 1)
        last = size[part, 1]
        gap = size[part, 0] - last
        final = np.zeros(len(part), dtype=bool)
        for j in range(int(last.max()) + 1):
            ended = last == j
            if ended.any():
                bit = np.clip(gap + edits, 0, width - 1).astype(np.uint32)
                final |= ended & (np.abs(gap) <= edits) & ((reach[edits] >> bit) & 1).astype(bool)
            match = np.zeros(len(part), dtype=np.uint32)
            for d in range(width):
                match |= (s[:, j + d] == t[:, j]).astype(np.uint32) << np.uint32(d)
            after = []
            for e in range(edits + 1):
                now = reach[e] & match
                if e:
                    now |= reach[e - 1] | (reach[e - 1] >> np.uint32(1)) | (after[e - 1] << np.uint32(1))
                after.append(now & band)
            reach = after
        out[part] = final
    return out


def _compare(rule: LineRule):
    """Pairs of lines that are the same within the edits their shorter one allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            edits = np.array([rule.allowed(min(len(a), len(b))) for a, b in zip(left, right, strict=True)], dtype=int)
            good = np.zeros(len(left), dtype=bool)
            for k in np.unique(edits[edits > 0]):
                at = np.flatnonzero(edits == k)
                good[at] = within([left[i] for i in at], [right[i] for i in at], int(k))
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _wanted(rule: LineRule, flags: np.ndarray):
    """Id and text of the lines the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = _texts(batch.column(0))
            for lines in long_lines(texts, rule.tiers()[0][1]):
                ids = as_long(lines.ids())
                hit = may_hold(flags, ids)
                hit &= np.isin(np.arange(len(ids)), np.unique(ids, return_index=True)[1])
                found = [
                    lines.chars[a:b].tobytes().decode("utf-32-le", "surrogatepass")
                    for a, b in zip(lines.starts[hit], lines.ends[hit], strict=True)
                ]
                checks = pa.array(as_long(lines.ids(1))[hit])
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), checks, pa.array(found, pa.string())], ["id", "check", "line_text"])

    return run


CUT = (
    "doc long, text_key long, n_lines long, n_removed long, removed array<int>, class_doc array<bigint>, class_line array<int>, "
    "n_links long, kept_text string, kept_sha256 string"
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n_lines, removed, of_doc, of_line, kept = [], [], [], [], []
        for text, drop in zip(_texts(batch.column("text")), batch.column("gone").to_pylist(), strict=True):
            lines, gone = text.split("\n"), {g["line"]: g for g in drop or ()}
            n_lines.append(len(lines))
            removed.append(sorted(gone))
            of_doc.append([None if gone[i]["class_doc"] == LAST else gone[i]["class_doc"] for i in removed[-1]])
            of_line.append([gone[i]["class_line"] for i in removed[-1]])
            kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                batch.column("text_key"),
                pa.array(n_lines, pa.int64()),
                pa.array([len(x) for x in removed], pa.int64()),
                pa.array(removed, pa.list_(pa.int32())),
                pa.array(of_doc, pa.list_(pa.int64())),
                pa.array(of_line, pa.list_(pa.int32())),
                batch.column("n_links").fill_null(0),
                pa.array(kept, pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in kept], pa.string()),
                batch.column("carried"),
            ],
            [*[x.split()[0] for x in CUT.split(", ")], "carried"],
        )


#: Stands for a missing doc_id: after all others.
LAST = np.iinfo(np.int64).max


def line_classes(docs: DataFrame, rule: LineRule, scratch: Scratch) -> DataFrame:
    """Every listed line that is not the first of its class, and first ones that are linked with other lines.

    ``docs`` has ``doc, text_key, text``. Returns ``doc, text_key, line, class_doc, class_line, n_links``:
    the class's first line and how many other distinct lines are within the threshold of this one.
    """
    listed = scratch.keep(docs.mapInArrow(_list(rule), "doc long, text_key long, ids binary, checks binary, numbers binary"), "listed")
    lines = listed.mapInArrow(_occurrences, "id long, check long, doc long, text_key long, line int")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(RANGES, -(-size // RANGE_BYTES))
    packs = docs.select("text").mapInArrow(_index(rule, ranges), PACKED)
    pairs = packs.groupBy("part").applyInPandas(_meet(rule.edits), "a long, b long").distinct()
    pairs = scratch.keep(pairs, "pairs")
    left, right = (pairs.select(F.col(c).alias("id")).distinct() for c in ("a", "b"))
    ids = scratch.keep(left.unionByName(right).distinct(), "ids")
    texts = docs.select("text").mapInArrow(_wanted(rule, filter_of(ids)), "id long, check long, line_text string")
    # should two lines have one id, the one compared is the one whose class this is
    texts = texts.join(ids, "id", "left_semi").groupBy("id").agg(F.min(F.struct("check", "line_text")).alias("row"))
    texts = scratch.keep(texts.select("id", "row.*"), "texts")
    x = texts.select(F.col("id").alias("a"), F.col("line_text").alias("p"))
    y = texts.select(F.col("id").alias("b"), F.col("line_text").alias("q"))
    half = scratch.keep(pairs.join(y, "b"), "half")
    links = half.join(x, "a").select("a", "b", "p", "q").mapInArrow(_compare(rule), "a long, b long")
    links = scratch.keep(links, "links")
    scratch.drop("pairs", "ids", "half")
    parts = connected(links, scratch, "line-parts")
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    parts = parts.join(degree, "node", "left").join(texts.select(F.col("id").alias("node"), "check"), "node")
    place = F.struct("doc", "line")
    seen = lines.groupBy("id", "check").agg(F.min(place).alias("first"), F.count("*").alias("times"))
    seen = seen.join(parts.withColumnRenamed("node", "id"), ["id", "check"], "left").where("times > 1 or part is not null")
    # a line linked with no other is a class by itself
    own = F.struct(F.coalesce("part", "id").alias("part"), F.when(F.col("part").isNull(), F.col("check")).alias("check"))
    seen = scratch.keep(seen.select("id", "check", "first", "n_links", own.alias("part")), "seen")
    first = seen.groupBy("part").agg(F.min("first").alias("class"))
    first = scratch.keep(first.select(F.col("part").alias("of"), "class"), "first")
    known = seen.join(first, F.col("part.part").eqNullSafe(F.col("of.part")) & F.col("part.check").eqNullSafe(F.col("of.check")))
    known = scratch.keep(known.select("id", "check", "n_links", "class"), "known")
    out = lines.join(known, ["id", "check"]).where((place > F.col("class")) | (F.col("n_links") > 0))
    return scratch.keep(
        out.select(
            "doc", "text_key", "line", F.col("class.doc").alias("class_doc"), F.col("class.line").alias("class_line"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        ),
        "repeats",
    )


def drop_repeated_lines(docs: DataFrame, rule: LineRule = LineRule(), carried: Column | None = None) -> DataFrame:
    """Texts without the lines that repeat an earlier one, exactly or within a few edits.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are left out, but for what ``carried`` takes along.
    Returns ``doc_id, n_lines, n_removed, removed, class_doc, class_line, n_links, kept_text, kept_sha256, carried``, a row per
    input row. Lines are what ``\\n`` separates. Lines linked within the threshold (``LineRule``), directly or through others, and equal
    ones are a class; its line with the smallest ``doc_id`` and place stays. ``removed`` are the numbers (from 0) of the
    lines taken out, ``class_doc`` and ``class_line`` the lines that stand for them, ``n_links`` the links that all lines of the text,
    kept ones included, have to other distinct lines.

    Defined cases: null and empty texts have one empty line; blank lines stay, however often they occur, and without ``rule.short`` all lines
    below ``least`` characters; rows with one ``doc_id`` are one document, so equal places in them are the same
    line; a null ``doc_id`` counts as the largest long. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        "text",
        (F.lit(None).cast("int") if carried is None else carried).alias("carried"),
    )
    repeats = line_classes(rows.drop("carried"), rule, scratch)
    first = (F.col("class_doc") == F.col("doc")) & (F.col("class_line") == F.col("line"))
    taken = F.when(~first, F.struct("line", "class_doc", "class_line"))
    gone = repeats.groupBy("doc", "text_key").agg(F.collect_list(taken).alias("gone"), F.sum("n_links").alias("n_links"))
    flags = filter_of(repeats.select("doc").distinct())
    # a text none of whose lines goes is not moved
    near = rows.mapInArrow(either(flags, True), rows.schema).join(gone, ["doc", "text_key"], "left")
    far = rows.mapInArrow(either(flags, False), rows.schema).select(
        "*", F.lit(None).cast(near.schema["gone"].dataType).alias("gone"), F.lit(0).cast("long").alias("n_links")
    )
    order = ["doc", "text_key", "text", "carried", "gone", "n_links"]
    schema = StructType.fromDDL(CUT).add(rows.schema["carried"])
    cut = near.select(order).unionByName(far.select(order)).mapInArrow(_cut, schema)
    doc = F.when(F.col("doc") != F.lit(int(LAST)), F.col("doc")).alias("doc_id")
    return cut.select(doc, "n_lines", "n_removed", "removed", "class_doc", "class_line", "n_links", "kept_text", "kept_sha256", "carried")
