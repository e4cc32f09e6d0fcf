"""Phrase collocations: weighted acyclic automata of word n-grams, per language.

A task numbers the words of a stretch of text densely, sorts its n-grams and builds a count transducer of them: arcs
are words, an arc's weight is how often the phrase that ends with it occurs, and equal ends of phrases are one state.
Transducers are cut by ranges of a phrase's prefix hash; a range's reducer takes their union, sums weights and
keeps phrases that are frequent enough. Longer phrases are only counted where their parts are frequent: a filter of fixed
size says where they may be. Parts of the candidates are looked up by composition: a range's candidates send an acceptor of
the parts they need to the ranges that hold these, where it is walked beside the transducer.

Words are 64-bit hashes on the way. The table of words proves for the texts at hand that no other
word has the hash of a frequent one; if one has, everything starts again with another seed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.filters import filter_of, may_hold
from surveyloom.llm.store import Scratch
from surveyloom.llm.words import LOWER, U64, as_long, byte_set, mix, split_words

_MARKS = [(ord(c), ord(c)) for c in ".,;:!?"]
#: What a word ends at, and what a piece ends at.
_ENDS = byte_set((0x20, 0x20), (0x09, 0x0D), *_MARKS)
_BREAKS = byte_set((0x0A, 0x0D), *_MARKS)
#: Words a task puts together before it counts, and windows counted at a time.
STRETCH = 1 << 20
#: Ranges of the prefix hash: so many at least, and one for each so many words of all texts.
RANGES, RANGE_WORDS = 64, 4 << 20
#: Words of a phrase that its range depends on.
PREFIX = 4
#: A lang's best rows are sought in so many parts before they are put together.
PARTS = 64

_NAMES = ["part", "size", "body"]
_PACKED = "part int, size int, body binary"
_WORD_ROW = [("label", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64()), ("n", pa.int64())]


@dataclass(frozen=True)
class PhraseRule:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; a longer one with ``percent`` of a shorter one's
    occurrences takes its place; ``top`` rows of each language."""

    longest: int = 5
    least: int = 100
    percent: int = 100
    top: int = 2000


@dataclass
class Counts:
    """A weighted acyclic automaton: state s has arcs ``first[s]`` to ``first[s + 1]``, sorted by label.

    State 0 is the start. A path of arcs spells a phrase, its last arc's weight is the phrase's count (0: none of its own).
    States with the same arcs and weights are one.
    """

    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    @classmethod
    def of(cls, phrases: np.ndarray, weights: np.ndarray) -> Counts:
        """Of sorted distinct phrases of one length (rows of labels), a level at a time from the last words up."""
        n, size = phrases.shape
        label, weight = phrases[:, size - 1], weights.astype(np.int64)
        # state 1 ends all phrases; states are numbered from it up, the start is put in front at last
        target, states = np.ones(n, np.int64), [(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.array([0]))]
        free = 2
        for depth in range(size - 1, 0, -1):
            new = np.append(True, (phrases[1:, :depth] != phrases[:-1, :depth]).any(axis=1))[:n]
            own = np.flatnonzero(new)
            if len(phrases) != len(label):
                raise ValueError("phrases must be sorted and distinct")
            count = np.diff(np.append(own, n))
            name = np.zeros(len(own), np.int64)
            alone = count == 1
            # states of one arc that agree are one; others stand for themselves
            keys = np.zeros(int(alone.sum()), [("label", U64), ("weight", np.int64), ("target", np.int64)])
            keys["label"], keys["weight"], keys["target"] = label[own[alone]], weight[own[alone]], target[own[alone]]
            kept, which = np.unique(keys, return_inverse=True)
            name[alone] = free + which
            free += len(kept)
            rest = np.flatnonzero(~alone)
            name[rest] = free + np.arange(len(rest))
            free += len(rest)
            inside = np.repeat(~alone, count)
            states.append(
                (
                    np.concatenate([kept["label"], label[inside]]),
                    np.concatenate([kept["weight"], weight[inside]]),
                    np.concatenate([kept["target"], target[inside]]),
                    np.concatenate([np.ones(len(kept), np.int64), count[rest]]),
                )
            )
            phrases, n = phrases[own], len(own)
            label, weight, target = phrases[:, depth - 1], np.zeros(n, np.int64), name
        states.insert(0, (label, weight, target, np.array([n])))
        labels, sums, targets, sizes = (np.concatenate(x) for x in zip(*states, strict=True))
        return cls(np.concatenate([[0], np.cumsum(sizes)]), labels.astype(U64), sums, targets)

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All phrases of ``size`` words in order, and their counts."""
        rows, state = np.zeros((1, 0), U64), np.zeros(1, np.int64)
        weight = np.zeros(1, np.int64)
        for _ in range(size):
            count = self.first[state + 1] - self.first[state]
            arcs = np.repeat(self.first[state], count) + _ramp(count)
            rows = np.column_stack([np.repeat(rows, count, axis=0), self.label[arcs]])
            state, weight = self.target[arcs], self.weight[arcs]
        return rows, weight

    def compose(self, other: Counts, size: int) -> np.ndarray:
        """For every phrase of ``size`` words of ``other``, in order: its count here, 0 if it has none."""
        here, there = np.zeros(1, np.int64), np.zeros(1, np.int64)
        weight = np.zeros(1, np.int64)
        # labels are sorted within a state, so (state, label) is sorted over all arcs
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        order = np.zeros(len(owner), [("state", np.int64), ("label", U64)])
        order["state"], order["label"] = owner, self.label
        for _ in range(size):
            count = other.first[there + 1] - other.first[there]
            arcs = np.repeat(other.first[there], count) + _ramp(count)
            here = np.repeat(here, count)
            want = np.zeros(len(arcs), order.dtype)
            want["state"], want["label"] = here, other.label[arcs]
            at = np.minimum(np.searchsorted(order, want), max(len(order) - 1, 0))
            hit = (order[at] == want) & (here >= 0) if len(order) else np.zeros(len(arcs), bool)
            here, weight = np.full(len(arcs), -1), np.zeros(len(arcs), np.int64)
            here[hit], weight[hit] = self.target[at[hit]], self.weight[at[hit]]
            there = other.target[arcs]
        return weight

    def pack(self) -> bytes:
        head = np.array([len(self.first), len(self.label)], np.int64)
        narrow = [self.first.astype("<u4"), self.weight.astype("<i8"), self.target.astype("<u4")]
        return b"".join([head.tobytes(), self.label.tobytes(), *(x.tobytes() for x in narrow)])

    @classmethod
    def unpack(cls, body: bytes) -> Counts:
        states, arcs = np.frombuffer(body, np.int64, 2)
        label = np.frombuffer(body, U64, arcs, 16)
        at = 16 + 8 * arcs
        first = np.frombuffer(body, "<u4", states, at).astype(np.int64)
        weight = np.frombuffer(body, "<i8", arcs, at + 4 * states)
        target = np.frombuffer(body, "<u4", arcs, at + 4 * states + 8 * arcs).astype(np.int64)
        return cls(first, label, weight, target)


def _ramp(count: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)


def _summed(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows of labels and the sums of their weights."""
    if not len(rows):
        return rows, weights
    order = np.lexsort(rows.T[::-1])
    rows, weights = rows[order], weights[order]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[first], np.add.reduceat(weights, first)


def union(parts: list[Counts], size: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of several transducers with summed weights, in order, without those below ``least``."""
    found = [p.phrases(size) for p in parts]
    rows = np.concatenate([np.zeros((0, size), U64), *(r for r, _ in found)])
    rows, weights = _summed(rows, np.concatenate([np.zeros(0, np.int64), *(w for _, w in found)]))
    return rows[weights >= least], weights[weights >= least]


def phrase_hash(phrases: np.ndarray) -> np.ndarray:
    out = np.full(len(phrases), phrases.shape[1], U64)
    for k in range(phrases.shape[1]):
        out = mix((out ^ phrases[:, k]) + U64(0x9E3779B97F4A7C15))
    return out


def _part(phrases: np.ndarray, ranges: int) -> np.ndarray:
    """The range that holds a phrase, by its first ``PREFIX`` words."""
    own = phrase_hash(phrases[:, :PREFIX])
    return ((own >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


def _transducers(phrases: np.ndarray, weights: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes]]:
    """Sorted distinct phrases as a packed transducer for each range."""
    part = _part(phrases, ranges)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1])) if len(part) else []
    for rows in np.split(order, cuts[1:]) if len(part) else []:
        yield int(part[rows[0]]), Counts.of(phrases[rows], weights[rows]).pack()


def _lang_seeds(column: pa.Array, seed: int) -> np.ndarray:
    """A number for each row's language (null: ``und``)."""
    coded = column.fill_null("und").dictionary_encode()
    names = [hashlib.blake2b(f"{seed} {x}".encode(), digest_size=8).digest() for x in coded.dictionary.to_pylist()]
    return np.frombuffer(b"".join(names), U64)[coded.indices.to_numpy()] if len(column) else np.zeros(0, U64)


def _words(batch: pa.RecordBatch, seed: int):
    """``(words, labels, starts)`` of chunks: a label for each word, and whether it starts a piece."""
    seeds = _lang_seeds(batch.column(1), seed)
    for words in split_words(batch.column(0), _ENDS, LOWER):
        labels = mix(words.hashes(seed) ^ seeds[words.low : words.high][words.row_of()])
        begins = np.ones(len(labels), bool)
        marks = np.concatenate([[0], np.cumsum(_BREAKS[words.data])])
        begins[1:] = marks[words.starts[1:]] != marks[words.ends[:-1]]
        begins[words.first[:-1][words.first[:-1] < len(labels)]] = True
        yield words, labels, begins


def _count_words(seed: int):
    """Words with counts, and a row without word for the number of words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(labels, places, langs, count):
            kept, first, back = np.unique(np.concatenate(labels), return_index=True, return_inverse=True)
            sums = np.bincount(back, np.concatenate(count), len(kept)).astype(np.int64)
            words = pa.concat_arrays(places).take(pa.array(first))
            lang = pa.concat_arrays(langs).take(pa.array(first))
            return pa.RecordBatch.from_arrays(
                [pa.array(as_long(kept)), lang, words, pa.array(sums)], ["label", "lang", "word", "f"]
            )

        held, size = [], 0
        for batch in batches:
            lang = batch.column(1).fill_null("und")
            for words, labels, _ in _words(batch, seed):
                rows = words.row_of()
                kept, first, count = np.unique(labels, return_index=True, return_counts=True)
                if not len(kept):
                    continue
                starts, sizes = words.starts[first], words.ends[first] - words.starts[first]
                body = words.data[np.repeat(starts, sizes) + _ramp(sizes)]
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                spelt = pa.Array.from_buffers(pa.binary(), len(kept), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())])
                held.append((kept, spelt.cast(pa.string()), lang.take(pa.array(rows[first] + words.low)), count.astype(float)))
                size += len(kept)
                each = pd.Series(np.diff(words.first)).groupby(lang.slice(words.low, words.high - words.low).to_numpy(False)).sum()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(len(each), pa.int64()),
                        pa.array(each.index.tolist(), pa.string()),
                        pa.nulls(len(each), pa.string()),
                        pa.array(each.to_numpy(np.int64)),
                    ],
                    ["label", "lang", "word", "f"],
                )
            if size >= STRETCH:
                yield flush(*zip(*held, strict=True))
                held, size = [], 0
        if held:
            yield flush(*zip(*held, strict=True))

    return run


def _levels(labels: np.ndarray, joined: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of ``size`` words with counts; ``joined[i]`` says that a window may start at i."""
    at = np.flatnonzero(joined)
    _, code = np.unique(labels, return_inverse=True)
    node = code[at].astype(U64)
    for k in range(1, size):
        node = (node << U64(32)) | code[at + k].astype(U64)
        if k < size - 1:
            _, node = np.unique(node, return_inverse=True)
            node = node.astype(U64)
    # numbers of words follow the order of their labels, so windows are in order too
    _, first, count = np.unique(node, return_index=True, return_counts=True)
    return np.column_stack([labels[at[first] + k] for k in range(size)]), count


def _pairs(seed: int, flags: np.ndarray, ranges: int):
    """Transducers of two words that may both be frequent and stand in one piece."""

    def flush(held) -> Iterator[pa.RecordBatch]:
        labels, begins = (np.concatenate(x) for x in zip(*held, strict=True))
        may = may_hold(flags, as_long(labels))
        joined = np.append(may[:-1] & may[1:] & ~begins[1:], False)[: len(labels)]
        yield _packed(_transducers(*_levels(labels, joined, 2), ranges), 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, labels, begins in _words(batch, seed):
                held.append((labels, begins))
                size += len(labels)
                if size >= STRETCH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _packed(rows: Iterator[tuple[int, bytes]], size: int) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in rows], pa.int32()), pa.array([size] * len(rows), pa.int32()), pa.array([b for _, b in rows], pa.binary())],
        _NAMES,
    )


def _runs(seed: int, flags: np.ndarray):
    """Stretches of three words and more in which every two neighbours may be a frequent pair.

    A row holds stretches one after the other, the last word of each marked in ``ends``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, labels, begins in _words(batch, seed):
                if len(labels) < 3:
                    continue
                linked = ~begins[1:] & may_hold(flags, as_long(phrase_hash(np.column_stack([labels[:-1], labels[1:]]))))
                linked = np.concatenate([[False], linked, [False]])
                # a word stays if it is in a window of three
                middle = linked[:-1] & linked[1:]
                stay = middle.copy()
                stay[:-1] |= middle[1:]
                stay[1:] |= middle[:-1]
                ends = ~linked[1:][stay]
                # what was cut off after a word that stays ends its stretch as well
                at = np.flatnonzero(stay)
                ends[:-1] |= np.diff(at) > 1
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([labels[at].tobytes()], pa.binary()), pa.array([ends.tobytes()], pa.binary())], ["labels", "ends"]
                    )

    return run


def _longer(sizes: tuple[int, ...], flags: np.ndarray | None, ranges: int):
    """Transducers of windows in stretches; with ``flags`` only of those whose windows of three may be frequent."""

    def flush(held) -> Iterator[pa.RecordBatch]:
        labels, ends = (np.concatenate(x) for x in zip(*held, strict=True))
        joined = np.append(~ends[:-1], False)
        good = joined.copy()
        good[:-1] &= joined[1:]
        good[-1:] = False
        if flags is not None:
            at = np.flatnonzero(good)
            three = np.column_stack([labels[at + k] for k in range(3)])
            good[at] = may_hold(flags, as_long(phrase_hash(three)))
        for size in range(3, sizes[-1] + 1):
            if size > 3:
                good[:-1] &= good[1:]
                good[-1:] = False
            if size in sizes:
                yield _packed(_transducers(*_levels(labels, good, size), ranges), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for labels, ends in zip(batch.column(0), batch.column(1), strict=True):
                held.append((np.frombuffer(labels.as_buffer(), U64), np.frombuffer(ends.as_buffer(), bool)))
                size += len(held[-1][0])
                if size >= STRETCH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _frequent(size: int, least: int):
    """Of a range: the union of its transducers, without rare phrases."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        phrases, weights = union([Counts.unpack(b) for b in rows["body"]], size, least)
        if not len(phrases):
            return rows.iloc[:0]
        body = Counts.of(phrases, weights).pack()
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "size": [size], "body": [body]})

    return run


def _hashes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                rows, _ = Counts.unpack(body.as_py()).phrases(size)
                yield pa.RecordBatch.from_arrays([pa.array(as_long(phrase_hash(rows)))], ["id"])

    return run


def _questions(ranges: int):
    """Acceptors of the parts that a range's candidates need, for the ranges that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, size, body in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                phrases, _ = Counts.unpack(body).phrases(size)
                out = []
                for k in range(1, size):
                    pieces = [phrases[:, :k], phrases[:, size - k :]]
                    if k == 1:
                        pieces += [phrases[:, i : i + 1] for i in range(1, size - 1)]
                    asked, _ = _summed(np.concatenate(pieces), np.zeros(len(phrases) * len(pieces), np.int64))
                    out += [(p, k, b) for p, b in _transducers(asked, np.ones(len(asked), np.int64), ranges)]
                columns = [[f"{part} {size}"] * len(out), *([o[i] for o in out] for i in range(3))]
                types = [pa.string(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["asks", *_NAMES])

    return run


def _answers(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of the phrases of each acceptor that came to a range, in their order."""
    held = {int(s): Counts.unpack(b) for s, b in zip(rows["size"][rows["asks"].isna()], rows["body"][rows["asks"].isna()], strict=True)}
    asked = rows[rows["asks"].notna()]
    out = []
    for size, body in zip(asked["size"], asked["body"], strict=True):
        out.append(held[int(size)].compose(Counts.unpack(body), int(size)).tobytes())
    return asked[["asks", "size", "body"]].assign(counts=pd.Series(out, asked.index, dtype=object))


def _word_parts(ranges: int):
    """Frequent words as transducers for their ranges, with lang, spelling and size of the language in the same order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, pa.schema(_WORD_ROW)).combine_chunks()
        labels = rows["label"].to_numpy().view(U64)
        order = np.argsort(labels)
        part = _part(labels[order, None], ranges)
        out = {c: [] for c in ("part", "size", "body", "n", "lang", "words")}
        for p in np.unique(part):
            own = rows.take(pa.array(order[part == p]))
            body = Counts.of(own["label"].to_numpy().view(U64)[:, None], own["f"].to_numpy()).pack()
            values = (int(p), 1, body, own["n"].to_numpy().tobytes(), own["lang"].to_pylist(), own["word"].to_pylist())
            for column, value in zip(out.values(), values, strict=True):
                column.append(value)
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out.values(), types, strict=True)], list(out))

    return run


def _word_answers(rows: pd.DataFrame) -> pd.DataFrame:
    """As ``_answers``, of single words; with their spelling, their language and its number of words."""
    held = rows[rows["asks"].isna()]
    tables = [Counts.unpack(b).phrases(1) for b in held["body"]]
    labels, f = (np.concatenate(x) for x in zip(*((rows[:, 0], w) for rows, w in tables), strict=True))
    n = np.concatenate([np.frombuffer(x, np.int64) for x in held["n"]])
    lang, word = ([x for own in held[c] for x in own] for c in ("lang", "words"))
    order = np.argsort(labels)
    asked = rows[rows["asks"].notna()]
    out = {c: [] for c in ("counts", "n", "lang", "words")}
    for body in asked["body"]:
        at = order[np.searchsorted(labels[order], Counts.unpack(body).phrases(1)[0][:, 0])]
        out["counts"].append(f[at].tobytes())
        out["n"].append(n[at].tobytes())
        out["lang"].append([lang[i] for i in at])
        out["words"].append([word[i] for i in at])
    return asked[["asks", "size", "body"]].assign(**{c: pd.Series(x, asked.index, dtype=object) for c, x in out.items()})


def _scored(percent: int):
    """Of a range's candidates and the answers about their parts: a row per candidate, and the parts it replaces."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["counts"].isna()]
        names = ["key", "lang", "phrase", "a", "l", "r", "n", "score"]
        if not len(own):
            return pd.DataFrame({c: [] for c in names})
        size = int(own["size"].iloc[0])
        phrases, a = Counts.unpack(own["body"].iloc[0]).phrases(size)
        told = rows[rows["counts"].notna()]
        tables, spelt = {}, {}
        for k, group in told.groupby("size"):
            labels = np.concatenate([Counts.unpack(b).phrases(int(k))[0] for b in group["body"]])
            tables[int(k)] = labels, np.concatenate([np.frombuffer(c, np.int64) for c in group["counts"]])
            if k == 1:
                lengths = [np.frombuffer(c, np.int64) for c in group["n"]]
                values = zip(
                    labels[:, 0].tolist(), np.concatenate(lengths).tolist(), sum(group["lang"].map(list), []),
                    sum(group["words"].map(list), []), strict=True,
                )
                spelt = {x: (n, lang, word) for x, n, lang, word in values}

        def counts_of(parts: np.ndarray) -> np.ndarray:
            labels, count = tables[parts.shape[1]]
            both = np.concatenate([labels, parts])
            order = np.lexsort((np.arange(len(both)) >= len(labels), *both.T[::-1]))
            known = order < len(labels)
            # an asked phrase stands right behind the table's row of it
            last = np.maximum.accumulate(np.where(known, np.arange(len(order)), 0))
            out = np.zeros(len(both), np.int64)
            out[order] = count[order[last]]
            return out[len(labels) :]

        best = None
        total = np.array([spelt[x][0] for x in phrases[:, 0].tolist()], dtype=object)
        whole = 1000 * a.astype(object) * total
        for k in range(1, size):
            left, right = counts_of(phrases[:, :k].copy()), counts_of(phrases[:, k:].copy())
            score = whole // (left.astype(object) * right.astype(object))
            if best is None:
                best = [score, left, right]
            else:
                lower = (score < best[0]).astype(bool)
                best = [np.where(lower, new, old) for new, old in zip((score, left, right), best, strict=True)]
        lines = phrases.tolist()
        out = pd.DataFrame(
            {
                "key": [x.tobytes() for x in np.ascontiguousarray(phrases)],
                "lang": [spelt[x[0]][1] for x in lines],
                "phrase": [" ".join(spelt[w][2] for w in x) for x in lines],
                "a": a,
                "l": best[1],
                "r": best[2],
                "n": total.astype(np.int64),
                "score": best[0].astype(np.int64),
            }
        )
        if size > 2:
            gone = []
            for parts in (phrases[:, :-1].copy(), phrases[:, 1:].copy()):
                taken = 100 * a.astype(object) >= percent * counts_of(parts).astype(object)
                gone += [x.tobytes() for x in parts[taken.astype(bool)]]
            gone = sorted(set(gone))
            none = dict.fromkeys(("lang", "phrase"), [None] * len(gone)) | dict.fromkeys("a l r n score".split(), [0] * len(gone))
            out = pd.concat([out, pd.DataFrame({"key": gone, **none})], ignore_index=True)
        return out[names]

    return run


def collocations(docs: DataFrame, rule: PhraseRule = PhraseRule()) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` needs ``text`` and ``lang``; other columns are left out. Texts are read whole, A-Z in lower case, and cut into pieces
    at ``[.,;:!?\\x0A-\\x0D]``, these into words at blanks and tabs. A phrase occurs ``a`` times within pieces, ``n`` words
    occur in its language. Its weakest cut into two parts, which occur ``l`` and ``r`` times, gives the score
    ``1000 * a * n // (l * r)``.

    Defined cases: null texts are empty, a null ``lang`` is ``und``; texts without words add nothing; rows that repeat count
    each. Equal scores go by ``a`` and then by the phrase's bytes. An empty table, or one without phrases frequent enough, gives
    an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    docs = docs.select("text", F.col("lang").cast("string").alias("lang"))
    seed = 0
    while True:
        counted = docs.mapInArrow(_count_words(seed), "label long, lang string, word string, f long")
        words = counted.groupBy("label", "lang", "word").agg(F.sum("f").alias("f"))
        words = scratch.keep(words, f"words-{seed}")
        spelt = words.where("word is not null")
        twice = spelt.groupBy("label").agg(F.count("*").alias("times"), F.max("f").alias("f"))
        if twice.where(f"times > 1 and f >= {rule.least}").isEmpty():
            break
        scratch.drop(f"words-{seed}")
        seed += 1
    sizes = words.where("word is null").select("lang", F.col("f").alias("n"))
    frequent = scratch.keep(spelt.where(F.col("f") >= rule.least), "frequent")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = max(RANGES, -(-total // RANGE_WORDS))
    frequent = scratch.keep(frequent.join(scratch.keep(sizes, "sizes"), "lang"), "known")

    def kept(rows: DataFrame, size: int) -> DataFrame:
        one = rows.where(F.col("size") == size) if size > 3 else rows
        return scratch.keep(one.groupBy("part").applyInPandas(_frequent(size, rule.least), _PACKED), f"size-{size}")

    def flags_of(rows: DataFrame, size: int) -> np.ndarray:
        return filter_of(rows.select("body").mapInArrow(_hashes(size), "id long"))

    pairs = kept(docs.mapInArrow(_pairs(seed, filter_of(frequent.select("label")), ranges), _PACKED), 2)
    found = [pairs]
    if rule.longest > 2:
        runs = scratch.keep(docs.mapInArrow(_runs(seed, flags_of(pairs, 2)), "labels binary, ends binary"), "runs")
        found.append(kept(runs.mapInArrow(_longer((3,), None, ranges), _PACKED), 3))
    if rule.longest > 3:
        sizes = tuple(range(4, rule.longest + 1))
        more = scratch.keep(runs.mapInArrow(_longer(sizes, flags_of(found[1], 3), ranges), _PACKED), "more")
        found += [kept(more, k) for k in sizes]
    found = scratch.keep(reduce(DataFrame.unionByName, found), "found")
    scratch.drop("runs", "more")
    # the parts of all candidates: asked range by range
    asked = scratch.keep(found.select(*_NAMES).mapInArrow(_questions(ranges), "asks string, " + _PACKED), "asked")
    held = found.select(F.lit(None).cast("string").alias("asks"), *_NAMES)
    phrases = asked.where("size > 1").unionByName(held.where(F.col("size") < rule.longest)).groupBy("part")
    phrases = phrases.applyInPandas(_answers, "asks string, size int, body binary, counts binary")
    columns = "part int, size int, body binary, n binary, lang array<string>, words array<string>"
    known = frequent.select(*[c for c, _ in _WORD_ROW]).mapInArrow(_word_parts(ranges), columns)
    singles = asked.where("size = 1").unionByName(known, allowMissingColumns=True).groupBy("part")
    told = "asks string, size int, body binary, counts binary, n binary, lang array<string>, words array<string>"
    singles = singles.applyInPandas(_word_answers, told)
    own = found.select(F.concat_ws(" ", "part", "size").alias("asks"), "size", "body")
    rows = own.unionByName(phrases, allowMissingColumns=True).unionByName(singles, allowMissingColumns=True)
    scored = rows.groupBy("asks").applyInPandas(
        _scored(rule.percent), "key binary, lang string, phrase string, a long, l long, r long, n long, score long"
    )
    scored = scratch.keep(scored, "scored")
    gone = scored.where("phrase is null").select("key").distinct()
    left = scored.where("phrase is not null").join(gone, "key", "left_anti").drop("key")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    best = left.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= rule.top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= rule.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

