"""Toxicity: a factorization machine over hashed terms.

Terms are a text's distinct words and the beginnings of its longer words. A text scores
the sum of its terms' weights and, for every pair of terms, the product of their vectors over the root
of the number of terms, so a pair counts that neither of the two gives away alone. It is fitted on a bounded sample of labelled
rows; every whole text is scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveyloom.llm.store import small_batches
from surveyloom.llm.words import LOWER, NOT_LETTERS, U64, mix, split_words


@dataclass(frozen=True)
class ToxicRule:
    """``sample`` is the most labelled rows the model is fitted on, ``terms`` the most terms of these rows together; terms in
    fewer than ``least`` rows say nothing.

    A small sample is gone through until ``steps`` batches are done. ``prefixes`` are the lengths, in bytes, of the beginnings of words that are terms too.
    """

    sample: int = 16_000
    terms: int = 24_000_000
    bits: int = 18
    factors: int = 6
    epochs: int = 4
    steps: int = 400
    batch: int = 128
    rate: float = 0.1
    decay: float = 20.0
    prefixes: tuple[int, ...] = (4, 6)
    least: int = 5
    seed: int = 7


@dataclass
class Machine:
    """Bias, weights and vectors of a fitted factorization machine."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margins(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of texts whose terms are ``terms[first[i]:first[i + 1]]``."""
        n = np.diff(first)
        linear = _sums(self.weights[terms], first)
        own = self.vectors[terms]
        both = _sums(own, first) ** 2 - _sums(own**2, first)
        return self.bias + linear + 0.5 * both.sum(axis=1) / np.sqrt(np.maximum(n, 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs; an empty run is 0."""
    padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
    out = np.add.reduceat(padded, np.minimum(first[:-1], len(values)), axis=0)
    out[np.diff(first) == 0] = 0
    return out


def terms_of(column: pa.Array, rule: ToxicRule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct hashed terms of texts: ``(terms, first)`` for chunks of whole texts in order."""
    shift = U64(64 - rule.bits)
    for words in split_words(column, NOT_LETTERS, LOWER):
        own = words.hashes() >> shift
        eights = np.ndarray((len(words.data) - 7,), "<u8", words.data, 0, (1,))
        row = words.row_of().astype(U64) << U64(rule.bits)
        keys = [row | own]
        for size in rule.prefixes:
            longer = np.flatnonzero(words.ends - words.starts > size)
            begin = eights[words.starts[longer]] & U64((1 << (8 * size)) - 1)
            keys.append(row[longer] | mix(begin + U64(size)) >> shift)
        keys = np.unique(np.concatenate(keys))
        first = np.searchsorted(keys, np.arange(words.high - words.low + 1, dtype=U64) << U64(rule.bits))
        yield (keys & U64((1 << rule.bits) - 1)).astype(np.int64), first


def fit(labels: np.ndarray, terms: list[np.ndarray], rule: ToxicRule) -> Machine:
    """Log loss, AdaGrad steps over small batches in an order the seed fixes.

    ``decay`` times half the square of every parameter is added to the loss of an epoch, in equal parts
    over the rows that have its term: so a term needs many rows of one label to gain a weight.
    """
    random = np.random.default_rng(rule.seed)
    size = 1 << rule.bits
    often = np.zeros(size, dtype=np.int64)
    for own in terms:
        often[own] += 1
    terms = [own[often[own] >= rule.least] for own in terms]
    share = (labels.sum() + 1) / (len(labels) + 20)
    machine = Machine(
        float(np.log(share / (1 - share))), np.zeros(size), random.normal(0, 0.05, (size, rule.factors))
    )
    past_w, past_v = np.full(size, 1e-2), np.full((size, rule.factors), 1e-2)
    rounds = max(rule.epochs, -(-rule.steps * rule.batch // max(1, len(labels))))
    for _ in range(rounds if len(labels) else 0):
        order = random.permutation(len(labels))
        for at in range(0, len(order), rule.batch):
            part = order[at : at + rule.batch]
            own = [terms[i] for i in part]
            first = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            flat = np.concatenate(own)
            if not len(flat):
                continue
            n = np.sqrt(np.maximum(np.diff(first), 1))
            v = machine.vectors[flat]
            sums = _sums(v, first)
            pairs = 0.5 * (sums**2 - _sums(v**2, first)).sum(axis=1) / n
            margin = machine.bias + _sums(machine.weights[flat], first) + pairs
            miss = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]
            row = np.repeat(np.arange(len(part)), np.diff(first))
            used, where = np.unique(flat, return_inverse=True)
            part_of_loss = rule.decay * np.bincount(where) / often[used]
            step_w = np.bincount(where, miss[row]) + part_of_loss * machine.weights[used]
            each = (miss / n)[row, None] * (sums[row] - v)
            step_v = np.stack([np.bincount(where, each[:, k]) for k in range(rule.factors)], axis=1)
            step_v += part_of_loss[:, None] * machine.vectors[used]
            past_w[used] += step_w**2
            past_v[used] += step_v**2
            machine.weights[used] -= rule.rate * step_w / np.sqrt(past_w[used])
            machine.vectors[used] -= rule.rate * step_v / np.sqrt(past_v[used])
            machine.bias -= 0.01 * miss.mean()
    machine.vectors[often < rule.least] = 0
    machine.weights, machine.vectors = machine.weights.astype(np.float32), machine.vectors.astype(np.float32)
    return machine


def fit_level(labels: np.ndarray, terms: list[np.ndarray], rule: ToxicRule) -> Machine:
    """``fit`` on seven eighths; the last eighth sets the bias, so that 0.5 parts the labels best.

    Of equally good levels the middle one. With fewer than ``least`` rows of a label there, the bias stays.
    """
    apart = np.arange(len(labels)) % 8 == 7
    machine = fit(labels[~apart], [t for t, a in zip(terms, apart, strict=True) if not a], rule)
    own, label = [t for t, a in zip(terms, apart, strict=True) if a], labels[apart]
    if min(label.sum(), len(label) - label.sum()) < rule.least:
        return machine
    margin = machine.margins(np.concatenate(own), np.concatenate([[0], np.cumsum([len(t) for t in own])]))
    order = np.argsort(margin, kind="stable")
    margin, label = margin[order], label[order]
    # wrong if the level lies below row i: toxic rows before it, and clean ones from it on
    wrong = np.concatenate([[0], np.cumsum(label)]) + (len(label) - label.sum()) - np.concatenate([[0], np.cumsum(1 - label)])
    levels = np.concatenate([[margin[0] - 1], (margin[1:] + margin[:-1]) / 2, [margin[-1] + 1]])
    best = levels[wrong == wrong.min()]
    machine.bias -= float(best[len(best) // 2])
    return machine


def _terms(rule: ToxicRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for terms, first in terms_of(batch.column(2), rule):
                out += [terms[a:b].astype("<i4").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "toxic", "terms"])

    return run


def _machine(rule: ToxicRule):
    """For one task: the machine of the rows that come, as long as they have so many terms together at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, left = [], rule.terms
        for batch in batches:
            for toxic, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                left -= len(terms) // 4
                if left >= 0:
                    rows.append((zlib.crc32(terms), terms, toxic))
            if left < 0:
                break
        # an order that says nothing of the rows' terms
        rows.sort()
        fitted = fit_level(np.array([t for _, _, t in rows], dtype=float), [np.frombuffer(t, "<i4") for _, t, _ in rows], rule)
        columns = [pa.array([fitted.bias])]
        columns += [pa.array([x.astype("<f4").tobytes()], pa.binary()) for x in (fitted.weights, fitted.vectors)]
        yield pa.RecordBatch.from_arrays(columns, ["bias", "weights", "vectors"])

    return run


def held_out(doc_id) -> F.Column:
    """Rows no model is fitted on: those whose id, as text, has a crc32 divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rule: ToxicRule = ToxicRule()) -> Machine:
    """Fit on at most ``rule.sample`` labelled documents, chosen by a hash of their id."""
    small_batches(docs.sparkSession)
    marked = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out("doc_id"))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the bound of the sample is the bound of what is broadcast and of what one task fits; the machine alone comes back
    order = F.xxhash64("doc_id", F.lit(rule.seed))
    marked = marked.orderBy(order, "doc_id").limit(rule.sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marked), "doc_id")
    found = texts.select("doc_id", "toxic", "text").mapInArrow(_terms(rule), "doc_id long, toxic int, terms binary")
    # one text of an id, the same however the rows come
    found = found.groupBy("doc_id").agg(F.min(F.struct("terms", "toxic")).alias("row"))
    found = found.select(order.alias("at"), "doc_id", "row.*").repartition(1).sortWithinPartitions("at", "doc_id")
    fitted = found.select("toxic", "terms").mapInArrow(_machine(rule), "bias double, weights binary, vectors binary").first()
    if fitted is None:
        return fit_level(np.zeros(0), [], rule)
    weights, vectors = (np.frombuffer(fitted[c], "<f4") for c in ("weights", "vectors"))
    return Machine(fitted.bias, weights, vectors.reshape(-1, rule.factors))


def score(docs: DataFrame, machine: Machine, rule: ToxicRule, carried: F.Column) -> DataFrame:
    """``carried, score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of column ``text``, a row per input row."""
    # plain arrays: workers without the package can read them
    shared = docs.sparkSession.sparkContext.broadcast(vars(machine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(**shared.value)
        for batch in batches:
            margins = [np.zeros(0)]
            margins += [machine.margins(t, f) for t, f in terms_of(batch.column(0), rule)]
            chance = 1 / (1 + np.exp(-np.clip(np.concatenate(margins).astype(float), -30, 30)))
            columns = [batch.column(1), pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["carried", "score", "predicted"])

    rows = docs.select("text", carried.alias("carried"))
    schema = StructType().add(rows.schema["carried"]).add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, rule: ToxicRule = ToxicRule()) -> DataFrame:
    """Every document's toxicity: ``doc_id, held_out, score, predicted``, a row per input row.

    ``docs`` needs ``doc_id`` (integer) and ``text``, ``labels`` ``doc_id`` and ``toxic`` (0 or 1); other
    columns are left out and no input of a score. Held-out rows teach nothing.

    Defined cases: null and empty texts score the model's bias, which is where its level lies; labels
    that are null or neither 0 nor 1 are left out, of several labels of an id the largest holds, and of several texts one teaches; without
    labels every text scores one in twenty; a null ``doc_id`` is not held out. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(docs, train(docs, labels, rule), rule, F.col("doc_id")).withColumnRenamed("carried", "doc_id")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
