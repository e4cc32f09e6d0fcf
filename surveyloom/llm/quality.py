"""Quality: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text is a sparse vector: its words and pairs of words, and runs of up to three word forms (capitals, digits,
signs, the word before again), hashed into ``2 ** bits`` terms; a term's value grows with the logarithm
of its count, and the vector has length one. The fit keeps two sums per term, from which a weight is
made when the term is met; small sums give weight 0, so the model is a sparse vector too, and a score is a dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveyloom.llm.store import small_batches
from surveyloom.llm.words import CHUNK_BYTES, LOWER, U64, Words, mix, text_buffers

#: Kinds of bytes: blanks part words; letters (all bytes of other letters too), digits and signs make words of their own.
_BLANK, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.full(256, _SIGN, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _BLANK
_KIND[0x30:0x3A] = _DIGIT
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER

#: The length of a run of equal words up to which it is told apart, and of signs.
_LONGEST = 3


@dataclass(frozen=True)
class QualityRule:
    """``sample`` is the most labelled rows the model is fitted on, ``terms`` the most terms of these rows together.

    ``alpha``, ``beta`` set the rate of a term, which falls with its own past gradients; ``l1``, ``l2`` are the penalties.
    """

    sample: int = 16_000
    terms: int = 24_000_000
    bits: int = 18
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.1
    l2: float = 0.1
    level: float = 0.7
    least: int = 5
    seed: int = 11


def _tokens(column: pa.Array) -> Iterator[tuple[Words, np.ndarray]]:
    """Words of whole texts, in lower case, and a number for each word's form."""
    data, offsets = text_buffers(column)
    low, n = 0, len(column)
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1
        high = min(max(high, low + 1), n)
        body = data[offsets[low] : offsets[high]]
        at = offsets[low : high + 1] - offsets[low]
        kind = _KIND[body]
        edge = np.ones(len(body) + 1, dtype=bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[at] = True
        cuts = np.flatnonzero(edge)
        starts, ends = cuts[:-1], cuts[1:]
        full = kind[starts] != _BLANK
        starts, ends = starts[full], ends[full]
        padded = np.zeros(len(body) + 16, dtype=np.uint8)
        padded[: len(body)] = LOWER[body]
        words = Words(low, high, padded, starts, ends, np.searchsorted(starts, at))
        capitals = np.concatenate([[0], np.cumsum((body >= 0x41) & (body <= 0x5A))])
        size, upper = ends - starts, capitals[ends] - capitals[starts]
        form = kind[starts].astype(U64) * U64(8) + np.minimum(upper, 2).astype(U64) * U64(2)
        form += (upper == size).astype(U64)
        signs = kind[starts] == _SIGN
        form[signs] += (np.minimum(size[signs], _LONGEST) * 256 + body[starts[signs]]).astype(U64) * U64(64)
        yield words, form
        low = high


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs, each run by itself; an empty run is 0."""
    out = np.add.reduceat(np.append(values, 0.0), np.minimum(first[:-1], len(values)))
    out[np.diff(first) == 0] = 0
    return out


def terms_of(column: pa.Array, rule: QualityRule) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(terms, values, first)`` for chunks of whole texts in order: text i has ``terms[first[i]:first[i + 1]]``."""
    shift = U64(64 - rule.bits)
    for words, form in _tokens(column):
        own, row = words.hashes(), words.row_of()
        again = np.zeros(len(own), dtype=bool)
        again[1:] = (own[1:] == own[:-1]) & (row[1:] == row[:-1])
        form = mix(np.where(again, U64(1), form + U64(2)))
        place = row.astype(U64) << U64(rule.bits)
        keys = []
        for source, longest, salt in ((own, 2, 1), (form, 3, 101)):
            gram = source
            for size in range(1, longest + 1):
                if size > 1:
                    gram = mix(gram[:-1] * U64(0x9E3779B97F4A7C15) + source[size - 1 :])
                inside = row[size - 1 :] == row[: len(row) - size + 1]
                keys.append((place[: len(gram)] | mix(gram + U64(salt + size)) >> shift)[inside])
        keys, count = np.unique(np.concatenate(keys), return_counts=True)
        first = np.searchsorted(keys, np.arange(words.high - words.low + 1, dtype=U64) << U64(rule.bits))
        # rounded: the last bit of a logarithm may depend on its place in an array
        values = np.round(np.log1p(count), 6)
        values = values / np.repeat(np.sqrt(_sums(values**2, first)), np.diff(first))
        yield (keys & U64((1 << rule.bits) - 1)).astype(np.int64), values, first


def fit(labels: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], rule: QualityRule) -> tuple[float, np.ndarray]:
    """Bias and weights after ``epochs`` rounds, a row at a time in an order the seed fixes."""
    random = np.random.default_rng(rule.seed)
    size = 1 << rule.bits
    sums, squares = np.zeros(size), np.zeros(size)
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias, past = float(np.log(share / (1 - share))), 1.0

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - rule.l1, 0) / ((rule.beta + np.sqrt(n)) / rule.alpha + rule.l2)

    for _ in range(rule.epochs):
        for i in random.permutation(len(labels)):
            terms, values = rows[i]
            z, n = sums[terms], squares[terms]
            w = weights(z, n)
            margin = min(max(bias + float(w @ values), -30.0), 30.0)
            miss = 1 / (1 + np.exp(-margin)) - labels[i]
            step = miss * values
            after = n + step**2
            sums[terms] = z + step - (np.sqrt(after) - np.sqrt(n)) / rule.alpha * w
            squares[terms] = after
            past += miss**2
            bias -= 0.1 * miss / np.sqrt(past)
    return bias, weights(sums, squares)


def fit_level(labels: np.ndarray, rows: list, rule: QualityRule) -> tuple[float, np.ndarray]:
    """``fit`` on seven eighths; the last eighth sets the bias, so that ``level`` parts its labels best.

    Of equally good levels the middle one. With fewer than ``least`` rows of a label there, the bias stays.
    """
    apart = np.arange(len(labels)) % 8 == 7
    bias, weights = fit(labels[~apart], [r for r, a in zip(rows, apart, strict=True) if not a], rule)
    label = labels[apart]
    if min(label.sum(), len(label) - label.sum()) < rule.least:
        return bias, weights
    margin = np.array([weights[t] @ v for (t, v), a in zip(rows, apart, strict=True) if a])
    order = np.argsort(margin, kind="stable")
    margin, label = margin[order], label[order]
    # wrong if the level lies below row i: good rows before it, and poor ones from it on
    wrong = np.concatenate([[0], np.cumsum(label)]) + (len(label) - label.sum()) - np.concatenate([[0], np.cumsum(1 - label)])
    levels = np.concatenate([[margin[0] - 1], (margin[1:] + margin[:-1]) / 2, [margin[-1] + 1]])
    best = levels[wrong == wrong.min()]
    return float(np.log(rule.level / (1 - rule.level)) - best[len(best) // 2]), weights


def _vectors(rule: QualityRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, values = [], []
            for t, v, first in terms_of(batch.column(2), rule):
                for a, b in zip(first[:-1], first[1:], strict=True):
                    terms.append(t[a:b].astype("<i4").tobytes())
                    values.append(v[a:b].astype("<f4").tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(terms, pa.binary()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "terms", "values"])

    return run


def _model(rule: QualityRule):
    """For one task: the model of the sample's rows, which come in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, rows, used = [], [], 0
        for batch in batches:
            for label, terms, values in zip(*(batch.column(i) for i in range(3)), strict=True):
                own = np.frombuffer(terms.as_buffer(), "<i4"), np.frombuffer(values.as_buffer(), "<f4")
                used += len(own[0])
                if used > rule.terms and labels:
                    break
                labels.append(label.as_py())
                rows.append(tuple(x.copy() for x in own))
            if used > rule.terms:
                break
        bias, weights = fit_level(np.array(labels, dtype=float), rows, rule)
        at = np.flatnonzero(weights)
        columns = [pa.array([bias]), pa.array([at.astype("<i4").tobytes()]), pa.array([weights[at].astype("<f4").tobytes()])]
        yield pa.RecordBatch.from_arrays(columns, ["bias", "terms", "weights"])

    return run


def held_out(doc_id) -> F.Column:
    """Rows no model is fitted on: those whose id, as text, has a crc32 of remainder two by four."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rule: QualityRule = QualityRule()) -> tuple[float, np.ndarray]:
    """Bias and weights, fitted in one task on at most ``rule.sample`` documents with ``rule.terms`` terms together.

    They are chosen by a hash of their id. What reaches the driver is the model: at most ``2 ** bits`` weights.
    """
    small_batches(docs.sparkSession)
    marked = labels.where("quality in (0, 1) and doc_id is not null")
    marked = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    order = F.xxhash64("doc_id", F.lit(rule.seed))
    # the bound of the sample is the bound of what is broadcast
    marked = marked.orderBy(order, "doc_id").limit(rule.sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marked), "doc_id")
    schema = "doc_id long, quality int, terms binary, values binary"
    found = texts.select("doc_id", "quality", "text").mapInArrow(_vectors(rule), schema)
    # one text of an id, the same however the rows come; so there are no more rows than the sample has ids
    found = found.groupBy("doc_id").agg(F.min(F.struct("terms", "values", "quality")).alias("row"))
    found = found.select(order.alias("at"), "doc_id", "row.*").repartition(1).sortWithinPartitions("at", "doc_id")
    model = found.select("quality", "terms", "values").mapInArrow(_model(rule), "bias double, terms binary, weights binary")
    row = model.first()
    weights = np.zeros(1 << rule.bits, dtype=np.float32)
    if row is None:
        return 0.0, weights
    weights[np.frombuffer(row.terms, "<i4")] = np.frombuffer(row.weights, "<f4")
    return row.bias, weights


def score(docs: DataFrame, model: tuple[float, np.ndarray], rule: QualityRule, carried: F.Column) -> DataFrame:
    """``carried, score`` (0 to 1) and ``predicted`` (1 from ``rule.level`` on) of column ``text``, a row per input row."""
    bias, weights = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [np.zeros(0)]
            for terms, values, first in terms_of(batch.column(0), rule):
                margins.append(bias + _sums(shared.value[terms] * values, first))
            chance = np.round(1 / (1 + np.exp(-np.clip(np.concatenate(margins), -30, 30))), 12)
            columns = [batch.column(1), pa.array(chance), pa.array((chance >= rule.level).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["carried", "score", "predicted"])

    rows = docs.select("text", carried.alias("carried"))
    schema = StructType().add(rows.schema["carried"]).add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, rule: QualityRule = QualityRule()) -> DataFrame:
    """Every document's quality: ``doc_id, held_out, score, predicted``, a row per input row.

    ``docs`` needs ``doc_id`` (integer) and ``text``, ``labels`` ``doc_id`` and ``quality`` (0 or 1); other
    columns are left out and no input of a score. Held-out rows teach nothing. Every whole text is scored.

    Defined cases: null, empty and blank texts score the model's bias; labels that are null or neither 0 nor 1
    are left out, and of several labels of an id the largest holds; of several texts of an id one teaches; without
    labels every text scores one half; a null ``doc_id`` is not held out. Repeated rows are scored each. An empty
    table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(docs, train(docs, labels, rule), rule, F.col("doc_id")).withColumnRenamed("carried", "doc_id")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
