"""Personal data: overlapping candidate spans, boosted trees on format and context, calibrated selection.

Spans of the four base kinds are found by their formats and checks. Besides, generators that miss little
propose what may be personal data too: numbers with other separators, addresses without a proper domain, keys
and passwords. Boosted trees tell from a candidate's format and surroundings how likely it is
of the kind it looks like. They learn from the corpus itself: candidates that the checks confirm, or that a
word such as ``call`` or ``password`` introduces, are positive; those that fail a check, or that a word such as ``order``
introduces, are not; others teach nothing. The words and checks that decide are no input of the trees, so they know a number
in a format the base has not by the look of those that are introduced. By kind, a threshold that gives
the wanted precision on held-out candidates selects the rest.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.store import small_batches

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts where a run of digits does: a later start in the run would match from its start as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}")
_DOTTED = re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}")
_TOKEN = re.compile(r"[A-Za-z0-9_+/=-]{12,}")
_BEHIND = re.compile(r"[^\s@<>()\",;]{2,}")
_NOT_AROUND = frozenset(" \t\n\r\x0b\x0c@<>()\",;")
# What introduces a candidate of a kind, and what introduces numbers that are no personal data.
_INTRODUCES = [
    re.compile(r"(?:e-?mail|mailto|write to|contact|reach)(?: me| us)?(?: at| via| by)?\W{0,4}$", re.IGNORECASE),
    re.compile(r"(?:\bip|ip.?addr\w*|\bhost|\bserver)(?: at| is)?\W{1,4}$", re.IGNORECASE),
    re.compile(r"(?:\bcard|visa|mastercard|amex|credit|debit)(?: number| no| nr)?\W{1,4}$", re.IGNORECASE),
    re.compile(r"(?:phone|\btel|\bcall|mobile|\bcell|\bfax)(?: me| us)?(?: number| no| nr)?(?: at| on| is)?\W{0,4}$", re.IGNORECASE),
    re.compile(r"(?:password|passwd|pwd|token|secret|api.?key|access.?key)\W{1,4}$", re.IGNORECASE),
]
_OTHERWISE = re.compile(
    r"(?:\border|invoice|\bref|reference|\bid|isbn|issn|version|\bver|page|ticket|batch|serial|build|\bno|\bnr)(?: number| no| nr)?\W{1,4}$|[#$]$",
    re.IGNORECASE,
)
#: Characters before a candidate in which introducing words are looked for.
_BEFORE = 28


@dataclass(frozen=True)
class PiiRule:
    """``sample`` documents at most, and ``each`` labelled candidates of one at most, teach the trees."""

    sample: int = 6000
    each: int = 100
    rounds: int = 30
    depth: int = 3
    rate: float = 0.3
    precision: float = 0.95
    least: int = 30
    seed: int = 11


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(digits: str) -> bool:
    """Whether a number of any length is 255 at most."""
    own = digits.lstrip("0")
    return len(own) < 4 and int(own or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: what may stand before an ``@`` back to the last match, and a domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        # an @ behind this one ends any run that reaches it
        at, done = text.find("@", max(at + 1, done)), max(done, at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the four base kinds, in order."""
    found = [(s, 0, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(_small(p) for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() <= 64 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all that may be personal data, however long; they overlap."""
    found = set()
    for m in _NUMBER.finditer(text):
        found.add((m.start(), 2 if len(_digits(m[0])) >= 12 and m[0][0] not in "+(" else 3, m.end()))
    for m in _DOTTED.finditer(text):
        found.add((m.start(), 1, m.end()))
    at = text.find("@")
    while at >= 0:
        start, behind = at, _BEHIND.match(text, at + 1)
        while start and text[start - 1] not in _NOT_AROUND:
            start -= 1
        if behind and start < at:
            found.add((start, 0, behind.end()))
        at = text.find("@", at + 1)
    for m in _TOKEN.finditer(text):
        if any(c.isdigit() for c in m[0]) and any(not c.isdigit() for c in m[0]):
            found.add((m.start(), 4, m.end()))
    return sorted(found)


class Spans:
    """Spans that may overlap, asked whether one of them touches another one."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = sorted(s for s, _, _ in spans)
        self.ends, far = [], 0
        for _, _, e in sorted(spans):
            far = max(far, e)
            self.ends.append(far)

    def touch(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format of a span and its surroundings; no check digits, and no word that introduces it."""
    start, kind, end = span
    own = text[start:end]
    n = len(own)
    digits = sum("0" <= c <= "9" for c in own)
    upper, lower = sum("A" <= c <= "Z" for c in own), sum("a" <= c <= "z" for c in own)
    groups = [len(g) for g in re.findall(r"[0-9]+", own)]
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(own, own[1:], strict=False))
    counts = [own.count(c) for c in set(own)]
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    before, after = text[start - 1 : start], text[end : end + 1]
    tail = own.rsplit("@", 1)[-1]
    return [
        float(kind), n, digits, upper, lower, n - digits - upper - lower, len(groups),
        max(groups, default=0), min(groups, default=0), turns / n, entropy, len(counts),
        own.count("."), own.count("-"), own.count(" "), float("(" in own), float(own[0] == "+"),
        float(before.isalnum()), float(after.isalnum()), float(before in ("", "\n")), float(after in ("", "\n", ".", ",")),
        float(all(c in "0123456789abcdef" for c in own)), float("." in tail and len(tail) > 3), float(tail[:1].isalnum()),
    ]


def weak_label(text: str, span: tuple[int, int, int], known: dict[int, Spans]) -> int | None:
    """1 if a check confirms the candidate or a word introduces it, 0 if a check or a word speaks against it, else None."""
    start, kind, end = span
    low = max(0, start - _BEFORE)
    if kind in known and known[kind].touch(start, end):
        return 1
    if kind == 4 and text.startswith("AKIA", start) or _INTRODUCES[kind].search(text, low, start):
        return 1
    if kind == 4 or _OTHERWISE.search(text, low, start):
        return 0
    if kind == 1 and any(not _small(p) for p in text[start:end].split(".")):
        return 0
    if kind == 2 and not (12 <= len(d := _digits(text[start:end])) <= 19 and luhn(d)):
        return 0
    return 0 if any(other.touch(start, end) for k, other in known.items() if k != kind) else None


@dataclass
class Trees:
    """Boosted trees of equal depth: feature, cut and leaf of every node, and the threshold of each kind."""

    bias: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)
    threshold: np.ndarray = field(default_factory=lambda: np.full(len(KINDS), math.inf))

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while (at < len(feature)).any():
                at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > cut[at])
            out += leaf[at - len(feature)]
        return out


def grow(x: np.ndarray, slope: np.ndarray, weight: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree that lowers the log loss most, by second-order gains at quantile cuts."""
    nodes = (1 << depth) - 1
    feature, cut, at = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf), np.zeros(len(x), dtype=np.int64)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 33)[:-1])) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]
    for node in range(nodes):
        here = np.flatnonzero(at == node)
        g, h = slope[here], weight[here]
        best, whole = 1e-6, g.sum() ** 2 / (h.sum() + 1)
        for f, c in enumerate(cuts):
            a = np.cumsum(np.bincount(bins[f][here], g, minlength=len(c) + 1))[:-1]
            b = np.cumsum(np.bincount(bins[f][here], h, minlength=len(c) + 1))[:-1]
            gain = a**2 / (b + 1) + (g.sum() - a) ** 2 / (h.sum() - b + 1) - whole
            i = int(np.argmax(gain))
            if gain[i] > best:
                best, feature[node], cut[node] = gain[i], f, c[i]
        at[here] = 2 * node + 1 + (x[here, feature[node]] > cut[node])
    leaf = at - nodes
    g = np.bincount(leaf, slope, minlength=nodes + 1)
    h = np.bincount(leaf, weight, minlength=nodes + 1)
    return feature, cut, -g / (h + 1)


def fit(x: np.ndarray, y: np.ndarray, rule: PiiRule) -> Trees:
    """Trees on four fifths, their threshold on the last; too few of either label select nothing."""
    if min(y.sum(), len(y) - y.sum()) < rule.least:
        return Trees()
    held = np.random.default_rng(rule.seed).random(len(y)) < 0.2
    share = y[~held].mean()
    trees = Trees(bias=float(np.log(share / (1 - share))))
    margin = np.full(int((~held).sum()), trees.bias)
    for _ in range(rule.rounds):
        p = 1 / (1 + np.exp(-margin))
        feature, cut, leaf = grow(x[~held], p - y[~held], p * (1 - p), rule.depth)
        one = Trees(0.0, [feature], [cut], [rule.rate * leaf])
        margin += one.margins(x[~held])
        trees.feature.append(feature)
        trees.cut.append(cut)
        trees.leaf.append(rule.rate * leaf)
    # by kind the lowest margin from which on the held-out candidates reach the precision
    margin, label = trees.margins(x[held]), y[held]
    for kind in range(len(KINDS)):
        here = np.flatnonzero(x[held][:, 0] == kind)
        order = here[np.argsort(-margin[here], kind="stable")]
        right = np.cumsum(label[order]) / np.arange(1, len(order) + 1)
        last = np.append(np.diff(margin[order]) != 0, True)[: len(order)]
        good = np.flatnonzero((right >= rule.precision) & last)
        if len(good) and label[order[: good[-1] + 1]].sum() >= rule.least / 5:
            # halfway to the next candidate below; if there is none, all that is as likely as not
            low, below = margin[order[good[-1]]], margin[order[good[-1] + 1 :]]
            trees.threshold[kind] = float((low + below[0]) / 2 if len(below) else min(low, 0.0))
    return trees


def _may_hold(text: str) -> bool:
    return "@" in text or _HINT.search(text) is not None


_HINT = re.compile(r"[0-9]")


def _by_kind(spans: list[tuple[int, int, int]]) -> dict[int, Spans]:
    return {k: Spans([s for s in spans if s[1] == k]) for k in {s[1] for s in spans}}


def _learn(each: int):
    """Labelled candidates of each text; of a text with very many, those with the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels, keys = [], [], []
            for text in batch.column(1).to_pylist():
                x, y = [], []
                if text and _may_hold(text):
                    known = _by_kind(base_spans(text))
                    labelled = [(c, weak_label(text, c, known)) for c in candidates(text)]
                    labelled = [(c, label) for c, label in labelled if label is not None]
                    if len(labelled) > each:
                        labelled.sort(key=lambda p: (zlib.crc32(repr(p[0]).encode()), p))
                    for c, label in labelled[:each]:
                        x.append(features(text, c))
                        y.append(label)
                rows.append(x)
                labels.append(y)
                keys.append(zlib.crc32((text or "").encode()))
            columns = [batch.column(0), pa.array(keys, pa.int64()), pa.array(rows, pa.list_(pa.list_(pa.float64()))), pa.array(labels, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "x", "y"])

    return run


def train(docs: DataFrame, rule: PiiRule = PiiRule()) -> Trees:
    """Fit on labelled candidates of at most ``rule.sample`` documents, chosen by a hash of their id, and ``rule.each`` of
    each: so many rows reach the driver at most. Of several texts of an id one teaches."""
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id", F.lit(rule.seed)), "doc_id").limit(rule.sample)
    # the bound of the sample is the bound of what is broadcast
    texts = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text")
    found = texts.mapInArrow(_learn(rule.each), "doc_id long, key long, x array<array<double>>, y array<int>").where("size(y) > 0")
    found = found.groupBy("doc_id").agg(F.min(F.struct("key", "x", "y")).alias("row")).select("row.x", "row.y").toPandas()
    if not len(found):
        return Trees()
    x = np.array([row for rows in found["x"] for row in rows], dtype=float)
    y = np.concatenate([np.asarray(v, dtype=float) for v in found["y"]])
    order = np.lexsort((y, *x.T))
    return fit(x[order], y[order], rule)


def select(text: str, known: list[tuple[int, int, int]], trees: Trees) -> list[tuple[int, int, int]]:
    """Candidates over the threshold that touch no span chosen before them, the likeliest first."""
    if not np.isfinite(trees.threshold).any():
        return []
    base = Spans(known)
    free = [c for c in candidates(text) if np.isfinite(trees.threshold[c[1]]) and not base.touch(c[0], c[2])]
    if not free:
        return []
    margin = trees.margins(np.array([features(text, c) for c in free], dtype=float))
    chosen: list[tuple[int, int, int]] = []
    for i in np.argsort(-margin, kind="stable"):
        start, kind, end = free[i]
        if margin[i] < trees.threshold[kind]:
            continue
        # chosen spans do not overlap: only the neighbours can touch
        at = bisect_left(chosen, (start, kind, end))
        if (at == 0 or chosen[at - 1][2] <= start) and (at == len(chosen) or chosen[at][0] >= end):
            insort(chosen, free[i])
    return chosen


SPAN = "kind:string,start:int,end:int,base:boolean"


def find_personal_data(docs: DataFrame, rule: PiiRule = PiiRule()) -> DataFrame:
    """Spans of personal data of every text: ``doc_id`` and ``spans``, an array of kind, start, end, base.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are left out. A row per input row. Offsets
    are code points, the end exclusive; spans go by start, then kind. Base spans are those of the formats
    and checks; spans of different base kinds may overlap. Others are those the trees select.

    Candidates are proposed and judged at any length. Defined cases: null and empty texts have no spans; a corpus with too few
    confirmed or failed candidates adds none to the base; a null ``doc_id`` teaches nothing. An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # plain arrays: workers without the package can read them
    shared = docs.sparkSession.sparkContext.broadcast(vars(train(docs, rule)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        )
        for batch in batches:
            out, trees = [], Trees(**shared.value)
            for text in batch.column(1).to_pylist():
                if not text or not _may_hold(text):
                    out.append([])
                    continue
                known = base_spans(text)
                more = select(text, known, trees)
                spans = sorted([(*s, True) for s in known] + [(*s, False) for s in more])
                out.append([{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    return docs.mapInArrow(run, f"doc_id long, spans array<struct<{SPAN}>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts of base kinds, the hash of the base spans, and all spans as text."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS LONG) AS n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))
