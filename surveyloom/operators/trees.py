"""Regression trees of all cells and targets, grown a level at a time from histograms that merge.

A node's best split needs, per feature and bin, how many rows a node has and the sum of their residuals.
Tasks count these for the rows they hold, Spark adds them up, tasks choose the splits, and a tree's few numbers
come back. Residuals are whole multiples of a small unit, so sums are exact: trees do not depend on how rows are dealt
out, nor on other cells.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units of a standard deviation that residuals are rounded to.
UNITS = 1 << 20
#: Equal steps between a feature's least and greatest value that its bins are made from.
STEPS = 2048
#: Rows of a cell that a level is counted on at once, and bytes of rows that a task collects for that.
COUNT_ROWS = 1 << 14
COUNT_BYTES = 16 << 20
#: Levels above which a row's node is found by its own questions, not by those of all nodes.
ASK_ALL = 4
#: Slots that partial sums are added up in first, so that no task receives an array from every task.
SLOTS = 16

#: A tree: by node the feature it asks for (-1: a leaf), the value below which a row goes left, and the
#: mean of its residuals. Children of node k are 2 k + 1 and 2 k + 2.
Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def empty_tree(depth: int) -> Tree:
    nodes = (2 << depth) - 1
    return np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)


def node_of(tree: Tree, z: np.ndarray, steps: int | None = None) -> np.ndarray:
    """The node that each row comes to, after ``steps`` questions or at its leaf."""
    feature, cut, _ = tree
    node = np.zeros(len(z), dtype=np.int64)
    # takes from flat arrays cost a third of indexing by row and column
    flat, start = np.ascontiguousarray(z).ravel(), np.arange(len(z)) * z.shape[1]
    for _ in range(len(feature).bit_length() - 1 if steps is None else steps):
        f = feature.take(node, mode="clip")
        right = flat.take(start + np.maximum(f, 0), mode="clip") >= cut.take(node, mode="clip")
        node = np.where(f >= 0, 2 * node + 1 + right, node)
    return node


def asked(tree: Tree, columns: np.ndarray, steps: int) -> np.ndarray:
    """``node_of`` after a few steps, for rows that are given a feature after the other: each node's question is put to all rows."""
    feature, cut, _ = tree

    def below(k: int, left: int) -> np.ndarray | int:
        if not left or feature[k] < 0:
            return k
        return np.where(columns[feature[k]] >= cut[k], below(2 * k + 2, left - 1), below(2 * k + 1, left - 1))

    return np.broadcast_to(below(0, steps), columns.shape[1:])


def predict(trees: Sequence[Tree], rate: float, z: np.ndarray) -> np.ndarray:
    out = np.zeros(len(z))
    for tree in trees:
        out += rate * tree[2].take(node_of(tree, z), mode="clip")
    return out


def summed(parts: DataFrame, keys: Sequence[str], array: str) -> DataFrame:
    """Element-wise sums of ``array`` by ``keys``, in two levels."""
    vector = array_to_vector(F.col(array))
    slot = (F.spark_partition_id() % SLOTS).alias("slot")
    first = parts.groupBy(*keys, slot).agg(vector_to_array(Summarizer.sum(vector)).alias(array))
    return first.groupBy(*keys).agg(vector_to_array(Summarizer.sum(vector)).alias(array))


def _rows(total: Mapping[tuple[int, int], np.ndarray], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for (cell, which), values in total.items():
        columns = [pa.array([cell], pa.int32()), pa.array([which], pa.int32()), pa.array([values], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, list(names))


# ------------------------------------------------------------------------------------------ bins


def count_steps(shared, states: Callable) -> Callable:
    """Known values of a cell's features by equal steps between their bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for cell, z, gaps in states(batch):
                plan = shared.value[cell]
                low, high = (plan.low - plan.mean) / plan.sd, (plan.high - plan.mean) / plan.sd
                step = np.clip((z - low) / np.where(high > low, high - low, 1.0) * STEPS, 0, STEPS - 1).astype(np.int64)
                step += np.arange(z.shape[1]) * STEPS
                found = np.bincount(step[~gaps], minlength=z.shape[1] * STEPS).astype(float)
                total[cell, 0] = found + total.get((cell, 0), 0.0)
        yield from _rows(total, ("cell", "one", "counts"))

    return run


def cuts_of(counts: np.ndarray, low: np.ndarray, high: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature the values that part its bins: one bin for each step that occurs, or, if these are
    too many, bins of about equal numbers of rows."""
    out = []
    for own, a, b in zip(counts.reshape(-1, STEPS), low, high, strict=True):
        used = np.flatnonzero(own)
        # between two steps that occur, in the middle of what lies between them
        edges = (used[:-1] + 1 + used[1:]) / 2
        if len(used) > bins:
            upto = np.cumsum(own[used])[:-1] / own.sum() * bins
            edges = edges[np.flatnonzero(np.diff(np.floor(upto), prepend=0.0) > 0)]
        out.append(a + edges / STEPS * (b - a))
    return out


def cut_by_counts(counts, bins: int) -> Callable:
    """In tasks: a cell's cuts from its summed counts. ``counts`` names the cells' bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                plan = counts.value[cell]
                low, high = (plan.low - plan.mean) / plan.sd, (plan.high - plan.mean) / plan.sd
                cuts = cuts_of(np.array(found), low, high, bins)
                columns = [pa.array([cell], pa.int32()), pa.array([[c.tolist() for c in cuts]], pa.list_(pa.list_(pa.float64())))]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "cuts"])

    return run


#: Equal steps between the least and the greatest cut by which a value's bin is looked up.
LOOKUP = 4096


def binner(cuts: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """``np.searchsorted(cuts, values, "right")``, the number of cuts up to a value: looked up by steps, which costs a fourth of halving.

    A step knows the least bin of its values; a few comparisons with the cuts that lie in a step settle the rest.
    """
    if len(cuts) < 4:
        return lambda values: sum((values >= c for c in cuts), np.zeros(len(values), dtype=np.int64))
    low, scale = cuts[0], LOOKUP / (cuts[-1] - cuts[0])
    edges = np.arange(LOOKUP)
    # rounding moves a value by much less than a hundredth of a step
    least = np.searchsorted(cuts, low + (edges - 0.01) / scale, "right")
    most = np.searchsorted(cuts, low + (edges + 1.01) / scale, "right")
    least[0], most[-1] = 0, len(cuts)
    rounds, beyond = int((most - least).max()), np.append(cuts, np.inf)
    if rounds > 4 or not np.isfinite(scale):
        return lambda values: np.searchsorted(cuts, values, "right")

    def run(values: np.ndarray) -> np.ndarray:
        found = least.take(np.clip((values - low) * scale, 0, LOOKUP - 1).astype(np.int64))
        for _ in range(rounds):
            found += values >= beyond.take(found)
        return found

    return run


# ---------------------------------------------------------------------------------------- levels


def packed(here: np.ndarray, values: np.ndarray) -> tuple[np.ndarray | None, float]:
    """A row's ``here`` and value as one number, and the unit of ``here``. Values are whole; None if sums of both do not fit a double's 53 bits."""
    unit = 2.0 ** np.ceil(np.log2(2 * np.abs(values).sum() + 2))
    return (values + unit * here, unit) if len(here) * unit < 1 << 52 else (None, unit)


def counts_and_sums(place: np.ndarray, here: np.ndarray, values: np.ndarray, times: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """By place, how many rows are ``here`` and the sum of their ``values``; each row has ``times`` places, and a value of 0 if it is
    not here. Both are added up as one number if that fits."""
    n, s = _added([place], [size], here, values, times)
    return n, s


def _added(
    places: Sequence[np.ndarray], sizes: Sequence[int], here: np.ndarray, values: np.ndarray, times: int = 1
) -> np.ndarray:
    """Counts and sums by the places of several tables, one table after the other."""
    both, unit = packed(here, values)
    if both is None:
        parts = [[np.bincount(p, np.tile(x, times), size) for p, size in zip(places, sizes, strict=True)] for x in (here, values)]
        return np.stack([np.concatenate(x) for x in parts])
    both = np.tile(both, times) if times > 1 else both
    found = np.concatenate([np.bincount(p, both, size) for p, size in zip(places, sizes, strict=True)])
    n = np.rint(found / unit)
    return np.stack([n, found - n * unit])


def together(sizes: Sequence[int], bins: int) -> list[list[int]]:
    """Features that are counted as one, by their numbers of bins. A row then has one place for all of them, of whose table each one's
    counts are margins; the tables of all are no larger than ``bins`` for each feature."""
    out: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: sizes[f]):
        if out and np.prod([sizes[g] for g in out[-1]]) * sizes[f] <= bins * (len(out[-1]) + 1):
            out[-1].append(f)
        else:
            out.append([f])
    return out


def count_level(shared, states: Callable, grown, block: Mapping[int, Sequence[int]], level: int, rate: float, bins: int) -> Callable:
    """Rows and sums of residuals by node of this level, feature and bin, for the targets of a block.

    ``grown`` holds, by cell and target, the finished trees and the one that grows.
    """
    first, nodes = (1 << level) - 1, 1 << level

    binners: dict[int, list[Callable]] = {}

    def count(cell: int, z: np.ndarray, gaps: np.ndarray, total: dict[tuple[int, int], np.ndarray]) -> None:
        cuts = shared.value[cell].cuts
        if cell not in binners:
            binners[cell] = [binner(c) for c in cuts]
        # a feature after the other; rows a target is not counted for weigh nothing, so no row is copied for a target
        columns = np.ascontiguousarray(z.T)
        known = np.ascontiguousarray(~gaps.T)
        sizes, joint = [], []
        for group in together([len(c) + 1 for c in cuts], bins):
            place, size = np.zeros(len(z), dtype=np.int64), 1
            for f in group:
                place = place * (len(cuts[f]) + 1) + binners[cell][f](columns[f])
                size *= len(cuts[f]) + 1
            joint.append(place)
            sizes.append(size)
        for t in block[cell]:
            done, tree = grown.value[cell, t]
            here, places = known[t], joint
            if level:
                node = (asked(tree, columns, level) if level <= ASK_ALL else node_of(tree, z, level)) - first
                here = here & (node >= 0)
                node = node * here
                places = [place + node * size for place, size in zip(joint, sizes, strict=True)]
            residual = columns[t] - predict(done, rate, z) if done else columns[t]
            values = np.rint(residual * UNITS) * here
            found = _added(places, [size * nodes for size in sizes], here, values)
            if (cell, t) in total:
                total[cell, t] += found
            else:
                total[cell, t] = found

    def margins(cell: int, found: np.ndarray) -> np.ndarray:
        """Counts, then sums, by feature, node and bin."""
        cuts, at = shared.value[cell].cuts, 0
        out = np.zeros((2, len(cuts), nodes, bins))
        for group in together([len(c) + 1 for c in cuts], bins):
            shape = [len(cuts[f]) + 1 for f in group]
            size = nodes * math.prod(shape)
            table = found[:, at : at + size].reshape(2, nodes, *shape)
            for axis, f in enumerate(group):
                others = tuple(2 + i for i in range(len(group)) if i != axis)
                out[:, f, :, : shape[axis]] = table.sum(axis=others)
            at += size
        return out.ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        room = COUNT_BYTES
        for batch in batches:
            for cell, z, gaps in states(batch):
                if not len(block.get(cell, ())):
                    continue
                held.setdefault(cell, []).append((z, gaps))
                room -= z.nbytes
                full = [cell] if sum(len(x) for x, _ in held[cell]) >= COUNT_ROWS else list(held) if room < 0 else []
                for c in full:
                    parts = held.pop(c)
                    room += sum(x.nbytes for x, _ in parts)
                    count(c, *map(np.concatenate, zip(*parts, strict=True)), total)
        for c, parts in held.items():
            count(c, *map(np.concatenate, zip(*parts, strict=True)), total)
        for (cell, t), found in total.items():
            yield from _rows({(cell, t): margins(cell, found)}, ("cell", "target", "sums"))

    return run


SPLITS = (
    "cell int, target int, node int, feature int, bin int, n double, total double, n_left double, total_left double"
)


def choose_splits(level: int, bins: int, least: int) -> Callable:
    """The split of each node that lowers the squares most; of equally good ones the first. -1: none."""
    first, nodes = (1 << level) - 1, 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for cell, target, sums in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                n, s = np.array(sums).reshape(2, -1, nodes, bins)
                for k in range(nodes):
                    whole, total = n[target, k].sum(), s[target, k].sum()
                    if not whole:
                        continue
                    left, left_sum = np.cumsum(n[:, k], axis=1), np.cumsum(s[:, k], axis=1)
                    right, right_sum = whole - left, total - left_sum
                    fits = (left >= least) & (right >= least)
                    fits[target] = False
                    gain = np.full(left.shape, -1.0)
                    gain[fits] = left_sum[fits] ** 2 / left[fits] + right_sum[fits] ** 2 / right[fits] - total**2 / whole
                    f, b = np.unravel_index(gain.argmax(), gain.shape)
                    # a millionth of one row's variance is no gain
                    good = gain[f, b] > 1e-6 * UNITS**2
                    split = (int(f), int(b), left[f, b], left_sum[f, b]) if good else (-1, 0, 0.0, 0.0)
                    out.append((cell, target, first + k, *split[:2], whole, total, *split[2:]))
            if out:
                kinds = [pa.int32()] * 5 + [pa.float64()] * 4
                columns = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SPLITS.split(", ")])

    return run


def grow(tree: Tree, cuts: Sequence[np.ndarray], split) -> None:
    """Put a split row into its tree: the node's mean, its question, and the means of its children."""
    feature, cut, value = tree
    value[split["node"]] = split["total"] / split["n"] / UNITS
    if split["feature"] < 0:
        return
    k, n, s = split["node"], split["n_left"], split["total_left"]
    feature[k], cut[k] = split["feature"], cuts[split["feature"]][split["bin"]]
    value[2 * k + 1] = s / n / UNITS
    value[2 * k + 2] = (split["total"] - s) / (split["n"] - n) / UNITS


def blocks_of(targets: Mapping[int, Sequence[int]], widths: Mapping[int, int], bytes_each: int, most: int) -> list[dict[int, list[int]]]:
    """Targets of all cells in blocks whose arrays a task can hold."""
    out, room = [], 0
    for cell, own in targets.items():
        for t in own:
            size = widths[cell] * bytes_each
            if room < size or not out:
                out.append({})
                room = most
            out[-1].setdefault(cell, []).append(t)
            room -= size
    return out
