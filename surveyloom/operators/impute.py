"""Chained-equation imputation per cell, its missing indicators and its trace.

Cells are independent, so nothing in one of them changes the values of another. A sweep learns, for each
incomplete feature of a cell, a regression on all other features from rows where that feature is
known. What a regression needs is a sum of outer products: tasks add up small matrices of the cells they
hold, Spark sums these, and tasks solve them; only coefficients come back. A step maps all rows with the same gaps alike, so
rows are read once: their sums of outer products by pattern of gaps stand for them in every sweep. After a few sweeps
the standardised features are written anew, so the next ones repeat few steps of
what was before. A lost executor costs a re-read of its splits.

Cells are taken in batches whose matrices fit a task, however many there are; a batch holds whole cells, so
it changes no number. Several batches are parts of one written table, each read alone, and the driver holds what one
of them has learnt.

What is learnt is either a regression on the other features or trees that ask for them (``trees``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.columns import is_number, is_text, numeric
from surveyloom.operators import trees as grown_trees
from surveyloom.operators.availability import filled_counts
from surveyloom.session import drop_table, materialise
from surveyloom.specs import ImputeRule

#: Ranges that distinct values and codes are sorted in when values snap to codes.
RANGES = 200
#: Codes that are sent to tasks as one array (800 kB).
FEW_CODES = 100_000
#: Rows of one cell kept together in the written state, and the bytes their features may take.
STATE_ROWS = 8192
STATE_BYTES = 1 << 18
#: Bytes of rows, and of sums of outer products, that a task holds while it puts rows with the same gaps together.
HELD_BYTES = 32 << 20
#: A reader holds a row group of the state at once and a writer checks sizes by the row, so both are made for rows that large.
STATE_FILES = {
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "4",
    "parquet.page.size.row.check.max": "4",
    "parquet.enable.dictionary": "false",
}


# --------------------------------------------------------------------------- eligibility


def candidates_of(df: DataFrame, rule: ImputeRule) -> list[str]:
    """Columns that may get an indicator or be imputed."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in rule.exclude
        and f.name not in rule.cell
        and not f.name.endswith("_missing")
        and (is_number(f.dataType) or is_text(f.dataType) or isinstance(f.dataType, T.BooleanType))
    ]


def feature_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per cell with, per column, filled, known numbers, min, max, mean and sd."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        v, filled = numeric(df, c), F.count(F.col(f"`{c}`"))
        # every whole number is known; what is counted once keeps the code short enough to be compiled
        known = filled if isinstance(df.schema[c].dataType, (T.IntegralType, T.BooleanType)) else F.count(v)
        aggs += [
            filled.alias(f"{c}|filled"),
            known.alias(f"{c}|known"),
            F.min(v).alias(f"{c}|min"),
            F.max(v).alias(f"{c}|max"),
            F.try_divide(F.sum(v), known).alias(f"{c}|mean"),
            F.stddev_pop(v).alias(f"{c}|sd"),
        ]
    return df.groupBy(*by).agg(*aggs)


def profile_long(profile: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``feature_profile`` with one row per cell and feature."""
    stats = ("filled", "known", "min", "max", "mean", "sd")
    each = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), *[F.col(f"`{c}|{s}`").alias(s) for s in stats])
            for c in columns
        ]
    )
    return profile.select(*by, "n", F.explode(each).alias("p")).select(*by, "n", "p.*")


def eligibility(df: DataFrame, columns: Sequence[str], by: Sequence[str], rule: ImputeRule) -> DataFrame:
    """Per cell and feature: enough known numbers, more than one value, and the two
    decisions, ``eligible`` and ``indicator``. One pass; min < max stands for two values."""
    long = profile_long(feature_profile(df, columns, by), columns, by)
    never = F.col("feature").isin(*rule.never)
    rate = (F.col("n") - F.col("filled")) / F.col("n")
    return long.select(
        *by,
        "feature",
        "n",
        "filled",
        rate.alias("missing_rate"),
        (~never & (F.col("known") >= rule.min_values) & (F.col("min") < F.col("max"))).alias("eligible"),
        ((rate > 0) & ((rate >= rule.indicator_rate) | never)).alias("indicator"),
    ).na.fill({"eligible": False})


def imputation_matrix(df: DataFrame, rule: ImputeRule, cohort: str) -> DataFrame:
    """The features a cohort can be imputed from, as numbers: filled enough and not constant.

    Features the imputation leaves alone are left out, as they are when it runs.
    """
    rows = df.where(F.col(rule.cell[-1]) == cohort)
    columns = candidates_of(df, rule)
    facts = feature_profile(rows, columns, []).first()

    def eligible(c: str) -> bool:
        return c not in rule.never and facts[f"{c}|known"] >= rule.min_values and facts[f"{c}|min"] < facts[f"{c}|max"]

    return rows.select(*[numeric(rows, c).alias(c) for c in columns if eligible(c)])


def missing_rates(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Long null rates per cell and column."""
    return filled_counts(df, columns, by).withColumn("missing_rate", (F.col("n") - F.col("filled")) / F.col("n"))


def missing_indicators(
    df: DataFrame, rule: ImputeRule, present: Mapping[str, Iterable[str]] | None = None
) -> DataFrame:
    """``df`` with ``<feature>_missing`` as 0/1 in the cells where enough is missing, null in the others.

    ``present`` names, per value of the first cell column, the columns that source has: a feature
    it never asked for gets no indicator there. One pass decides; the decisions are joined, a row per cell.
    """
    by, columns = list(rule.cell), candidates_of(df, rule)
    profile = feature_profile(df.where(F.col(by[-1]).isNotNull()), columns, by)
    marks = materialise(profile.select(*by, *_marks(columns, rule, present)), "indicators")
    return _add_indicators(df, marks, by, _wanted(marks, columns))


def _marks(columns: Sequence[str], rule: ImputeRule, present: Mapping[str, Iterable[str]] | None) -> list[Column]:
    out = []
    for i, c in enumerate(columns):
        rate = (F.col("n") - F.col(f"`{c}|filled`")) / F.col("n")
        mark = (rate > 0) & ((rate >= rule.indicator_rate) | F.lit(c in rule.never))
        if present is not None:
            mark &= F.col(rule.cell[0]).isin([s for s, names in present.items() if c in set(names)])
        out.append(F.coalesce(mark, F.lit(False)).alias(f"__m{i}"))
    return out


def _wanted(marks: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Features that get an indicator in any cell, by the name of their mark."""
    any_cell = marks.agg(*[F.max(f"__m{i}").alias(f"__m{i}") for i in range(len(columns))]).first()
    return {f"__m{i}": c for i, c in enumerate(columns) if any_cell[f"__m{i}"]}


def _add_indicators(df: DataFrame, marks: DataFrame, by: Sequence[str], wanted: Mapping[str, str]) -> DataFrame:
    if not wanted:
        return df
    joined = df.join(marks.select(*by, *wanted), list(by), "left").select(*[F.col(f"`{c}`") for c in df.columns], *wanted)
    return joined.withColumns(
        {f"{c}_missing": F.when(F.col(m), F.col(f"`{c}`").isNull().cast("tinyint")) for m, c in wanted.items()}
    ).drop(*wanted)


# ----------------------------------------------------------------------------- code lists


def value_domains(df: DataFrame, columns: Sequence[str], by: Sequence[str], whole: bool = False) -> DataFrame:
    """Distinct values (by..., variable, value) of coded columns. ``whole`` rounds half to even first."""
    return value_counts(df, columns, by, whole).drop("n")


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str], whole: bool = False) -> DataFrame:
    """How often each value (by..., variable, value) occurs. The grouped count combines on the map side, so
    only distinct values are shuffled and no group of values is gathered in one place."""
    value = {c: (F.rint(numeric(df, c)) if whole else numeric(df, c)) for c in columns}
    long = df.select(*by, *[v.alias(c) for c, v in value.items()]).unpivot(list(by), list(value), "variable", "value")
    return long.where(F.col("value").isNotNull()).groupBy(*by, "variable", "value").agg(F.count("*").alias("n"))


def snap_to_codes(df: DataFrame, column: str, codes: DataFrame, value: str = "value") -> DataFrame:
    """Replace each value of ``column`` by the nearest code, the lower one on a tie.

    Up to ``FEW_CODES`` codes are sent to the tasks as one sorted array, in which a value's neighbours are found by halving. More
    are never brought together: distinct values and codes are sorted in ranges; a value's neighbours are the last code
    up to it and the first from it on. The distinct values are joined back: Spark broadcasts them if they are few.
    """
    listed = codes.select(F.col(value).cast("double").alias("v")).where("v is not null").distinct()
    few = listed.limit(FEW_CODES + 1).toPandas()["v"].to_numpy(float)
    if 0 < len(few) <= FEW_CODES:
        return _snap_to_few(df, column, np.sort(few))
    own = df.select(numeric(df, column).alias("v")).where("v is not null").distinct()
    both = own.withColumn("code", F.lit(None).cast("double")).unionByName(listed.withColumn("code", F.col("v")))
    cuts = both.agg(F.percentile_approx("v", [i / RANGES for i in range(1, RANGES)], 10_000)).first()[0]
    places = F.lit(sorted(set(cuts or []))).cast("array<double>")
    ranged = both.withColumn("range", F.size(F.filter(places, lambda cut: cut <= F.col("v"))))
    # at most RANGES rows: the codes next to a range that has none on that side
    ends = ranged.groupBy("range").agg(F.min("code").alias("lo"), F.max("code").alias("hi")).withColumn("one", F.lit(1))
    along = Window.partitionBy("one").orderBy("range")
    ends = ends.select(
        "range",
        F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.min("lo").over(along.rowsBetween(1, Window.unboundedFollowing)).alias("after"),
    )
    inside = Window.partitionBy("range").orderBy("v")
    low = F.last("code", True).over(inside.rangeBetween(Window.unboundedPreceding, 0))
    high = F.first("code", True).over(inside.rangeBetween(0, Window.unboundedFollowing))
    near = ranged.withColumns({"low": low, "high": high}).where("code is null").join(ends, "range")
    near = near.select("v", F.coalesce("low", "before").alias("low"), F.coalesce("high", "after").alias("high"))
    nearer = F.when(F.col("low").isNull(), F.col("high")).when(F.col("high").isNull(), F.col("low"))
    nearer = nearer.otherwise(F.when(F.col("v") - F.col("low") <= F.col("high") - F.col("v"), F.col("low")).otherwise(F.col("high")))
    near = near.select(F.col("v").alias("__code_of"), F.lit(0).alias("__code_salt"), nearer.alias("__snapped"))
    # gaps have no partner; a salt spreads them over the tasks of a shuffle join
    target = numeric(df, column)
    salt = F.when(target.isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(1000)).cast("int")).otherwise(F.lit(0))
    keyed = df.withColumns({"__v": target, "__salt": salt})
    joined = keyed.join(near, (F.col("__v") == F.col("__code_of")) & (F.col("__salt") == F.col("__code_salt")), "left")
    return joined.select(*[F.col("__snapped").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])


def _snap_to_few(df: DataFrame, column: str, codes: np.ndarray) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(codes)

    def nearest(values: pa.Array) -> pa.Array:
        own = values.to_numpy(zero_copy_only=False).astype(float)
        none = np.isnan(own)
        return pa.array(np.where(none, np.nan, _nearest(shared.value, np.where(none, 0.0, own))), mask=none)

    snapped = F.arrow_udf(nearest, T.DoubleType())(numeric(df, column).cast("double"))
    return df.select(*[snapped.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])


# ----------------------------------------------------------------------- start and steps


#: What tasks need to know of a cell: positions of its eligible features, positions within these of
#: the ones with gaps in the order they are imputed, scaling, bounds, and per coded feature the observed codes
#: with the share of rows up to each. A plain namespace, so that tasks can unpickle it anywhere.
CellPlan = SimpleNamespace

#: One step: position of the target within ``active``, and intercept and slopes (0 for itself), or the rate and a list of trees.
Step = tuple[int, float, "np.ndarray | list[grown_trees.Tree]"]


def _draws(keys: np.ndarray, feature: int, seed: int) -> np.ndarray:
    """Uniform numbers from row key, feature and seed: the same wherever the row lies."""
    mask = (1 << 64) - 1
    salt = np.uint64(((feature + 1) * 0x9E3779B97F4A7C15 + seed * 0xBF58476D1CE4E5B9) & mask)
    x = keys.astype(np.uint64) ^ salt
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def start_values(plan: CellPlan, raw: np.ndarray, keys: np.ndarray, seed: int, start: str) -> tuple[np.ndarray, np.ndarray]:
    """Standardised features with gaps at their start values, and the gap mask.

    A coded feature starts at an observed code, drawn as often as it occurs; another at a normal draw around the
    mean, within the observed range.
    """
    x = raw[:, plan.active]
    gaps = np.isnan(x)
    for j in plan.targets:
        rows = np.flatnonzero(gaps[:, j])
        if not len(rows):
            continue
        feature = int(plan.active[j])
        if start == "mean":
            x[rows, j] = plan.mean[j]
        elif j in plan.codes:
            codes, upto = plan.codes[j]
            u = _draws(keys[rows], feature, seed)
            x[rows, j] = codes[np.minimum(np.searchsorted(upto, u, "right"), len(codes) - 1)]
        else:
            u, v = _draws(keys[rows], feature, seed), _draws(keys[rows], feature, seed + 1)
            normal = np.sqrt(-2 * np.log(1 - u)) * np.cos(2 * np.pi * v)
            x[rows, j] = np.clip(plan.mean[j] + plan.sd[j] * normal, plan.low[j], plan.high[j])
    return (x - plan.mean) / plan.sd, gaps


def apply_steps(z: np.ndarray, gaps: np.ndarray, steps: Sequence[Step], one: np.ndarray | None = None) -> None:
    """Update the gaps of targets one after the other, each from the values the
    ones before it left. (Updating all at once need not converge.) ``one`` is what rows have instead of a 1, if they
    stand for others."""
    for t, number, learnt in steps:
        rows = np.flatnonzero(gaps[:, t])
        if not len(rows):
            continue
        if isinstance(learnt, list):
            z[rows, t] = grown_trees.predict(learnt, number, z[rows])
        else:
            z[rows, t] = (number if one is None else number * one[rows]) + z[rows] @ learnt


def _cells(
    cell: pa.Array, key: pa.Array, features: Sequence[pa.Array]
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(cell, row positions, raw features, row keys) of a batch; rows of no cell left out. Features are columns, or one array a row."""
    number = cell.to_numpy(zero_copy_only=False).astype(float)
    known = ~np.isnan(number)
    if len(features) == 1 and pa.types.is_list(features[0].type):
        raw = features[0].flatten().to_numpy(zero_copy_only=False).reshape(len(number), -1)
    else:
        raw = np.column_stack([x.to_numpy(zero_copy_only=False) for x in features]).astype(float)
    keys = key.to_numpy(zero_copy_only=False)
    for c in np.unique(number[known]).astype(int):
        rows = np.flatnonzero(known & (number == c))
        yield int(c), rows, raw[rows], keys[rows]


def _nearest(codes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Nearest of the sorted codes, the lower one on a tie."""
    if len(codes) == 1:
        return np.full(len(values), codes[0])
    high = np.clip(np.searchsorted(codes, values), 1, len(codes) - 1)
    low = high - 1
    return np.where(values - codes[low] <= codes[high] - values, codes[low], codes[high])


# ------------------------------------------------------------------------ passes over a batch

#: Some thousands of a cell's rows, and per target the sum of its imputed values and their number.
STATE = "cell int, rows int, z binary, gaps binary, sums binary"


def _state_rows(width: int) -> int:
    return max(1, min(STATE_ROWS, STATE_BYTES // (8 * width)))


def _state_row(cell: int, z: np.ndarray, gaps: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([cell], pa.int32()), pa.array([len(z)], pa.int32())]
    columns += [pa.array([x.tobytes()], pa.binary()) for x in (z, gaps, sums)]
    return pa.RecordBatch.from_arrays(columns, ["cell", "rows", "z", "gaps", "sums"])


def _states(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    # one row at a time leaves Arrow's memory
    for cell, rows, z, gaps in zip(*(batch.column(i) for i in range(4)), strict=True):
        own = np.frombuffer(z.as_buffer(), np.float64).reshape(rows.as_py(), -1).copy()
        yield cell.as_py(), own, np.frombuffer(gaps.as_buffer(), bool).reshape(len(own), -1)


def _first_state(state, seed: int, start: str) -> Callable:
    """Rows of a cell at their start values, some thousands to a row: as many as their bytes allow."""

    def packed(cell: int, parts: list[tuple[np.ndarray, np.ndarray]], last: bool) -> Iterator[pa.RecordBatch]:
        """Full rows of the state; the rest stays in the parts unless it is the last."""
        z, gaps = map(np.concatenate, zip(*parts, strict=True))
        size = _state_rows(z.shape[1])
        upto = len(z) if last else len(z) // size * size
        parts[:] = [(z[upto:], gaps[upto:])]
        for at in range(0, upto, size):
            yield _state_row(cell, z[at : min(at + size, upto)], gaps[at : min(at + size, upto)], np.zeros(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for cell, _, raw, keys in _cells(batch.column(0), batch.column(1), batch.columns[2:]):
                plan = state.value[cell]
                if len(plan.targets):
                    held.setdefault(cell, []).append(start_values(plan, raw, keys, seed, start))
                    if sum(len(z) for z, _ in held[cell]) >= _state_rows(len(plan.active)):
                        yield from packed(cell, held[cell], False)
        for cell, parts in held.items():
            yield from packed(cell, parts, True)

    return run


#: Rows that stay as they are (with their 1 in front), or what stands for all rows with these gaps.
MOMENTS = "cell int, rows int, z binary, gaps binary, gram array<double>"


def _first_moments(state, seed: int, start: str) -> Callable:
    """Rows of a cell at their start values, put together if they have the same gaps.

    A step is one affine map of all rows with the same gaps. What sweeps ask of these rows, now and after any steps, is the
    sum of the outer products of (1, z), so that sum stands for them. Patterns with fewer rows than (1, z) has
    columns stay rows, so what is written is never more than the rows are.
    """

    def summed(cell: int, parts: list[tuple[np.ndarray, np.ndarray]], grams: dict[tuple[int, bytes], np.ndarray]) -> None:
        """Add rows to the sums of their pattern; the parts keep those of patterns with few rows."""
        full, gaps = map(np.concatenate, zip(*parts, strict=True))
        if not len(full):
            return
        bits = np.packbits(gaps, axis=1)
        words = np.zeros((len(bits), -(-bits.shape[1] // 8) * 8), np.uint8)
        words[:, : bits.shape[1]] = bits
        words = words.view(np.uint64)
        order = np.lexsort(words.T)
        full, gaps, words = full[order], gaps[order], words[order]
        ends = [*(np.flatnonzero((words[1:] != words[:-1]).any(axis=1)) + 1).tolist(), len(full)]
        few, at = np.zeros(len(full), dtype=bool), 0
        for end in ends:
            key, part = (cell, gaps[at].tobytes()), full[at:end]
            have = grams.get(key)
            if have is not None:
                have += part.T @ part
            elif end - at >= full.shape[1]:
                grams[key] = part.T @ part
            else:
                few[at:end] = True
            at = end
        parts[:] = [(full[few], gaps[few])]

    def as_sums(grams: dict[tuple[int, bytes], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (cell, gaps), gram in grams.items():
            yield _moment_row(cell, None, None, gaps, gram.ravel())

    def as_rows(cell: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for full, gaps in parts:
            size = _state_rows(full.shape[1])
            for at in range(0, len(full), size):
                some = full[at : at + size]
                yield _moment_row(cell, len(some), some.tobytes(), gaps[at : at + size].tobytes(), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        grams: dict[tuple[int, bytes], np.ndarray] = {}
        room = HELD_BYTES
        for batch in batches:
            for cell, _, raw, keys in _cells(batch.column(0), batch.column(1), batch.columns[2:]):
                plan = state.value[cell]
                if not len(plan.targets):
                    continue
                z, gaps = start_values(plan, raw, keys, seed, start)
                held.setdefault(cell, []).append((np.column_stack([np.ones(len(z)), z]), gaps))
                room -= z.nbytes
                if room > 0:
                    continue
                for c, parts in held.items():
                    summed(c, parts, grams)
                if sum(g.nbytes for g in grams.values()) > HELD_BYTES:
                    yield from as_sums(grams)
                    grams.clear()
                room = HELD_BYTES - sum(parts[0][0].nbytes for parts in held.values())
                if room < HELD_BYTES // 2:
                    for c, parts in held.items():
                        yield from as_rows(c, parts)
                    held.clear()
                    room = HELD_BYTES
        for cell, parts in held.items():
            summed(cell, parts, grams)
            yield from as_rows(cell, parts)
        yield from as_sums(grams)

    return run


def _moment_row(cell: int, rows: int | None, z: bytes | None, gaps: bytes, gram: np.ndarray | None) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64()))
    columns = [pa.array([v], k) for v, k in zip((cell, rows, z, gaps, gram), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["cell", "rows", "z", "gaps", "gram"])


def _stand_ins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In tasks: for each pattern of gaps as few rows as have its sum of outer products: no more than (1, z) has columns."""
    for batch in batches:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for cell, gaps, gram in zip(*(batch.column(i) for i in range(3)), strict=True):
            values = gram.values.to_numpy()
            side = math.isqrt(len(values))
            size, along = np.linalg.eigh(values.reshape(side, side))
            # what is left out is below the last digit of the sums
            used = size > 1e-17 * size[-1]
            full = np.sqrt(size[used])[:, None] * along.T[used]
            mask = np.frombuffer(gaps.as_buffer(), bool)
            found.setdefault(cell.as_py(), []).append((full, np.broadcast_to(mask, (len(full), len(mask)))))
        for cell, parts in found.items():
            full, gaps = map(np.concatenate, zip(*parts, strict=True))
            size = _state_rows(full.shape[1])
            for at in range(0, len(full), size):
                yield _state_row(cell, full[at : at + size], gaps[at : at + size], np.zeros(0))


def _next_state(state, steps, keep: bool = True) -> Callable:
    """The state after some steps and its sums; without ``keep`` the sums alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, full, gaps in _states(batch):
                # rows of lines have a 1 in front, or what stands for it
                one = full[:, 0] if full.shape[1] > gaps.shape[1] else None
                z = full[:, full.shape[1] - gaps.shape[1] :]
                apply_steps(z, gaps, steps.value.get(cell, ()), one)
                plan = state.value[cell]
                weight = gaps[:, plan.targets] * (1.0 if one is None else one[:, None])
                n = (weight * weight).sum(axis=0)
                total = (weight * z[:, plan.targets]).sum(axis=0) * plan.sd[plan.targets] + n * plan.mean[plan.targets]
                kept = slice(None if keep else 0)
                yield _state_row(cell, full[kept], gaps[kept], np.concatenate([total, n]))

    return run


def _grams(state, steps, block: slice) -> Callable:
    """Sums of outer products per cell: of all rows (-1) and of the rows where a target of
    the block has a gap. Known rows are their difference, so work grows with gaps. Steps are those
    the state has not seen, the sweep's earlier blocks among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for cell, full, gaps in _states(batch):
                apply_steps(full[:, 1:], gaps, steps.value.get(cell, ()), full[:, 0])
                groups = [(-1, full)] + [(int(j), full[gaps[:, j]]) for j in state.value[cell].targets[block]]
                for t, part in groups:
                    gram = part.T @ part
                    have = total.get((cell, t))
                    total[cell, t] = gram if have is None else have + gram
        if total:
            yield pa.RecordBatch.from_pydict(
                {
                    "cell": pa.array([k[0] for k in total], pa.int32()),
                    "target": pa.array([k[1] for k in total], pa.int32()),
                    "gram": pa.array([g.ravel() for g in total.values()], pa.list_(pa.float64())),
                }
            )

    return run


def _solve(ridge: float) -> Callable:
    """The regressions of a cell's targets, from their summed matrices."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        grams = {t: np.array(g) for t, g in zip(rows["target"], rows["gram"], strict=True)}
        side = math.isqrt(len(grams[-1]))
        whole, out = grams.pop(-1).reshape(side, side), []
        for j, gap in grams.items():
            gram = whole - gap.reshape(side, side)
            others = np.array([i for i in range(side) if i != j + 1])
            a = gram[np.ix_(others, others)].copy()
            a[np.arange(1, side - 1), np.arange(1, side - 1)] += ridge * gram[0, 0]
            b = np.linalg.lstsq(a, gram[others, j + 1], rcond=None)[0]
            slopes = np.zeros(side - 1)
            slopes[others[1:] - 1] = b[1:]
            out.append((int(rows["cell"].iloc[0]), int(j), float(b[0]), slopes.tolist()))
        return pd.DataFrame(out, columns=["cell", "target", "intercept", "slopes"])

    return run


# ---------------------------------------------------------------------------- the imputer


class ChainedImputer:
    """Fit and apply chained regressions for all cells of a table."""

    #: Sweeps that a pass repeats on the rows it reads before the state is written anew. Repeating a few regressions
    #: costs less than writing and reading all features; a bound keeps the work of many sweeps in proportion.
    replayed = 5

    def __init__(
        self,
        rule: ImputeRule,
        coded: frozenset[str] = frozenset(),
        label: str | None = None,
        present: Mapping[str, Iterable[str]] | None = None,
    ):
        """``present`` names, per value of the first cell column, the columns that source has:
        a feature it never asked for gets no indicator there."""
        if label and label not in rule.exclude:
            raise ValueError(f"the label {label} must be excluded from imputation")
        self.rule, self.coded, self.present = rule, coded, present
        self.features: list[str] = []
        #: by batch: plans of its cells and, by sweep, their steps
        self.plans: list[dict[int, CellPlan]] = []
        self.history: list[list[dict[int, list[Step]]]] = []
        #: whether the table is to be filled
        self.fill = True
        #: with several batches: their filled rows, written
        self.done: list[DataFrame] = []
        #: with ``log``: sums of imputed values by cell and feature, a written table for each batch and sweep
        self.log: list[DataFrame] = []

    # -- preparation

    def _prepare(self, df: DataFrame) -> None:
        """Write the input with a key per row, number the cells and put them in batches. The written table spares
        every later pass what led to it. Columns that no pass reads are only kept for a table that is filled."""
        rule, by = self.rule, list(self.rule.cell)
        self.columns = candidates_of(df, rule)
        kept = [F.col(f"`{c}`") for c in df.columns if self.fill or c in {*by, *self.columns}]
        # the rule names what identifies a row; else its values do, so that rows alike draw alike wherever they lie
        key = F.xxhash64(*(rule.row_key or (*by, *[numeric(df, c) for c in sorted(self.columns)])))
        self.table = materialise(df.select(*kept, key.alias("__key")), "impute")
        profile = feature_profile(self.table.where(F.col(by[-1]).isNotNull()), self.columns, by)
        able, open_ = {}, {}
        for i, c in enumerate(self.columns):
            known = F.col(f"`{c}|known`")
            enough = (known >= rule.min_values) & (F.col(f"`{c}|min`") < F.col(f"`{c}|max`")) & F.lit(c not in rule.never)
            able[i] = F.coalesce(enough, F.lit(False))
            open_[i] = able[i] & (known < F.col("n"))
        width = reduce(lambda a, b: a + b, [a.cast("int") for a in able.values()], F.lit(1))
        targets = reduce(lambda a, b: a + b, [o.cast("int") for o in open_.values()], F.lit(1))
        order = Window.partitionBy("__one").orderBy(*by)
        spent = F.sum("__cost").over(order.rowsBetween(Window.unboundedPreceding, -1))
        # a row per cell; whole cells make a batch whose matrices fit a task
        profile = profile.withColumns({"__cost": (targets * width * width * 8).cast("long"), "__one": F.lit(1)}).withColumns(
            {
                "__cell": F.row_number().over(order) - 1,
                "__batch": F.floor(F.coalesce(spent, F.lit(0)) / rule.gram_bytes).cast("int"),
                **{f"__able{i}": a for i, a in able.items()},
                **{f"__open{i}": o for i, o in open_.items()},
            }
        )
        marks = _marks(self.columns, rule, self.present)
        self.profile = materialise(profile.select("*", *marks).drop("__cost", "__one"), "impute-cells")
        self.cells = self.profile.select(*by, "__cell", "__batch")
        self.wanted = _wanted(self.profile, self.columns)
        any_cell = self.profile.agg(*[F.max(f"__{k}{i}").alias(f"{k}{i}") for i in able for k in ("able", "open")]).first()
        self.features = [c for i, c in enumerate(self.columns) if any_cell[f"able{i}"]]
        self.gaps = [c for i, c in enumerate(self.columns) if any_cell[f"open{i}"]]
        self.batches = [r["__batch"] for r in self.cells.select("__batch").distinct().orderBy("__batch").collect()]
        self.keyed = self.table.join(self.cells, by, "left").select(*kept, "__key", "__cell", "__batch")
        if len(self.batches) > 1:
            # a batch then reads its own rows alone
            self.keyed = materialise(self.keyed.hint("rebalance", "__batch"), "impute-batches", "__batch")
            drop_table(self.table)

    def _inputs(self, df: DataFrame) -> list[Column]:
        return [numeric(df, c).alias(f"__x{i}") for i, c in enumerate(self.features)]

    def _plan(self, batch: int) -> dict[int, CellPlan]:
        """What tasks need to know of the cells of a batch."""
        place = {c: i for i, c in enumerate(self.features)}
        rows = self.keyed.where(F.col("__batch") == batch)
        codes: dict[tuple[int, str], list[tuple[float, int]]] = {}
        listed = [c for c in self.gaps if c in self.coded]
        if listed:
            for r in value_counts(rows, listed, ["__cell"]).collect():
                codes.setdefault((r["__cell"], r["variable"]), []).append((r["value"], r["n"]))
        plans = {}
        for r in self.profile.where(F.col("__batch") == batch).collect():
            number = {c: i for i, c in enumerate(self.columns)}
            names = [c for c in self.features if r[f"__able{number[c]}"]]
            sd = np.array([r[f"{c}|sd"] or 0.0 for c in names])
            targets = [j for j, c in enumerate(names) if r[f"__open{number[c]}"]]
            # fewest gaps first, so that early regressions lean on known values
            targets.sort(key=lambda j: (r["n"] - r[f"{names[j]}|known"], place[names[j]]))
            own = {}
            for j in targets:
                if found := sorted(codes.get((r["__cell"], names[j]), [])):
                    value, n = np.array(found).T
                    own[j] = (value, np.cumsum(n) / n.sum())
            plans[r["__cell"]] = CellPlan(
                active=np.array([place[c] for c in names], dtype=int),
                targets=np.array(targets, dtype=int),
                mean=np.array([r[f"{c}|mean"] for c in names], dtype=float),
                sd=np.where(sd > 0, sd, 1.0),
                low=np.array([r[f"{c}|min"] for c in names], dtype=float),
                high=np.array([r[f"{c}|max"] for c in names], dtype=float),
                codes=own,
            )
        return plans

    # -- fitting

    def fit(self, df: DataFrame, log: bool = False, fill: bool = True) -> ChainedImputer:
        """Learn all sweeps. ``log`` writes what ``trace`` needs; without ``fill`` there is no ``transform``."""
        self.fill = fill
        self._prepare(df)
        for k, batch in enumerate(self.batches):
            plans = self._plan(batch)
            history = self._fit(batch, plans, log) if any(len(p.targets) for p in plans.values()) else []
            if len(self.batches) == 1:
                self.plans, self.history = [plans], [history]
            elif fill:
                self.done.append(materialise(self._filled(self._rows(k), plans, history), "impute-filled"))
        return self

    def _fit(self, batch: int, plans: dict[int, CellPlan], log: bool) -> list[dict[int, list[Step]]]:
        """The steps of each sweep of a batch: passes over the written features, and now and then one that writes the next ones."""
        rule, spark = self.rule, self.keyed.sparkSession
        rows = self.keyed.where(F.col("__batch") == batch)
        # one array costs two thirds of as many columns on the way to Python
        features = F.array(*[F.coalesce(x, F.lit(float("nan"))) for x in self._inputs(self.keyed)])
        rows = rows.select("__cell", "__key", features.alias("__x"))
        shared = spark.sparkContext.broadcast(plans)
        state = self._start(rows, shared)
        if self._learn_scales(state, plans):
            shared = spark.sparkContext.broadcast(plans)
        history, pending = [], {}
        for sweep in range(rule.sweeps):
            steps = self._sweep(state, shared, plans, pending)
            history.append(steps)
            pending = {cell: [*pending.get(cell, ()), *own] for cell, own in steps.items()}
            last = sweep + 1 == rule.sweeps
            if log or (not last and (sweep + 1) % self.replayed == 0):
                shared_steps, pending = spark.sparkContext.broadcast(pending), {}
                after = state.mapInArrow(_next_state(shared, shared_steps, keep=not last), STATE)
                if not last:
                    after = materialise(after, "impute-state", **STATE_FILES)
                    drop_table(state)
                    state = after
            if log:
                # of what the last sweep leaves only the sums are asked for
                sums = after.select("cell", "sums").mapInArrow(_logged(shared, tuple(self.features), sweep + 1), TRACE)
                self.log.append(materialise(sums, "impute-log"))
        drop_table(state)
        return history

    def _start(self, rows: DataFrame, shared) -> DataFrame:
        """The written state that sweeps begin with: here rows that stand for all those with the same gaps."""
        parts = rows.mapInArrow(_first_moments(shared, self.rule.seed, self.rule.start), MOMENTS)
        moments = materialise(parts, "impute-moments", **STATE_FILES)
        whole = grown_trees.summed(moments.where("gram IS NOT NULL"), ["cell", "gaps"], "gram").mapInArrow(_stand_ins, STATE)
        single = moments.where("gram IS NULL").select("cell", "rows", "z", "gaps", F.lit(b"").alias("sums"))
        state = materialise(whole.unionByName(single), "impute-state", **STATE_FILES)
        drop_table(moments)
        return state

    def _learn_scales(self, state: DataFrame, plans: dict[int, CellPlan]) -> bool:
        """What a learner needs of the start values; True if it changed the plans."""
        return False

    def _sweep(
        self, state: DataFrame, shared, plans: dict[int, CellPlan], pending: dict[int, list[Step]]
    ) -> dict[int, list[Step]]:
        """The steps of a sweep, block by block: each block is fitted on what the ones before it leave. ``pending`` are the
        steps of earlier sweeps that the state has not seen."""
        rule, spark = self.rule, state.sparkSession
        most = max(len(p.targets) for p in plans.values())
        size = rule.block_size or most
        steps: dict[int, list[Step]] = {}
        for at in range(0, most, size):
            before = spark.sparkContext.broadcast({cell: [*pending.get(cell, ()), *steps.get(cell, ())] for cell in plans})
            block = slice(at, at + size)
            parts = state.mapInArrow(_grams(shared, before, block), "cell int, target int, gram array<double>")
            # two levels, so that no task receives a matrix from every task
            summed = grown_trees.summed(parts, ["cell", "target"], "gram")
            solved = summed.groupBy("cell").applyInPandas(
                _solve(rule.ridge), "cell int, target int, intercept double, slopes array<double>"
            )
            found = {(r["cell"], r["target"]): (r["target"], r["intercept"], np.array(r["slopes"])) for r in solved.collect()}
            steps = {k: list(v) for k, v in steps.items()}
            for cell, plan in plans.items():
                steps.setdefault(cell, []).extend(found[cell, int(j)] for j in plan.targets[block])
        return steps

    # -- applying

    def transform(self) -> DataFrame:
        """The table with gaps of eligible features filled and the missing indicators added.

        Known values pass unchanged. A coded feature takes the nearest observed code. Only features go through
        Arrow, and only their filled values come back.
        """
        if not self.fill:
            raise ValueError("fitted without filling")
        parts = self.done or [self._filled(self._rows(k), p, h) for k, (p, h) in enumerate(zip(self.plans, self.history, strict=True))]
        df = reduce(DataFrame.unionByName, parts) if parts else self._marked(self.keyed)
        return df.drop("__key", "__cell", "__batch")

    def _marked(self, rows: DataFrame) -> DataFrame:
        return _add_indicators(rows, self.profile, list(self.rule.cell), self.wanted)

    def _rows(self, k: int) -> DataFrame:
        """Rows of the k-th batch with their indicators; rows of no cell go with the first."""
        here = F.col("__batch") == self.batches[k]
        return self._marked(self.keyed.where(here | F.col("__batch").isNull() if k == 0 else here))

    def _filled(self, rows: DataFrame, plans: dict[int, CellPlan], history: list[dict[int, list[Step]]]) -> DataFrame:
        if not self.gaps:
            return rows
        state = rows.sparkSession.sparkContext.broadcast((plans, history))
        places = [self.features.index(c) for c in self.gaps]
        filled = _fill(state, places, self.rule.seed, self.rule.start)
        fill = F.arrow_udf(filled, T.StructType([T.StructField(f"x{i}", T.DoubleType()) for i in range(len(places))]))
        done = rows.withColumn("__filled", fill("__cell", "__key", *self._inputs(rows)))
        return done.select(*[self._back(rows, c) for c in rows.columns])

    def _back(self, rows: DataFrame, c: str) -> Column:
        if c not in self.gaps:
            return F.col(f"`{c}`")
        kind = rows.schema[c].dataType
        whole = c in self.coded and isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        return F.col(f"__filled.x{self.gaps.index(c)}").cast(kind if whole else "double").alias(c)

    def trace(self) -> DataFrame:
        """Mean of the imputed values per cell, feature and sweep, with the number of gaps and
        the standard deviation of the known values, from the sums written while the sweeps ran."""
        by = list(self.rule.cell)
        if not self.log:
            raise ValueError("nothing was imputed, or without a log, so there is no trace")
        keys = ["__cell", "feature", "iteration", "sd_obs", "position"]
        # rows that stand for others count as parts of them
        n = F.rint(F.sum("n"))
        sums = reduce(DataFrame.unionByName, self.log).groupBy(*keys).agg(
            (F.sum("total") / n).alias("mean_imputed"), n.cast("bigint").alias("n_missing")
        )
        return sums.join(self.cells, "__cell").select(
            *by, "feature", "iteration", "mean_imputed", "n_missing", "sd_obs", "position"
        )


TRACE = "__cell int, feature string, iteration int, sd_obs double, position int, total double, n double"


def _fill(state, places: Sequence[int], seed: int, start: str) -> Callable:
    """Repeat all steps on the rows of a batch; the values of the features with gaps, filled."""

    def run(*columns: pa.Array) -> pa.Array:
        plans, history = state.value
        cell, key, features = columns[0], columns[1], columns[2:]
        values = {f: features[f].to_numpy(zero_copy_only=False).astype(float) for f in places}
        for c, rows, raw, keys in _cells(cell, key, features):
            plan = plans[c]
            if not len(plan.targets):
                continue
            z, gaps = start_values(plan, raw, keys, seed, start)
            for steps in history:
                apply_steps(z, gaps, steps.get(c, ()))
            for j in plan.targets:
                at = np.flatnonzero(gaps[:, j])
                new = z[at, j] * plan.sd[j] + plan.mean[j]
                if j in plan.codes:
                    new = _nearest(plan.codes[j][0], new)
                values[int(plan.active[j])][rows[at]] = new
        arrays = [pa.array(values[f], pa.float64(), from_pandas=True) for f in places]
        return pa.StructArray.from_arrays(arrays, names=[f"x{i}" for i in range(len(places))])

    return run


def _logged(state, names: Sequence[str], sweep: int) -> Callable:
    """Per cell and feature the sum and number of imputed values that a sweep left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[cell] = np.frombuffer(sums, np.float64) + found.get(cell, 0.0)
        out = []
        for cell, sums in found.items():
            plan = state.value[cell]
            for j, total, n in zip(plan.targets, *sums.reshape(2, -1), strict=True):
                if n:
                    out.append((cell, names[plan.active[j]], sweep, float(plan.sd[j]), int(j), float(total), float(n)))
        if out:
            kinds = (pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.float64())
            columns = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in TRACE.split(", ")])

    return run


def impute_linear(
    df: DataFrame,
    rule: ImputeRule,
    coded: frozenset[str] = frozenset(),
    label: str | None = None,
    present: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Chained ridge regressions, all cells in the same passes."""
    return ChainedImputer(rule, coded, label, present).fit(df).transform()


# -------------------------------------------------------------------------- tree regression


class TreeImputer(ChainedImputer):
    """The same chain with boosted regression trees, which each cell learns from its own rows.

    The trees of all cells and targets grow a level in one pass over the written features; ``trees`` of them, each of
    ``depth`` levels, are ``trees * depth`` passes a sweep, more if their histograms do not fit ``rule.gram_bytes``.
    """

    # trees take many passes a sweep, so each sweep is written
    replayed = 1

    def _start(self, rows: DataFrame, shared) -> DataFrame:
        first = rows.mapInArrow(_first_state(shared, self.rule.seed, self.rule.start), STATE)
        return materialise(first, "impute-state", **STATE_FILES)

    def __init__(self, *args, trees: int = 10, depth: int = 5, rate: float | None = None, **kwargs):
        """``rate`` is how much of a tree's answer is taken before the next one; None: all of it if there is one tree alone."""
        super().__init__(*args, **kwargs)
        self.trees, self.depth = trees, depth
        self.rate = rate if rate is not None else (1.0 if trees == 1 else 0.5)

    def _learn_scales(self, state: DataFrame, plans: dict[int, CellPlan]) -> bool:
        shared = state.sparkSession.sparkContext.broadcast(plans)
        counts = state.mapInArrow(grown_trees.count_steps(shared, _states), "cell int, one int, counts array<double>")
        counts = grown_trees.summed(counts, ["cell"], "counts")
        cuts = counts.mapInArrow(grown_trees.cut_by_counts(shared, self.rule.bins), "cell int, cuts array<array<double>>")
        for r in cuts.collect():
            plans[r["cell"]].cuts = [np.array(c, dtype=float) for c in r["cuts"]]
        return True

    def _sweep(
        self, state: DataFrame, shared, plans: dict[int, CellPlan], pending: dict[int, list[Step]]
    ) -> dict[int, list[Step]]:
        rule, spark = self.rule, state.sparkSession
        targets = {cell: [int(j) for j in plan.targets] for cell, plan in plans.items() if len(plan.targets)}
        done: dict[tuple[int, int], list[grown_trees.Tree]] = {(c, t): [] for c, own in targets.items() for t in own}
        widths = {cell: len(plans[cell].active) for cell in targets}
        for _ in range(self.trees):
            tree = {key: grown_trees.empty_tree(self.depth) for key in done}
            growing = targets
            for level in range(self.depth):
                grown = spark.sparkContext.broadcast({key: (done[key], tree[key]) for key in done})
                still: dict[int, list[int]] = {}
                for block in grown_trees.blocks_of(growing, widths, 16 * rule.bins << level, rule.gram_bytes):
                    count = grown_trees.count_level(shared, _states, grown, block, level, self.rate, rule.bins)
                    sums = grown_trees.summed(state.mapInArrow(count, "cell int, target int, sums array<double>"), ["cell", "target"], "sums")
                    splits = sums.mapInArrow(grown_trees.choose_splits(level, rule.bins, rule.min_leaf), grown_trees.SPLITS)
                    for r in splits.collect():
                        grown_trees.grow(tree[r["cell"], r["target"]], plans[r["cell"]].cuts, r)
                        if r["feature"] >= 0 and r["target"] not in still.setdefault(r["cell"], []):
                            still[r["cell"]].append(r["target"])
                growing = {cell: sorted(own) for cell, own in sorted(still.items()) if own}
                if not growing:
                    break
            for key, own in tree.items():
                done[key].append(own)
        return {cell: [(t, self.rate, done[cell, t]) for t in own] for cell, own in targets.items()}


def impute_tree(
    df: DataFrame,
    rule: ImputeRule,
    coded: frozenset[str] = frozenset(),
    label: str | None = None,
    present: Mapping[str, Iterable[str]] | None = None,
    trees: int = 10,
    depth: int = 5,
) -> DataFrame:
    """Chained boosted trees, all cells in the same passes: for features that are not near to linear in others."""
    return TreeImputer(rule, coded, label, present, trees=trees, depth=depth).fit(df).transform()
