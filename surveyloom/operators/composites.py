"""Row-wise composites and the wealth index."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.columns import double, number, numeric, rewrite
from surveyloom.session import join_small
from surveyloom.specs import Composites


# Row-wise composites take and give SQL text of numbers.


def row_sum(values: Sequence[str]) -> str:
    """Sum of the known values, null if none is known."""
    total = " + ".join(f"coalesce({v}, 0D)" for v in values)
    return f"CASE WHEN coalesce({', '.join(values)}) IS NOT NULL THEN {total} END"


def row_count_of(values: Sequence[str], code: float = 1.0) -> str:
    """How many equal ``code``, null if none is known."""
    hits = " + ".join(f"CASE WHEN {v} = {double(code)} THEN 1D ELSE 0D END" for v in values)
    return f"CASE WHEN coalesce({', '.join(values)}) IS NOT NULL THEN {hits} END"


def at_least(value: str, threshold: float) -> str:
    """1 from the threshold on, 0 below, null if unknown."""
    return f"CAST({value} >= {double(threshold)} AS BIGINT)"


def all_equal(values: Sequence[str], code: float = 1.0) -> str:
    """1 if all equal ``code``, else 0; an unknown value is not equal, so never null."""
    return f"CAST({' AND '.join(f'({v}) <=> {double(code)}' for v in values)} AS BIGINT)"


def _shifted(p: tuple, centre: np.ndarray) -> tuple:
    """The same partial moments about another centre."""
    n, old, both, sums, products = p
    d = np.where(np.diag(both) > 0, old - centre, 0.0)
    moved = products + d[:, None] * sums.T + d[None, :] * sums + both * np.outer(d, d)
    return n, centre, both, sums + both * d[:, None], moved


def _merged(parts: Iterable[tuple]) -> tuple:
    """Partial moments of all rows of several; about the mean of their centres, so that no digits are lost."""
    parts = list(parts)
    known = np.array([np.diag(p[2]) for p in parts])
    centres = np.array([p[1] for p in parts])
    total = known.sum(axis=0)
    far = np.where(known > 0, centres, np.inf).min(axis=0)
    far = np.where(np.isfinite(far), far, 0.0)
    centre = far + np.where(known > 0, known * (centres - far), 0.0).sum(axis=0) / np.maximum(total, 1)
    moved = [_shifted(p, centre) for p in parts]
    return (sum(p[0] for p in parts), centre, *(sum(p[i] for p in moved) for i in (2, 3, 4)))


def _of_rows(x: np.ndarray) -> tuple:
    """Of a block of rows: their number, a centre, and by pair of columns the rows that know both, the sum of the first one's
    distances from the centre over these, and the sum of the products of both distances."""
    known = ~np.isnan(x)
    n = known.sum(axis=0)
    low = np.where(n > 0, np.where(known, x, np.inf).min(axis=0, initial=np.inf), 0.0)
    centre = low + np.where(known, x - low, 0.0).sum(axis=0) / np.maximum(n, 1)
    off, mask = np.where(known, x - centre, 0.0), known.astype(float)
    return len(x), centre, mask.T @ mask, off.T @ mask, off.T @ off


def _packed(p: tuple) -> bytes:
    return np.concatenate([[float(p[0])], *(x.ravel() for x in p[1:])]).tobytes()


def _unpacked(body: bytes, k: int) -> tuple:
    values = np.frombuffer(body, np.float64)
    n, centre, rest = int(values[0]), values[1 : k + 1], values[k + 1 :].reshape(3, k, k)
    return n, centre, *rest


def _count(by: int, k: int):
    """Partial moments of a task's rows, by the first ``by`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, tuple] = {}
        for batch in batches:
            code = np.zeros(batch.num_rows, dtype=np.int64)
            for i in range(by):
                own = batch.column(i).dictionary_encode(null_encoding="encode")
                code = code * len(own.dictionary) + own.indices.to_numpy()
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[by:]]).astype(float)
            for c in np.unique(code):
                rows = np.flatnonzero(code == c)
                key = tuple(batch.column(i)[int(rows[0])].as_py() for i in range(by))
                part = _of_rows(x[rows])
                total[key] = _merged([total[key], part]) if key in total else part
        if total:
            keys = [pa.array([key[i] for key in total], batch.schema.field(i).type) for i in range(by)]
            body = pa.array([_packed(p) for p in total.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([*keys, body], [*batch.schema.names[:by], "part"])

    return run


def _add_up(by: int, k: int):
    """A list of partial moments as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[_unpacked(b, k) for b in parts] for parts in batch.column(by).to_pylist()]
            body = pa.array([_packed(_merged(parts)) for parts in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:by], body], [*batch.schema.names[:by], "part"])

    return run


def _in_columns(by: int, columns: Sequence[str]):
    """Means and covariances from partial moments; unknown means null."""
    k = len(columns)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in batch.column(by).to_pylist():
                p = _unpacked(body, k)
                known = np.diag(p[2])
                mean = p[1] + np.diag(p[3]) / np.maximum(known, 1)
                products = _shifted(p, mean)[4]
                means = [float(m) if n else None for m, n in zip(mean, known, strict=True)]
                rows.append([p[0], *means, *(float(products[i, j]) / p[0] for i, j in pairs)])
            kinds = [pa.int64(), *[pa.float64()] * (k + len(pairs))]
            found = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            names = ["n", *[f"mean_{c}" for c in columns], *[f"cov_{columns[i]}__{columns[j]}" for i, j in pairs]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:by], *found], [*batch.schema.names[:by], *names])

    return run


def cross_moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per group the covariances of the columns about their means, nulls set to the mean.

    One pass: a task keeps its rows' moments about a centre of its own, and what tasks found is moved to a common centre
    and added up, in two levels, so sums are exact for any scale and a task receives few of them. Columns: n,
    mean_<a> and cov_<a>__<b>.
    """
    k, columns = len(columns), list(columns)
    values = df.select(*by, *[numeric(df, c).cast("double").alias(c) for c in columns])
    keys = T.StructType(values.schema.fields[: len(by)])
    one = T.StructType([*keys.fields, T.StructField("part", T.BinaryType())])
    parts = values.mapInArrow(_count(len(by), k), one)
    for extra in ([(F.spark_partition_id() % 64).alias("slot")], []):
        lists = parts.groupBy(*by, *extra).agg(F.collect_list("part").alias("parts"))
        parts = lists.select(*by, "parts").where("size(parts) > 0").mapInArrow(_add_up(len(by), k), one)
    numbers = [T.StructField("n", T.LongType())]
    numbers += [T.StructField(f"mean_{c}", T.DoubleType()) for c in columns]
    numbers += [T.StructField(f"cov_{a}__{b}", T.DoubleType()) for i, a in enumerate(columns) for b in columns[i:]]
    return parts.mapInArrow(_in_columns(len(by), columns), T.StructType([*keys.fields, *numbers]))


def index_weights(moments: DataFrame, columns: Sequence[str], by: Sequence[str], orient: str) -> DataFrame:
    """First principal component per group, as one slope per column.

    ``moments`` has one row per group, so the eigenproblem is as small as the column list
    and runs in tasks. A constant or wholly unknown column gets slope 0. The sign makes the
    index grow with the sum of raw codes, or fall with it (``orient="ownership"``, for
    1 = owns and 2 = does not).
    """
    k, columns, by = len(columns), list(columns), list(by)
    keys = moments.select(*by).schema

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for record in batch.to_dict("records"):
                cov = np.zeros((k, k))
                for i, a in enumerate(columns):
                    for j in range(i, k):
                        value = record[f"cov_{a}__{columns[j]}"]
                        cov[i, j] = cov[j, i] = 0.0 if pd.isna(value) else value
                sd = np.sqrt(np.diag(cov))
                mean = np.array([float(record[f"mean_{c}"]) for c in columns])
                live = sd > 1e-12 * np.maximum(1.0, np.abs(np.nan_to_num(mean)))
                slope = np.zeros(k)
                if live.any():
                    scale = sd[live]
                    corr = cov[np.ix_(live, live)] / np.outer(scale, scale)
                    vector = np.linalg.eigh(corr)[1][:, -1]
                    with_sum = vector @ corr @ scale
                    # tie: make the largest loading positive, so that the sign is fixed
                    lead = with_sum if abs(with_sum) > 1e-12 else vector[np.argmax(np.abs(vector))]
                    vector = -vector if lead < 0 else vector
                    slope[live] = (vector if orient == "code_sum" else -vector) / scale
                rows.append(
                    {**{c: record[c] for c in by}, "centre": np.nan_to_num(mean).tolist(), "slope": slope.tolist()}
                )
            yield pd.DataFrame(rows, columns=[*by, "centre", "slope"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys), "centre array<double>", "slope array<double>"])
    return moments.mapInPandas(solve, schema)


def wealth_weights(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), orient: str = "code_sum"
) -> DataFrame:
    """Centre and slope of every column per group, from one pass over these columns only."""
    return index_weights(cross_moments(df, columns, by), columns, by, orient)


def wealth_score(
    df: DataFrame, weights: DataFrame, columns: Sequence[str], output: str, by: Sequence[str] = ()
) -> DataFrame:
    """The index of each row; a null counts as the mean, a group without weights gets null."""
    if by:
        named = weights.withColumnsRenamed({"centre": "__centre", "slope": "__slope"})
        joined = join_small(df, named, on=list(by), how="left")
    else:
        row = weights.first()
        found = {n: F.lit(list(row[n]) if row else None).cast("array<double>") for n in ("centre", "slope")}
        joined = df.withColumns({f"__{n}": column for n, column in found.items()})
    score = reduce(
        add,
        [
            F.coalesce(numeric(df, c) - F.col("__centre")[i], F.lit(0.0)) * F.col("__slope")[i]
            for i, c in enumerate(columns)
        ],
    )
    known = F.when(F.col("__slope").isNotNull(), score)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != output], known.alias(output))


def wealth_index(
    df: DataFrame,
    columns: Sequence[str],
    output: str = "wealth_index",
    by: Sequence[str] = (),
    orient: str = "code_sum",
) -> DataFrame:
    """First principal component of the standardised columns, per group.

    Nulls count as the column mean. Needs three columns; with fewer the frame is unchanged.
    """
    columns = [c for c in columns if c in df.columns]
    if len(columns) < 3:
        return df
    return wealth_score(df, wealth_weights(df, columns, by, orient), columns, output, by)


def asset_columns(df: DataFrame, names: Sequence[str], spec: Composites) -> list[str]:
    return [c for c in names if c.startswith(spec.asset_prefix) and c in df.columns]


def add_row_composites(df: DataFrame, names: Sequence[str], spec: Composites) -> DataFrame:
    """The composites that need one row only, if their inputs exist; ``names`` are the
    dictionary's standard names."""

    def named(prefix: str) -> list[str]:
        return [c for c in names if c.startswith(prefix) and c in df.columns]

    def values(columns: Sequence[str]) -> list[str]:
        return [number(df, c) for c in columns]

    _, visits, food, tablets, vaccines = spec.outputs
    inputs = {
        visits: named(spec.visit_prefix),
        food: named(spec.food_prefix),
        vaccines: [c for c in named(spec.vaccine_prefix) if c not in spec.vaccine_not],
    }
    added: dict[str, str] = {}
    if inputs[visits]:
        added[visits] = row_sum(values(inputs[visits]))
    if inputs[food]:
        added[food] = row_count_of(values(inputs[food]))
    if spec.tablets in df.columns:
        added[tablets] = at_least(number(df, spec.tablets), spec.tablets_enough)
    if inputs[vaccines]:
        added[vaccines] = all_equal(values(inputs[vaccines]))
    return rewrite(df, added)


def add_composites(
    df: DataFrame, names: Sequence[str], spec: Composites, by: Sequence[str] = (), orient: str = "code_sum"
) -> DataFrame:
    """All composites of one table."""
    out = add_row_composites(df, names, spec)
    return wealth_index(out, asset_columns(df, names, spec), spec.outputs[0], by, orient)
