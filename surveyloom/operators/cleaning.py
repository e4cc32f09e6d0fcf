"""Row-local cleaning, cohorts, recodes and encoding. Each operator is one projection."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame

from surveyloom.functions.columns import (
    binary,
    cut_code,
    double,
    in_codes,
    is_number,
    is_text,
    map_codes,
    number,
    outside,
    ref,
    rewrite,
    text,
)
from surveyloom.operators.mapping import drop_columns
from surveyloom.specs import CohortRule, Encoding, Recodes


class SourceColumn(str):
    """Name of the column that says which source a row is from."""


#: Either the name of the one source a table holds, or the column that names it.
Source = str | SourceColumn


def per_source(source: Source, special: Iterable[str], build: Callable[[str | None], str]) -> str:
    """A rule that differs by source: resolved now for one source, or as CASE on a column."""
    if not isinstance(source, SourceColumn):
        return build(source)
    whens = [f"WHEN {text(name)} THEN {build(name)}" for name in special]
    return f"CASE {ref(source)} {' '.join(whens)} ELSE {build(None)} END" if whens else build(None)


def coerce(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns as double; what is no number becomes null."""
    return rewrite(df, {c: number(df, c) for c in columns if c in df.columns})


def coerce_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Coerce those of the listed columns that hold text."""
    return coerce(df, [c for c in columns if c in df.columns and is_text(df.schema[c].dataType)])


def null_outside(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values outside their inclusive range become null; other values keep their type."""
    return rewrite(
        df,
        {
            c: f"CASE WHEN {outside(number(df, c), lo, hi)} THEN NULL ELSE {ref(c)} END"
            for c, (lo, hi) in ranges.items()
            if c in df.columns
        },
    )


def outside_counts(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """How many values ``null_outside`` removes: one row, one pass."""
    return df.selectExpr(
        *[
            f"count_if({outside(number(df, c), lo, hi)}) AS {ref(c)}"
            for c, (lo, hi) in ranges.items()
            if c in df.columns
        ]
    )


def cohort_expr(df: DataFrame, rule: CohortRule, null_is_old: bool = False) -> str:
    """Cohort by age. A null age has none, or counts as old for raw availability."""
    old = text(rule.old)
    if rule.age not in df.columns:
        return old if null_is_old else "CAST(NULL AS STRING)"
    age, cut = number(df, rule.age), double(rule.cut)
    rest = f"ELSE {old}" if null_is_old else f"WHEN {age} >= {cut} THEN {old}"
    return f"CASE WHEN {age} < {cut} THEN {text(rule.young)} {rest} END"


def add_cohort(df: DataFrame, rule: CohortRule, null_is_old: bool = False) -> DataFrame:
    return rewrite(df, {rule.output: cohort_expr(df, rule, null_is_old)})


def assign_cohort(df: DataFrame, rule: CohortRule) -> DataFrame:
    """Add the cohort and clear the young-only module for the old one, rows of no cohort kept."""
    cohort = cohort_expr(df, rule)
    masked = {
        c: f"CASE WHEN ({cohort}) <=> {text(rule.old)} THEN NULL ELSE {ref(c)} END"
        for c in df.columns
        if c in rule.young_only
    }
    return rewrite(df, {**masked, rule.output: cohort})


def null_codes(df: DataFrame, codes: Iterable[float], keep: Iterable[str]) -> DataFrame:
    """Special missing codes become null in all numeric columns but ``keep``."""
    codes, keep = list(codes), set(keep)
    return rewrite(
        df,
        {
            f.name: f"CASE WHEN {in_codes(f'CAST({ref(f.name)} AS DOUBLE)', codes)} THEN NULL ELSE {ref(f.name)} END"
            for f in df.schema.fields
            if f.name not in keep and is_number(f.dataType)
        },
    )


def swap_codes(df: DataFrame, recodes: Recodes, source: Source) -> DataFrame:
    """Exchange codes of listed columns; codes not listed stay."""
    columns = {c for rules in recodes.swap.values() for c in rules if c in df.columns}

    def build(column: str) -> Callable[[str | None], str]:
        value = number(df, column)
        return lambda s: map_codes(value, recodes.swap.get(s, {}).get(column, {}), otherwise=value)

    return rewrite(df, {c: per_source(source, recodes.swap, build(c)) for c in sorted(columns)})


def recode(df: DataFrame, recodes: Recodes, source: Source) -> DataFrame:
    """Code to canonical code; codes not listed become null. Sources without a rule keep theirs."""
    names = list(recodes.codes) if isinstance(source, SourceColumn) else [source]
    columns = {c for s in names for c in recodes.codes.get(s, {}) if c in df.columns}

    def build(column: str) -> Callable[[str | None], str]:
        value = number(df, column)

        def rule(s: str | None) -> str:
            pairs = recodes.codes.get(s, {}).get(column)
            return value if pairs is None else map_codes(value, pairs)

        return rule

    return rewrite(df, {c: per_source(source, recodes.codes, build(c)) for c in sorted(columns)})


def encode_binary(df: DataFrame, columns: Iterable[str], recodes: Recodes, source: Source) -> DataFrame:
    """0/1 as tinyint. A rule of the source wins over a general one, that over 1 / 0 or 2."""

    def build(column: str) -> Callable[[str | None], str]:
        value = number(df, column)
        return lambda s: binary(value, *recodes.binary_rule(s, column))

    special = recodes.binary_by_source
    return rewrite(
        df,
        {
            c: per_source(source, [s for s in special if c in special[s]], build(c))
            for c in columns
            if c in df.columns
        },
    )


def encode(
    df: DataFrame,
    encoding: Encoding,
    recodes: Recodes,
    source: Source,
    special_codes: Iterable[float],
    keep_codes: Iterable[str] = (),
) -> DataFrame:
    """Drop list, special codes to null, binaries to 0/1, other coded text to numbers."""
    df = drop_columns(df, encoding["drop"])
    df = cut_code(null_codes(df, special_codes, (*encoding["meta"], *keep_codes)))
    df = encode_binary(df, encoding["biner"], recodes, source)
    return coerce_text(df, (*encoding["ordinal"], *encoding["nominal"], *encoding["kontinu"]))


def numeric_shares(df: DataFrame) -> DataFrame:
    """Per text column the share of all rows that hold a number: one row, one pass."""
    words = [f.name for f in df.schema.fields if is_text(f.dataType)]
    return df.selectExpr(*[f"avg(CASE WHEN {number(df, c)} IS NULL THEN 0D ELSE 1D END) AS {ref(c)}" for c in words])


def infer_types(df: DataFrame, share: float = 0.95, like: DataFrame | None = None) -> DataFrame:
    """Text columns that are numbers in at least ``share`` of all rows become double.

    ``like`` is an earlier table with the same text, cheaper to read; text it lacks stays text.
    """
    base = df if like is None else like
    words = [f.name for f in df.schema.fields if is_text(f.dataType) and f.name in base.columns]
    if not words:
        return df
    shares = numeric_shares(base.select(*[ref(c) for c in words])).first().asDict()
    return coerce(df, [c for c in words if (shares.get(c) or 0.0) >= share])
