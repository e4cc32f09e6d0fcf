"""From raw sources to one harmonised, encoded, imputed table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.columns import cut_code, number, outside, rewrite
from surveyloom.operators import availability, cleaning, combine, composites, indices, mapping
from surveyloom.operators.impute import impute_linear, impute_tree
from surveyloom.session import materialise
from surveyloom.sources import outputs
from surveyloom.sources.tables import catalogue_of
from surveyloom.specs import Encoding, Profile

MODES = ("parity", "clean")


class Watch:
    """Counts of the stages, filled by the job that evaluates their rows anyway: no scan is added for them.

    A frame that is watched has to be evaluated, once, before ``counts`` is asked.
    """

    def __init__(self) -> None:
        self.seen: list[tuple[str, str, Observation]] = []

    def ranges(self, df: DataFrame, source: str, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
        """Rows of a source, and by variable its values outside their range."""
        here = [c for c in ranges if c in df.columns]
        out = [F.count_if(F.expr(outside(number(df, c), *ranges[c]))).alias(c) for c in here]
        return self._watched(df, "outside", source, [F.count(F.lit(1)).alias("rows"), *out])

    def labels(self, df: DataFrame, source: str, score: str, label: str) -> DataFrame:
        """Rows with a valid score, and rows with a positive label."""
        counts = [F.count(score).alias("valid"), F.count_if(F.col(label) == 1).alias("positive")]
        return self._watched(df, "label", source, counts)

    def _watched(self, df: DataFrame, stage: str, source: str, counts: list) -> DataFrame:
        seen = Observation()
        self.seen.append((stage, source, seen))
        return df.observe(seen, *counts)

    def counts(self, spark: SparkSession) -> DataFrame:
        """``stage, source, name, n``: a row per count."""
        rows = [(stage, source, name, n) for stage, source, seen in self.seen for name, n in seen.get.items()]
        return spark.createDataFrame(rows, "stage string, source string, name string, n long")


@dataclass
class Mapped:
    """All sources under standard names, with the outcome of the dictionary matching."""

    tables: dict[str, DataFrame]
    outcome: DataFrame


def map_sources(sources: Mapping[str, DataFrame], dictionary: DataFrame, profile: Profile) -> Mapped:
    """Drop personal data, then rename source columns to standard names. The matching of all
    sources is one small job on their column catalogues."""
    private = mapping.pii_codes(dictionary, profile.pii_role)
    safe = {s: mapping.drop_columns(df, private.get(s, ())) for s, df in sources.items()}
    catalogue = reduce(DataFrame.unionByName, [catalogue_of(df, s) for s, df in safe.items()])
    wanted = dictionary.where(F.col("source").isin(*safe))
    outcome = materialise(mapping.rename_map(wanted, catalogue), "renames")
    pairs = mapping.rename_pairs(outcome)
    return Mapped({s: mapping.apply_rename(df, pairs.get(s, {})) for s, df in safe.items()}, outcome)


def prepare_rows(df: DataFrame, source: str, names: list[str], profile: Profile, mode: str) -> DataFrame:
    """Ranges, cohort, position codes and row-wise composites of one mapped source.

    ``parity`` computes composites before special codes are cleared and values recoded, as
    published results did. ``clean`` clears codes (measurements excepted) and recodes vaccine
    answers first.
    """
    mapping.require_columns(df, profile.name_hints)
    df = mapping.allow_list(df, {*names, *profile.computed})
    df = cut_code(cleaning.null_outside(df, profile.ranges))
    df = cleaning.assign_cohort(df, profile.cohort)
    df = cleaning.swap_codes(df, profile.recodes, source)
    if mode == "clean":
        df = cut_code(cleaning.null_codes(df, profile.special_codes, (*profile.encoding["meta"], *measured(profile))))
        df = cleaning.encode_binary(df, answers(names, profile), profile.recodes, source)
    return composites.add_row_composites(df, names, profile.composites)


def measured(profile: Profile) -> tuple[str, ...]:
    return (profile.measures.height, profile.measures.weight, profile.measures.age)


def answers(names: list[str], profile: Profile) -> list[str]:
    """Binary inputs of the all-vaccines flag, whose recode may differ by source."""
    prefix = profile.composites.vaccine_prefix
    return [c for c in names if c.startswith(prefix) and c in profile.encoding["biner"]]


def encode_rows(df: DataFrame, source: str, names: list[str], profile: Profile, mode: str) -> DataFrame:
    """Recodes and encoding of one prepared source. Columns named ``__`` are working copies."""
    df = cut_code(cleaning.recode(df, profile.recodes, source))
    copies = [c for c in df.columns if c.startswith("__")]
    encoding, keep = profile.encoding, (*copies,)
    if mode == "clean":
        done, keep = set(answers(names, profile)), (*copies, *measured(profile))
        encoding = Encoding({g: tuple(c for c in encoding[g] if c not in done) for g in encoding.groups})
    return cleaning.encode(df, encoding, profile.recodes, source, profile.special_codes, keep)


def harmonise(
    sources: Mapping[str, DataFrame],
    dictionary: DataFrame,
    lms: DataFrame,
    profile: Profile,
    mode: str = "parity",
    impute: str | None = "linear",
    watch: Watch | None = None,
) -> DataFrame:
    """All sources through all stages, stacked. ``impute`` is linear, tree or None.

    ``watch`` counts values out of range, valid scores and labels of each source as the rows pass. What needs whole columns
    runs for all sources at once: the wealth index in one pass over the assets, and the imputation of all cells. Each source keeps its own means, weights,
    regressions and code lists, so no source learns from another.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    tag, wealth = profile.source_column, profile.composites.outputs[0]
    names = mapping.names_where(dictionary)
    mapped = map_sources(sources, dictionary, profile).tables
    prepared = {s: prepare_rows(df, s, names, profile, mode) for s, df in mapped.items()}
    assets = {s: composites.asset_columns(df, names, profile.composites) for s, df in prepared.items()}
    # indices need values as they were before encoding: numeric copies travel along
    raw = {s: columns for s, columns in assets.items() if len(columns) >= 3}
    frames = {}
    for s, df in prepared.items():
        if watch is not None:
            # only the rows that go on to the end are watched, not the passes over some of their columns
            df = prepare_rows(watch.ranges(mapped[s], s, profile.ranges), s, names, profile, mode)
        copies = indices.growth_inputs(df, profile.measures)
        copies |= {f"__raw_{c}": number(df, c) for c in raw.get(s, ())}
        frames[s] = encode_rows(rewrite(df, copies), s, names, profile, mode)
    present = {
        s: [*df.columns, *profile.measures.flags, *([wealth] if s in raw else [])] for s, df in frames.items()
    }
    stacked = indices.score_growth(combine.stack(frames, tag), lms, profile.measures)
    if watch is not None:
        for s in frames:
            here = F.col(tag) == s
            own = {f"__{c}": F.when(here, F.col(c)) for c in ("haz_score", profile.measures.label)}
            stacked = watch.labels(stacked.withColumns(own), s, "__haz_score", f"__{profile.measures.label}").drop(*own)
    stacked = cleaning.encode_binary(stacked, [profile.measures.label], profile.recodes, "")
    if raw:
        used = list(dict.fromkeys(f"__raw_{c}" for columns in raw.values() for c in columns))
        orient = "ownership" if mode == "clean" else "code_sum"
        codes = {s: prepared[s].selectExpr(*[f"{number(prepared[s], c)} AS __raw_{c}" for c in raw[s]]) for s in raw}
        weights = composites.wealth_weights(combine.stack(codes, tag), used, [tag], orient)
        stacked = composites.wealth_score(stacked, weights, used, wealth, [tag]).drop(*used)
        stacked = cleaning.null_codes(stacked, profile.special_codes, [c for c in stacked.columns if c != wealth])
    # text left over by the encoding is never imputed, so its types can be settled first
    stacked = cleaning.infer_types(stacked, like=combine.stack(prepared, "__source"))
    if impute is not None:
        method = {"linear": impute_linear, "tree": impute_tree}[impute]
        stacked = method(stacked, profile.impute, profile.encoding.coded, profile.label, present)
    return combine.fill_indicators(stacked)


def finish(table: DataFrame, path: str, profile: Profile, watch: Watch | None = None, keep_others: bool = False) -> str:
    """The last stage: the table by cell, the validation report, the variables one cohort lacks, and the encoding.

    Written below ``path`` as ``table``, ``report``, ``gaps`` and ``encoding``, with ``watch`` also ``counts``; returns the
    table's folder. The table is evaluated once, to be written; the rest is read from what was written. ``keep_others``
    replaces the cells the table has and reports on all.
    """
    tag, cohort = profile.source_column, profile.cohort
    spark, folder = table.sparkSession, f"{path}/table"
    outputs.write_table(table, folder, profile.impute.cell, keep_others=keep_others)
    written = spark.read.schema(table.schema).parquet(folder).select(*[f"`{c}`" for c in table.columns])
    outputs.write_report(combine.validation_report(written, tag, cohort.output, profile.label), f"{path}/report")
    known = {tag, *profile.encoding["meta"], *profile.encoding["drop"]}
    gaps = availability.structural_gaps(written, cohort.output, cohort.young, cohort.old, cohort.young_only, known)
    outputs.write_report(gaps, f"{path}/gaps")
    outputs.write_encoding(spark, profile.encoding, f"{path}/encoding")
    if watch is not None:
        outputs.write_report(watch.counts(spark), f"{path}/counts")
    return folder
