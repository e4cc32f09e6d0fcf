"""Availability matrix of raw sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from surveyloom.operators import availability as ops
from surveyloom.operators.cleaning import add_cohort, null_codes
from surveyloom.operators.combine import stack
from surveyloom.plans.harmonise import map_sources
from surveyloom.specs import Profile


def availability(sources: Mapping[str, DataFrame], dictionary: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(shares, matrix) of all candidate variables.

    Raw availability: mapped names and special codes only, no ranges, no module mask. A row
    of unknown age counts as old here.
    """
    rule = profile.cohort
    exclude = {*profile.impute.exclude, *profile.encoding["drop"]}
    named = ops.candidates(dictionary, profile.meta_role, exclude)
    variables = [r["standard_name"] for r in sorted(named.collect(), key=lambda r: r["pos"])]
    frames = {}
    for source, table in map_sources(sources, dictionary, profile).tables.items():
        table = add_cohort(table, rule, null_is_old=True)
        table = null_codes(table, profile.special_codes, profile.encoding["meta"])
        kept = [c for c in table.columns if c in variables]
        frames[source] = table.select(*kept, rule.output)
    stacked = stack(frames, profile.source_column)
    shares = ops.availability(stacked, variables, profile.source_column, rule.output)
    return shares, ops.availability_matrix(shares, list(sources), rule.young, rule.old, named)
