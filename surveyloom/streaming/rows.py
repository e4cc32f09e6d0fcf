"""The row-local stages need no state, so they run unchanged on a streaming table.

What needs a whole table (wealth index, imputation, reports) stays in batch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from surveyloom.functions.columns import rewrite
from surveyloom.operators import indices, mapping
from surveyloom.plans.harmonise import encode_rows, prepare_rows
from surveyloom.specs import Profile


def harmonise_stream(
    stream: DataFrame, source: str, renames: Mapping[str, str], lms: DataFrame, profile: Profile, mode: str = "parity"
) -> DataFrame:
    """Rename, clean, assign cohorts, composites, recode, encode and score arriving rows, as the batch does."""
    names = list(renames.values())
    df = prepare_rows(mapping.apply_rename(stream, renames), source, names, profile, mode)
    df = encode_rows(rewrite(df, indices.growth_inputs(df, profile.measures)), source, names, profile, mode)
    return indices.score_growth(df, lms, profile.measures)
