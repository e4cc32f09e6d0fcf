"""Text likeness of a concept and a column label."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.columns import normal_text


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Share of characters in matching blocks (Ratcliff and Obershelp).

    It has no SQL form, so it runs as an Arrow batch function, and only on pairs that a
    join already matched. Pairs repeat across sources; each is computed once per batch.
    """
    seen: dict[tuple[str, str], float] = {}

    def ratio(a: str, b: str) -> float:
        if (a, b) not in seen:
            seen[a, b] = SequenceMatcher(None, a, b).ratio()
        return seen[a, b]

    return pd.Series([ratio(a, b) for a, b in zip(left, right)], dtype="float64")


@F.pandas_udf(T.StringType())
def two_decimals(value: pd.Series) -> pd.Series:
    """Exact half-even text with two decimals; Java's formatter rounds ties up."""
    return value.map(lambda v: None if pd.isna(v) else format(v, ".2f"))


def token_jaccard(left: Column, right: Column) -> Column:
    """Shared over all distinct words of two texts; 0 if either has none."""
    a, b = normal_text(left), normal_text(right)
    ta, tb = F.split(a, " "), F.split(b, " ")
    share = F.size(F.array_intersect(ta, tb)) / F.size(F.array_union(ta, tb)).cast("double")
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(share)


def label_similarity(left: Column, right: Column) -> Column:
    """The better of word overlap and character likeness; 0 if either text is empty."""
    a, b = normal_text(left), normal_text(right)
    best = F.greatest(token_jaccard(left, right), sequence_ratio(a, b))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(best)
