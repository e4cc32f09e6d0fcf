"""Dictionary audit of many sources at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from surveyloom.operators import audit as ops


@dataclass
class Audit:
    report: DataFrame
    metadata: DataFrame
    pii: DataFrame
    summary: DataFrame
    by_category: DataFrame


def audit(
    dictionary: DataFrame,
    catalogue: DataFrame,
    value_labels: DataFrame,
    expectations: DataFrame,
    pii_keywords: Sequence[str],
) -> Audit:
    """All five reports, from metadata tables only."""
    report = ops.audit_dictionary(dictionary, catalogue, value_labels, expectations)
    return Audit(
        report,
        ops.metadata_dump(catalogue, value_labels),
        ops.pii_scan(catalogue, pii_keywords),
        ops.status_summary(report),
        ops.status_pivot(report),
    )
