"""Every operator on the driver's tables, with the same question in ANSI SQL.

The tables hold no survey, so columns of the same shape stand in for survey columns. Both
sides read whole tables.
"""

from __future__ import annotations

from surveyloom.queries import (
    audit,
    availability,
    cleaning,
    combine,
    composites,
    contract,
    harmonised,
    impute,
    indices,
    mapping,
    storage,
    stored,
)

MODULES = (
    availability, storage, mapping, cleaning, indices, composites, impute, combine, audit, contract, harmonised, stored,
)


def all_queries() -> dict:
    return {name: build for m in MODULES for name, build in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
