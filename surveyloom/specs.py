"""Declarative specifications: what a survey means, apart from how Spark computes it."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

Codes = Mapping[float, "float | None"]
OnesZeros = tuple[Sequence[float], Sequence[float]]

#: Names of the encoding groups as they stand in the published JSON schema.
GROUPS = ("biner", "ordinal", "nominal", "kontinu", "meta", "drop")


@dataclass(frozen=True)
class Encoding:
    """Which kind of value each standard column holds."""

    groups: Mapping[str, Sequence[str]]

    @staticmethod
    def from_json(text: str) -> "Encoding":
        stored = json.loads(text)
        return Encoding({group: tuple(stored.get(group, ())) for group in GROUPS})

    def to_json(self) -> str:
        return json.dumps({g: list(self.groups.get(g, ())) for g in GROUPS}, indent=2, ensure_ascii=False)

    def __getitem__(self, group: str) -> tuple[str, ...]:
        return tuple(self.groups.get(group, ()))

    @property
    def coded(self) -> frozenset[str]:
        """Columns that hold codes, so that imputed values snap to observed codes."""
        return frozenset(self["biner"]) | frozenset(self["ordinal"]) | frozenset(self["nominal"])

    @property
    def columns(self) -> tuple[str, ...]:
        """All columns kept after encoding, group by group."""
        return tuple(c for g in GROUPS if g != "drop" for c in self[g])


@dataclass(frozen=True)
class CohortRule:
    """Two cohorts cut at an age; a null age has no cohort. The defaults."""

    age: str = "age_child_months"
    cut: float = 24.0
    young: str = "baduta"
    old: str = "balita_tua"
    output: str = "kohort"
    young_only: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Recodes:
    """Value recodes. Per-source rules win over general ones, those over the default."""

    swap: Mapping[str, Mapping[str, Codes]] = field(default_factory=dict)
    codes: Mapping[str, Mapping[str, Codes]] = field(default_factory=dict)
    binary: Mapping[str, OnesZeros] = field(default_factory=dict)
    binary_by_source: Mapping[str, Mapping[str, OnesZeros]] = field(default_factory=dict)
    default_binary: OnesZeros = ((1,), (0, 2))

    def binary_rule(self, source: str | None, column: str) -> OnesZeros:
        special = self.binary_by_source.get(source, {}) if source is not None else {}
        return special.get(column) or self.binary.get(column) or self.default_binary


@dataclass(frozen=True)
class Measures:
    """Columns and cut-offs of the growth indices. The defaults."""

    height: str = "height_child_cm"
    weight: str = "weight_child_kg"
    age: str = "age_child_months"
    sex: str = "sex_child"
    position: str | None = "measure_position"
    cut: float = 24.0
    shift: float = 0.7
    flags: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: {
            "haz_score": (-6, 6),
            "waz_score": (-6, 5),
            "whz_score": (-5, 5),
        }
    )
    label: str = "stunting_binary"
    label_below: float = -2.0


@dataclass(frozen=True)
class Composites:
    """Inputs of the row-wise composites, by dictionary name prefix. The defaults."""

    asset_prefix: str = "asset_"
    visit_prefix: str = "anc_freq_"
    food_prefix: str = "food_"
    vaccine_prefix: str = "imm_"
    vaccine_not: frozenset[str] = frozenset({"imm_vit_a_count"})
    tablets: str = "ttd_count"
    tablets_enough: float = 90.0
    outputs: tuple[str, ...] = (
        "wealth_index",
        "ANC_total_visit",
        "food_diversity_score",
        "TTD_compliance",
        "imunisasi_lengkap",
    )


@dataclass(frozen=True)
class ImputeRule:
    """What is imputed per cell, and how. The defaults, but for the last four."""

    cell: tuple[str, str] = ("source_flag", "kohort")
    exclude: frozenset[str] = frozenset()
    never: frozenset[str] = frozenset()
    sweeps: int = 5
    seed: int = 42
    min_values: int = 100
    min_leaf: int = 50
    bins: int = 127
    indicator_rate: float = 0.10
    ridge: float = 1e-3
    #: "draw" or "mean"
    start: str = "draw"
    #: targets learnt in one pass; None: a whole sweep
    block_size: int | None = None
    #: bytes of matrices a task may hold: cells beyond are taken in further batches
    gram_bytes: int = 64 << 20
    #: columns that identify a row, so that draws do not depend on the table's layout; None: the row's number
    row_key: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Profile:
    """Everything the harmonisation of one family of surveys needs, but its data."""

    sources: tuple[str, ...]
    encoding: Encoding
    recodes: Recodes
    special_codes: tuple[float, ...]
    ranges: Mapping[str, tuple[float, float]]
    cohort: CohortRule
    measures: Measures = Measures()
    composites: Composites = Composites()
    impute: ImputeRule = ImputeRule()
    source_column: str = "source_flag"
    label: str = "stunting_binary"
    pii_role: str = "HAPUS_PRIVASI"
    meta_role: str = "META"
    pii_keywords: tuple[str, ...] = ()
    name_hints: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @property
    def computed(self) -> tuple[str, ...]:
        """Columns that stages add and the allow-list must keep."""
        return (
            *self.composites.outputs,
            *self.measures.flags,
            self.measures.label,
            self.cohort.output,
            self.source_column,
        )
