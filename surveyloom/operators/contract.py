"""Schema contract of a harmonised table: profile it, build it from a schema, compare it."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.availability import filled_counts
from surveyloom.operators.impute import value_domains
from surveyloom.specs import Encoding

# A share up to this is structural absence, and default code domains.
NEARLY_ABSENT = 0.02
EDUCATION = "edu_mother"
EDUCATION_DOMAIN = (1, 2, 3, 4, 5)
OTHER_DOMAIN = (1, 2, 3, 4, 5, 6)


@dataclass
class Contract:
    """What a table of the same schema must look like. Metadata-sized.

    Fixed values: the names of the fields are those of the published contract file.
    """

    columns: list[str]
    dtype: dict[str, str]
    domains: dict[str, list[int]] = field(default_factory=dict)
    struct_absent: dict[str, list[list[str]]] = field(default_factory=dict)
    allnan: list[str] = field(default_factory=list)
    cell_counts: dict[str, int] = field(default_factory=dict)
    prevalensi: dict[str, float] = field(default_factory=dict)
    source_vals: list[str] = field(default_factory=list)
    kohort_vals: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False, indent=1)

    @staticmethod
    def from_json(text: str) -> "Contract":
        return Contract(**json.loads(text))


#: Codes of all columns that a contract, which is one document, may list.
MOST_CODES = 1_000_000


def contract_profile(df: DataFrame, source: str, cohort: str) -> DataFrame:
    """Long profile (column, dtype, source, cohort, n, filled, absent) from one scan.

    Rows of an unknown source or cohort count in no cell.
    """
    columns = [c for c in df.columns if c not in (source, cohort)]
    rows = df.where(F.col(source).isNotNull() & F.col(cohort).isNotNull())
    long = filled_counts(rows, columns, [source, cohort])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    dtype = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(types[c]))])[F.col("variable")]
    return long.select(
        F.col("variable").alias("column"),
        dtype.alias("dtype"),
        F.col(source).alias("source"),
        F.col(cohort).alias("cohort"),
        "n",
        "filled",
        (F.col("filled") == 0).alias("absent"),
    )


def contract_from_data(
    df: DataFrame,
    encoding: Encoding,
    source: str,
    cohort: str,
    label: str,
    defaults: Mapping[str, float],
) -> Contract:
    """Profile a table into a contract: three passes, each with a result the size of metadata."""
    columns = [c for c in df.columns if c not in (source, cohort)]
    counts = filled_counts(df, columns, [source, cohort]).collect()
    profile = [r for r in counts if r[source] is not None and r[cohort] is not None]
    known: dict[str, int] = {}
    for r in counts:
        known[r["variable"]] = known.get(r["variable"], 0) + r["filled"]
    coded = [c for c in columns if c in encoding.coded and c != label]
    domains: dict[str, list[int]] = {c: [] for c in coded}
    if coded:
        listed = value_domains(df, coded, [], whole=True).limit(MOST_CODES + 1).collect()
        if len(listed) > MOST_CODES:
            raise ValueError(f"coded columns hold more than {MOST_CODES} values, too many for a document: use value_domains")
        for r in listed:
            domains[r["variable"]].append(int(r["value"]))
    shares = df.where(F.col(cohort).isNotNull()).groupBy(cohort).agg(F.avg(F.col(label).cast("double")).alias("p"))
    prevalence = dict(defaults)
    prevalence |= {r[cohort]: r["p"] for r in shares.collect() if r[cohort] in defaults and r["p"] is not None}
    cells = {(r[source], r[cohort]): r["n"] for r in profile}
    return Contract(
        columns=list(df.columns),
        dtype={f.name: f.dataType.simpleString() for f in df.schema.fields},
        domains={c: sorted(v) for c, v in domains.items()},
        struct_absent={
            c: sorted([r[source], r[cohort]] for r in profile if r["variable"] == c and not r["filled"])
            for c in df.columns
        },
        allnan=[c for c in columns if not known.get(c)],
        cell_counts={f"{s}|{k}": n for (s, k), n in sorted(cells.items())},
        prevalensi=prevalence,
        source_vals=sorted({s for s, _ in cells}),
        kohort_vals=sorted({k for _, k in cells}),
    )


def absent_cells(matrix: DataFrame, cells: Sequence[str], columns: Iterable[str]) -> DataFrame:
    """(variabel, cell) of an availability matrix whose share is nearly none."""
    long = matrix.where(F.col("variabel").isin(*columns)).unpivot(["variabel"], list(cells), "cell", "share")
    return long.where(F.col("share") <= NEARLY_ABSENT).select("variabel", "cell")


def contract_from_schema(
    encoding: Encoding,
    matrix: DataFrame | None,
    sources: Sequence[str],
    cohorts: Sequence[str],
    label: str,
    source_share: Mapping[str, float],
    young_share: float,
    prevalence: Mapping[str, float],
    per_thousand: int = 1000,
) -> Contract:
    """Contract without data: from the encoding schema and an availability matrix."""
    columns = list(encoding.columns)
    absent: dict[str, list[list[str]]] = {c: [] for c in columns}
    if matrix is not None:
        cells = {f"{s}_{k}": [s, k] for s in sources for k in cohorts}
        known = [c for c in cells if c in matrix.columns]
        for r in absent_cells(matrix, known, columns).collect():
            absent[r["variabel"]].append(cells[r["cell"]])
    domains = {c: [0, 1] for c in encoding["biner"] if c != label}
    for c in (*encoding["ordinal"], *encoding["nominal"]):
        domains[c] = list(EDUCATION_DOMAIN if c == EDUCATION else OTHER_DOMAIN)
    text = encoding["meta"][:2]
    dtype = {
        c: "tinyint" if c in encoding["biner"] else "string" if c in text else "double" for c in columns
    }
    shares = {c: (young_share if c == cohorts[0] else 1 - young_share) for c in cohorts}
    return Contract(
        columns=columns,
        dtype=dtype,
        domains=domains,
        struct_absent=absent,
        cell_counts={
            f"{s}|{k}": round(per_thousand * source_share[s] * shares[k]) for s in sources for k in cohorts
        },
        prevalensi=dict(prevalence),
        source_vals=list(sources),
        kohort_vals=list(cohorts),
    )


def compare_profiles(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Where two contract profiles differ: columns, types and structurally absent cells."""
    keys = ["column", "source", "cohort"]
    left = ours.select(*keys, F.col("dtype").alias("dtype_left"), F.col("absent").alias("absent_left"))
    right = theirs.select(*keys, F.col("dtype").alias("dtype_right"), F.col("absent").alias("absent_right"))
    both = left.join(right, keys, "full_outer")
    problem = (
        F.when(F.col("dtype_left").isNull(), "missing_left")
        .when(F.col("dtype_right").isNull(), "missing_right")
        .when(F.col("dtype_left") != F.col("dtype_right"), "dtype")
        .when(F.col("absent_left") != F.col("absent_right"), "absence")
    )
    return both.withColumn("problem", problem).where(F.col("problem").isNotNull())
