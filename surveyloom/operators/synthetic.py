"""Rows that look like a contract and hold no real value.

Every value is a function of row number, column and seed, so the table is the same for any
number of partitions and any of them can be made again after a loss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.columns import hash_normal, hash_uniform
from surveyloom.operators.contract import Contract
from surveyloom.session import materialise

# Household number base per source position and members per household, upper
# ends of design codes, and shape and bounds of sampling weights.
HOUSEHOLD_BASE = 1_000_000
PER_HOUSEHOLD = 1.6
DESIGN_CODES = {"svy_psu": 400, "province": 100, "svy_strata": 40, "district": 100}
WEIGHT_SIGMA = 0.4
WEIGHT_BOUNDS = (0.05, 12.0)
UNKNOWN_LABEL_SHARE = 0.15

#: Buckets of row numbers in which a row looks for its cell.
BUCKETS = 4096


def cell_quotas(
    contract: Contract, n: int, shares: Mapping[tuple[str, str], float] | None = None
) -> list[tuple[str, str, int]]:
    """(source, cohort, rows) in proportion to the contract's cell counts.

    If these give no row, by ``shares`` of source and cohort, or evenly without them.
    """
    total = sum(contract.cell_counts.values()) or 1
    out = [(*key.split("|"), round(n * count / total)) for key, count in contract.cell_counts.items()]
    if not any(q for *_, q in out):
        cells = [(s, k) for s in contract.source_vals for k in contract.kohort_vals]
        out = [(s, k, round(n * (shares[s, k] if shares else 1 / len(cells)))) for s, k in cells]
    return out


def quota_table(spark: SparkSession, contract: Contract, quotas: Sequence[tuple[str, str, int]], absent: Sequence[str]) -> DataFrame:
    """Cells by the row numbers they take, cut at bucket bounds so that a row number finds its cell by equality.

    At most ``BUCKETS`` rows more than there are cells.
    """
    rows, end = [], 0
    width = max(1, -(-sum(q for *_, q in quotas) // BUCKETS))
    gone = {c: {tuple(cell) for cell in contract.struct_absent.get(c, [])} for c in absent}
    for s, k, quota in quotas:
        share = float(contract.prevalensi.get(k, UNKNOWN_LABEL_SHARE))
        base = (contract.source_vals.index(s) + 1) * HOUSEHOLD_BASE
        facts = (s, k, share, base, max(1, int(quota / PER_HOUSEHOLD)), [(s, k) in gone[c] for c in absent])
        for b in range(end // width, -(-(end + quota) // width)):
            rows.append((b, end, end + quota, *facts))
        end += quota
    kinds = "__bucket long, __lo long, __hi long, __s string, __k string, __share double, __base long, __size long, __gone array<boolean>"
    return spark.createDataFrame(rows, kinds)


def clipped_normal(key: Column, name: str, seed: int, shapes: Mapping[str, tuple]) -> Column:
    """Normal by the feature's mean and spread, kept in its bounds; else standard normal."""
    z = hash_normal(key, name, seed)
    if name not in shapes:
        return z
    mean, sd, lo, hi = shapes[name]
    return F.least(F.greatest(F.lit(mean) + F.lit(sd) * z, F.lit(lo)), F.lit(hi))


def synthetic_table(
    spark: SparkSession,
    contract: Contract,
    n: int,
    seed: int,
    label: str,
    continuous: frozenset[str],
    shapes: Mapping[str, tuple],
    source: str = "source_flag",
    cohort: str = "kohort",
    household: str = "id_ruta",
    weight: str = "svy_weight",
    shares: Mapping[tuple[str, str], float] | None = None,
) -> DataFrame:
    """A table of about ``n`` rows with the contract's columns, types, cells and absences."""
    quotas = cell_quotas(contract, n, shares)
    rows = sum(q for *_, q in quotas)
    absent = [c for c in contract.columns if contract.struct_absent.get(c)]
    key, width = F.col("id"), max(1, -(-rows // BUCKETS))
    cells = quota_table(spark, contract, quotas, absent)
    numbered = spark.range(rows).withColumn("__bucket", F.floor(key / F.lit(width)))
    # written first: Spark broadcasts it by its bytes, or shuffles by bucket if the contract has very many cells
    joined = numbered.join(materialise(cells, "quotas"), "__bucket").where((key >= F.col("__lo")) & (key < F.col("__hi")))

    def index(name: str, size: Column) -> Column:
        return F.floor(hash_uniform(key, name, seed) * size)

    def value(name: str) -> Column:
        u = hash_uniform(key, name, seed)
        domain = contract.domains.get(name)
        if name == label:
            return (u < F.col("__share")).cast("double")
        if domain:
            codes = F.lit([float(v) for v in domain]).cast("array<double>")
            return codes[index(name, F.lit(len(domain))).cast("int")]
        if name in continuous:
            return clipped_normal(key, name, seed, shapes)
        if name == weight:
            drawn = F.exp(F.lit(WEIGHT_SIGMA) * hash_normal(key, name, seed))
            return F.least(F.greatest(drawn, F.lit(WEIGHT_BOUNDS[0])), F.lit(WEIGHT_BOUNDS[1]))
        if name == household:
            return (F.col("__base") + index(name, F.col("__size"))).cast("double")
        if name in DESIGN_CODES:
            return (F.lit(1) + index(name, F.lit(DESIGN_CODES[name] - 1))).cast("double")
        return index(name, F.lit(2)).cast("double")

    def column(name: str) -> Column:
        if name == source:
            return F.col("__s")
        if name == cohort:
            return F.col("__k")
        if name in contract.allnan:
            return F.lit(None).cast("double")
        if name not in absent:
            return value(name)
        return F.when(~F.col("__gone")[absent.index(name)], value(name))

    base = [c for c in contract.columns if not c.endswith("_missing")]
    made = joined.select(*[column(c).alias(c) for c in base])
    flagged = add_missing_flags(made, [c for c in contract.columns if c.endswith("_missing")])
    return cast_to_contract(flagged, contract)


def add_missing_flags(df: DataFrame, flags: list[str]) -> DataFrame:
    """``<base>_missing`` is 1 where the base is null; 0 if there is no such base."""
    suffix = len("_missing")
    return df.withColumns(
        {
            f: (F.col(f"`{f[:-suffix]}`").isNull().cast("double") if f[:-suffix] in df.columns else F.lit(0.0))
            for f in flags
        }
    )


def cast_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns in contract order and type; integers stay nullable."""
    return df.select(
        *[F.col(f"`{c}`").try_cast(contract.dtype.get(c, "double")).alias(c) for c in contract.columns]
    )
