"""Growth indices: a lookup in a reference table with interpolation, and the LMS formula.

The lookup is a range join. It is laid out as an equi-join: the reference points become
half-open segments, spread over buckets of the key, so Spark hash-joins on (indicator, sex,
bucket) and checks the range as a residual condition. A small reference is broadcast by its bytes.
One that is not shares few keys among all rows, and a month of age may hold a third of them:
segments are then repeated once per salt and rows of a key are spread over the salts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from surveyloom.functions.columns import cut_code, double, lms_z, number, ref, rewrite
from surveyloom.session import materialise
from surveyloom.specs import Measures


def segments(lms: DataFrame, bucket: float = 1.0) -> DataFrame:
    """Reference points (indicator, sex, x, l, m, s) as joinable segments.

    Each segment holds both of its ends, so a key on a point takes the point itself
    and a key between two points the linear mix. The last point is a segment of its own;
    keys beyond the ends meet no segment.
    """
    order = Window.partitionBy("indicator", "sex").orderBy("x")
    ahead = {f"{c}1": F.lead(c).over(order) for c in ("x", "l", "m", "s")}
    ends = lms.select(
        "indicator",
        F.col("sex").cast("int").alias("sex"),
        *[F.col(c).cast("double").alias(c) for c in ("x", "l", "m", "s")],
    ).withColumns(ahead)
    width = F.lit(float(bucket))
    buckets = F.sequence(
        F.floor(F.col("x") / width), F.floor(F.coalesce("x1", F.col("x")) / width)
    )
    return ends.withColumn("bucket", F.explode(buckets))


#: Salts of a key when the reference is joined by a shuffle.
SALTS = 16


def _shuffled(table: DataFrame) -> bool:
    """Whether a written table is above the bytes that Spark broadcasts."""
    most = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > most


def _salt(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` by a row's own values, so that rows with one key get different ones."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    return F.pmod(F.xxhash64(*[F.col(ref(c)) for c in plain]), F.lit(salts)).cast("int")


#: A lookup to make: column with the indicator, column with the key.
Lookup = tuple[str, str]


def lookup(
    df: DataFrame, segs: DataFrame, sex: str, wanted: Mapping[str, Lookup], bucket: float = 1.0, salts: int = SALTS
) -> DataFrame:
    """For each prefix in ``wanted`` add ``<prefix>_l``, ``_m``, ``_s`` of the reference at the
    key; null outside the table. ``sex`` names a column of 1 or 2. Rows are kept: a key
    meets at most one segment. The segments are written first: Spark broadcasts them by their bytes, or
    shuffles both sides if they are too many; the rows of a key then go to ``salts`` tasks.
    """
    segs = materialise(segs, "segments")
    salted = _shuffled(segs)
    keys = {
        f"__b_{p}": f"CAST(floor({ref(x)} / {double(bucket)}) AS BIGINT)" for p, (_, x) in wanted.items()
    }
    out = rewrite(df, {"__sex": f"CASE WHEN {ref(sex)} IN (1D, 2D) THEN CAST({ref(sex)} AS INT) END", **keys})
    if salted:
        out = out.withColumn("__salt", _salt(df, salts))
        segs = segs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    added = []
    for p, (indicator, x) in wanted.items():
        r = f"__r_{p}_"
        right = segs.toDF(*[r + c for c in segs.columns])
        on = F.expr(
            f"{ref(indicator)} = {r}indicator AND __sex = {r}sex AND __b_{p} = {r}bucket AND {ref(x)} >= {r}x "
            f"AND ({ref(x)} < {r}x1 OR ({r}x1 IS NULL AND {ref(x)} = {r}x))" + (f" AND __salt = {r}salt" if salted else "")
        )
        out = out.join(right, on, "left")
        share = f"try_divide({ref(x)} - {r}x, {r}x1 - {r}x)"
        added += [
            f"CASE WHEN {ref(x)} = {r}x THEN {r}{n} ELSE {r}{n} + {share} * ({r}{n}1 - {r}{n}) END AS {p}_{n}"
            for n in ("l", "m", "s")
        ]
    return out.selectExpr(*[ref(c) for c in df.columns], *added)


def standing_height(height: Column, age: Column, position: Column, cut: float, shift: float) -> Column:
    """Length below the cut, height from it on: ``shift`` is added to a young child measured
    standing and taken off an older one measured lying. Position 1 is lying, any other
    known one standing, unknown needs no correction."""
    lying = position == 1.0
    return (
        F.when((age < cut) & ~lying, height + F.lit(shift))
        .when((age >= cut) & lying, height - F.lit(shift))
        .otherwise(height)
    )


def growth_inputs(df: DataFrame, measures: Measures) -> dict[str, str]:
    """Measurements as numbers, under names of their own, as SQL text."""
    named = {
        "__h": measures.height, "__w": measures.weight, "__a": measures.age, "__s": measures.sex,
        "__p": measures.position,
    }
    return {k: number(df, c) if c and c in df.columns else "CAST(NULL AS DOUBLE)" for k, c in named.items()}


def score_growth(df: DataFrame, lms: DataFrame, measures: Measures, bucket: float = 1.0) -> DataFrame:
    """Scores and label of a table that has the ``growth_inputs`` columns.

    Height and weight for age and weight for height: three lookups in one stage if the reference is small.
    Height for age uses the corrected height, weight for height the height as measured.
    Implausible scores become null.
    """
    cut = double(measures.cut)
    keyed = rewrite(
        df,
        {
            "__i_haz": f"CASE WHEN __a < {cut} THEN 'haz_l' WHEN __a >= {cut} THEN 'haz_h' END",
            "__i_waz": "CASE WHEN __a IS NOT NULL THEN 'waz' END",
            "__i_whz": f"CASE WHEN __a < {cut} THEN 'whz_l' WHEN __a >= {cut} THEN 'whz_h' END",
        },
    )
    wanted = {"__haz": ("__i_haz", "__a"), "__waz": ("__i_waz", "__a"), "__whz": ("__i_whz", "__h")}
    found = cut_code(lookup(keyed, segments(lms, bucket), "__s", wanted, bucket))
    corrected = standing_height(F.col("__h"), F.col("__a"), F.col("__p"), measures.cut, measures.shift)
    scores = {
        f"{name}_score": lms_z(value, *[F.col(f"__{name}_{p}") for p in ("l", "m", "s")])
        for name, value in (("haz", corrected), ("waz", F.col("__w")), ("whz", F.col("__w")))
    }
    kept = [c for c in df.columns if c not in {*scores, measures.label} and c not in GROWTH_INPUTS]
    # one projection each for formula, bounds and label: none evaluates the one below twice
    scored = found.select(*[ref(c) for c in kept], *[z.alias(c) for c, z in scores.items()])
    bounded = rewrite(
        scored, {c: f"CASE WHEN {c} BETWEEN {double(lo)} AND {double(hi)} THEN {c} END" for c, (lo, hi) in measures.flags.items()}
    )
    return rewrite(bounded, {measures.label: f"CAST(haz_score < {double(measures.label_below)} AS BIGINT)"})


GROWTH_INPUTS = ("__h", "__w", "__a", "__s", "__p")


def growth_indices(df: DataFrame, lms: DataFrame, measures: Measures, bucket: float = 1.0) -> DataFrame:
    """``score_growth`` of a table with the measurements under their own names."""
    return score_growth(rewrite(df, growth_inputs(df, measures)), lms, measures, bucket)


def index_counts(df: DataFrame, label: str, by: list[str]) -> DataFrame:
    """Rows, rows with a valid height for age and rows with a positive label, per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("haz_score").alias("n_valid"),
        F.sum(F.coalesce(F.col(label), F.lit(0))).cast("bigint").alias("n_positive"),
    )
