"""Scalar column expressions. All run JVM-side inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that counts as a number. Spark's own cast also takes "5d" or "1f", so it is
# guarded by this pattern.
NUMERIC_TEXT = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

# Characters that survive copy and paste but are not part of a code.
INVISIBLE = "[\u200b\u200c\u200d\u200e\u200f\ufeff\u00a0]"


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


# Rules over many columns are built as SQL text: one projection of a hundred columns is then
# one call, where the Column API would take thousands.


def ref(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    return f"{float(value)!r}D"


def as_number(name: str, dtype: T.DataType) -> str:
    """A column as double; what is not a number becomes null, NaN included."""
    c = ref(name)
    if is_text(dtype):
        return f"CASE WHEN {c} RLIKE {text(NUMERIC_TEXT)} THEN try_cast({c} AS DOUBLE) END"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CAST(nullif({c}, double('NaN')) AS DOUBLE)"
    if is_number(dtype) or isinstance(dtype, T.BooleanType):
        return f"CAST({c} AS DOUBLE)"
    return "CAST(NULL AS DOUBLE)"


def number(df: DataFrame, name: str) -> str:
    """``as_number`` of a column of ``df``."""
    return as_number(name, df.schema[name].dataType)


def numeric(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` coerced to double by its type."""
    return F.expr(number(df, name))


def rewrite(df: DataFrame, changes: Mapping[str, str]) -> DataFrame:
    """Replace or add columns given as SQL text, in one projection."""
    kept = [f"{changes[c]} AS {ref(c)}" if c in changes else ref(c) for c in df.columns]
    new = [f"{e} AS {ref(c)}" for c, e in changes.items() if c not in df.columns]
    return df.selectExpr(*kept, *new) if changes else df


#: More parts than any frame has, so that none are put together.
_ANY_PARTS = 2**31 - 1


def cut_code(df: DataFrame) -> DataFrame:
    """The same rows; what Spark generates code for as a whole ends here and begins anew.

    Projections of many columns in a row make one method that is too long for the JVM to compile. Spark then runs each by itself and
    copies whole rows from one to the next. Between two cuts the code is short enough. Partitions stay as they are: nothing is shuffled.
    """
    return df if df.isStreaming else df.coalesce(_ANY_PARTS)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark keeps NaN and null apart (NaN > 6 holds); use null only, from ingest on."""
    return df.select(
        *[
            F.expr(f"nullif({ref(f.name)}, double('NaN'))").alias(f.name, metadata=f.metadata)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(ref(f.name))
            for f in df.schema.fields
        ]
    )


def outside(value: str, lo: float, hi: float) -> str:
    return f"({value} < {double(lo)} OR {value} > {double(hi)})"


def in_codes(value: str, codes: Iterable[float]) -> str:
    return f"{value} IN ({', '.join(double(code) for code in codes)})"


def map_codes(value: str, pairs: Mapping[float, float | None], otherwise: str = "NULL") -> str:
    """Code to code through one CASE; a target of None and unlisted codes give ``otherwise``."""
    whens = [f"WHEN {double(k)} THEN {double(v)}" for k, v in pairs.items() if v is not None]
    return f"CASE {value} {' '.join(whens)} ELSE {otherwise} END" if whens else f"CAST({otherwise} AS DOUBLE)"


def binary(value: str, ones: Iterable[float], zeros: Iterable[float]) -> str:
    return f"CASE WHEN {in_codes(value, ones)} THEN 1Y WHEN {in_codes(value, zeros)} THEN 0Y END"


def lms_z(value: Column, l: Column, m: Column, s: Column) -> Column:
    """z of ``value`` under skewness l, median m and variation s; null unless value > 0."""
    ratio = F.try_divide(value, m)
    return F.when(
        value > 0,
        F.when(l == 0, F.try_divide(F.ln(ratio), s)).otherwise(
            F.try_divide(F.pow(ratio, l) - 1, l * s)
        ),
    )


def number_text(value: Column) -> Column:
    """A double as text with a plain ``.0`` for whole numbers, never an exponent below 1e15."""
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
    return F.when(whole, F.concat(value.cast("bigint").cast("string"), F.lit(".0"))).otherwise(
        value.cast("string")
    )


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normal_name(c: Column) -> Column:
    """A column name for comparison: no invisible characters, trimmed, lower case."""
    return F.lower(strip(F.regexp_replace(c, INVISIBLE, "")))


def normal_text(c: Column) -> Column:
    """A label for comparison: lower case words separated by one space, null as empty."""
    words = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}_]+", " ")
    return F.trim(words)


def snap_expr(value: Column, codes: Iterable[float]) -> Column:
    """Nearest of a literal list of codes, the lower one on a tie; null stays null."""
    ordered = sorted({float(code) for code in codes})
    if not ordered:
        return value
    # cut points halfway between neighbours: a value on the cut goes down
    case = None
    for low, high in zip(ordered, ordered[1:]):
        hit = value - F.lit(low) <= F.lit(high) - value
        case = F.when(hit, F.lit(low)) if case is None else case.when(hit, F.lit(low))
    if case is None:
        return F.when(value.isNotNull(), F.lit(ordered[0]))
    return F.when(value.isNotNull(), case.otherwise(F.lit(ordered[-1])))


def hash_uniform(key: Column, salt: str, seed: int) -> Column:
    """A uniform number in [0, 1) that depends on the key only, not on partitioning."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(salt), F.lit(int(seed))), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def hash_normal(key: Column, salt: str, seed: int) -> Column:
    """A standard normal number from two uniform ones of the same key (Box and Muller)."""
    u = hash_uniform(key, salt + "/u", seed)
    v = hash_uniform(key, salt + "/v", seed)
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u)) * F.cos(F.lit(6.283185307179586) * v)
