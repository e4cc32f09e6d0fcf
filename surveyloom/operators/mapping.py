"""From raw source columns to standard names (dictionary matching, renames, projections).

Dictionaries and column catalogues are tables, so the matching also serves a catalogue of
many thousands of source tables: only equi-joins on pre-aggregated keys, no nested loops.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.columns import INVISIBLE, normal_name, strip

# Cells that say a source has no such variable, the derived-variable mark,
# the person a suffixed column is about, what a component of a derived variable looks like, and the word
# between two names that claim one column.
NO_CODE = ("—", "", "nan")
DERIVED = "DERIVASI"
SUBJECTS = {"ibu": ("mother", "ibu"), "ayah": ("father", "ayah")}
DEFAULT_SUBJECT = "anak"
COMPONENT = r"[A-Za-z].*\d|\d.*[A-Za-z]|[a-z]{3,}"
CLASH = " bentrok "

#: Slots that rows without a key are spread over: they have no partner, but would meet in one task.
SLOTS = 1000


def spread_gaps(key: Column) -> Column:
    """A second join key: 0 where there is a key, else one of many numbers no partner has."""
    return F.when(key.isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SLOTS)).cast("int") + 1).otherwise(0)


def clean_name(name: str) -> str:
    """Column name without non-ASCII characters and outer blanks."""
    return name.encode("ascii", "ignore").decode("ascii").strip()


def clean_names(df: DataFrame) -> DataFrame:
    """Clean all column names; two names that become equal are an error."""
    names = [clean_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after cleaning: {twice}")
    return df.toDF(*names)


def clean_cell(cell: Column) -> Column:
    """Source code in a dictionary cell: no marks, cut at ``(`` or ``/``."""
    bare = F.replace(strip(F.regexp_replace(cell, INVISIBLE, "")), F.lit("*"), F.lit(""))
    return strip(F.regexp_replace(bare, r"(?s)\s*[(/].*$", ""))


def parse_cell(cell: Column) -> dict[str, Column]:
    """Status, main code, component codes and the needs-confirmation mark of a cell."""
    text = strip(F.coalesce(cell, F.lit("")))
    clean = F.replace(text, F.lit("*"), F.lit(""))
    absent = clean.isin("—", "")
    derived = F.upper(clean).startswith(DERIVED)
    rest = strip(F.substring(clean, len(DERIVED) + 1, 1 << 30))
    parts = F.filter(F.split(rest, r"[+\s]+"), lambda part: part.rlike(COMPONENT))
    main = strip(F.regexp_replace(clean, r"(?s)\s*[(/].*$", ""))
    found = F.regexp_extract_all(main, F.lit(r"([A-Za-z][A-Za-z0-9_]+)"), 1)
    none = F.array().cast("array<string>")
    return {
        "status": F.when(absent, F.lit("tidak_tersedia"))
        .when(derived, F.lit("derivasi"))
        .otherwise(F.lit("tersedia")),
        "main_code": F.when(~absent & ~derived, main),
        "components": F.when(absent, none).when(derived, parts).otherwise(found),
        "needs_check": ~absent & text.contains("*"),
    }


def subject_of(name: Column) -> Column:
    """Person a standard name is about: mother, father, else the child."""
    lowered = F.lower(name)
    case = None
    for subject, words in SUBJECTS.items():
        hit = lowered.contains(words[0]) | lowered.contains(words[1])
        case = F.when(hit, subject) if case is None else case.when(hit, subject)
    return case.otherwise(DEFAULT_SUBJECT)


def match_mapping(dictionary: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Adds ``code``: the catalogue column a dictionary cell names (mapping mode).

    A cell matches a column of the same normalised name. Failing that it matches
    ``<cell>_<suffix>``: the only such column, or among several the one whose suffix is the
    person the standard name is about. The suffix match is an equi-join too: each column
    offers all its ``prefix_suffix`` splits, reduced to one row per prefix before the join.
    """
    norm = normal_name(F.col("code"))
    columns = catalogue.select("source", "code", F.col("pos").alias("at"), norm.alias("whole"))
    words = F.split("whole", "_")
    # the whole name, and all its cuts into prefix and suffix
    cuts = F.transform(
        F.sequence(F.lit(1), F.size(words)),
        lambda i: F.struct(
            F.array_join(F.slice(words, F.lit(1), i), "_").alias("norm"),
            F.array_join(F.slice(words, i + 1, F.size(words) - i), "_").alias("suffix"),
            (i == F.size(words)).alias("same"),
        ),
    )
    offers = columns.select("source", "code", "at", F.explode(cuts).alias("cut")).select("source", "code", "at", "cut.*")
    part = ~F.col("same") & (F.col("suffix") != "")
    people = [*SUBJECTS, DEFAULT_SUBJECT]
    by_name = offers.groupBy("source", "norm").agg(
        F.max(F.when(F.col("same"), F.struct("at", "code")))["code"].alias("same_code"),
        F.count_if(part).alias("offers"),
        F.min(F.when(part, F.struct("at", "code")))["code"].alias("only_code"),
        *[F.min(F.when(part & (F.col("suffix") == p), F.struct("at", "code")))["code"].alias(f"for_{p}") for p in people],
    )
    subject = subject_of(F.col("standard_name"))
    for_person = F.coalesce(*[F.when(subject == p, F.col(f"for_{p}")) for p in people])
    # cells that name no column stay out of the join's tasks
    own = normal_name(clean_cell(F.col("code_cell")))
    wanted = dictionary.withColumn("norm", F.when(~own.isin("", NO_CODE[0]), own)).withColumn("slot", spread_gaps(F.col("norm")))
    found = wanted.join(by_name.withColumn("slot", F.lit(0)), ["source", "norm", "slot"], "left")
    code = F.coalesce("same_code", F.when(F.col("offers") == 1, F.col("only_code")).otherwise(for_person))
    return found.withColumn("code", code).select(*dictionary.columns, "code")


def match_audit(wanted: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """Adds ``found``: column named ``key`` exactly, else ignoring case, else ignoring
    case, ``_`` and blanks as well. Of equal candidates the last in the catalogue wins.

    A name offers itself once, however many columns have it, and each join brings one row per key, so names that very many
    columns and rows share cost no more than others.
    """
    squeeze = lambda c: F.regexp_replace(F.lower(c), r"(?U)[_\s]", "")
    steps = {"__same": lambda c: c, "__lower": F.lower, "__bare": squeeze}
    # catalogue columns of a name, the last of each
    names = catalogue.groupBy("source", "code").agg(F.max("pos").alias("at"))
    out = wanted.withColumn("__slot", spread_gaps(F.col(key)))
    for step, form in steps.items():
        offers = names.groupBy("source", form(F.col("code")).alias("__key")).agg(
            F.max(F.struct("at", "code"))["code"].alias(step)
        )
        offers = offers.withColumn("__slot", F.lit(0))
        out = out.withColumn("__key", form(F.col(key))).join(offers, ["source", "__key", "__slot"], "left").drop("__key")
    return out.withColumn("found", F.coalesce(*steps)).select(*wanted.columns, "found")


def rename_map(dictionary: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per dictionary row and source: the column it renames, or why none.

    Rows without a code and derived rows are ``skipped``. The first dictionary row claims
    a column; a later one under another name is ``claimed``.
    """
    cell = F.trim(F.coalesce("code_cell", F.lit("")))
    skipped = cell.isin(*NO_CODE) | F.upper(cell).startswith(DERIVED)
    matched = match_mapping(dictionary, catalogue).withColumn("code", F.when(~skipped, F.col("code")))
    # rows that claim one column are few; those without one are spread
    rows = matched.withColumn("slot", spread_gaps(F.col("code")))
    claims = Window.partitionBy("source", "code", "slot").orderBy("pos")
    rows = rows.withColumn("owner", F.when(F.col("code").isNotNull(), F.first("standard_name").over(claims)))
    status = (
        F.when(skipped, "skipped")
        .when(F.col("code").isNull(), "unmatched")
        .when(F.col("owner") != F.col("standard_name"), "claimed")
        .otherwise("mapped")
    )
    reason = F.when(status == "unmatched", cell).when(
        status == "claimed", F.concat(cell, F.lit("->"), "code", F.lit(CLASH), "owner")
    )
    return rows.withColumns({"status": status, "reason": reason}).select(
        "source", "pos", "standard_name", "code_cell", "code", "status", "reason"
    )


def rename_pairs(mapped: DataFrame) -> dict[str, dict[str, str]]:
    """Per source raw name to standard name; bounded by the number of columns."""
    out: dict[str, dict[str, str]] = {}
    for r in mapped.where(F.col("status") == "mapped").select("source", "code", "standard_name").collect():
        out.setdefault(r["source"], {})[r["code"]] = r["standard_name"]
    for source, pairs in out.items():
        names = list(pairs.values())
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"several columns of {source} map to one standard name: {twice}")
    return out


def apply_rename(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Rename in one projection. A raw column in the way of a standard name is dropped."""
    taken = set(pairs.values()) - set(pairs)
    return df.drop(*[c for c in df.columns if c in taken]).withColumnsRenamed(dict(pairs))


def pii_codes(dictionary: DataFrame, role: str) -> dict[str, set[str]]:
    """Per source the raw codes of the dictionary rows whose role says personal data."""
    cell = strip(F.col("code_cell"))
    rows = dictionary.where((F.col("role") == role) & ~cell.isin(*NO_CODE)).select("source", cell.alias("code"))
    out: dict[str, set[str]] = {}
    for r in rows.collect():
        out.setdefault(r["source"], set()).add(r["code"])
    return out


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def allow_list(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep only listed columns; the projection prunes the Parquet scan."""
    keep = set(names)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in keep])


def dictionary_rows(
    dictionary: DataFrame,
    prefix: str | None = None,
    role: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """(standard_name, pos) of the variables of a name prefix, role and category."""
    rows = dictionary
    if prefix:
        rows = rows.where(F.col("standard_name").startswith(prefix))
    if role:
        rows = rows.where(F.col("role") == role)
    if category:
        rows = rows.where(F.col("category") == category)
    return rows.groupBy("standard_name").agg(F.min("pos").alias("pos"))


def names_where(dictionary: DataFrame, **which: str | None) -> list[str]:
    """Standard names of ``dictionary_rows`` in dictionary order."""
    rows = dictionary_rows(dictionary, **which).collect()
    return [r["standard_name"] for r in sorted(rows, key=lambda r: r["pos"])]


def near_names(catalogue: DataFrame, hints: Mapping[str, Sequence[str]], most: int = 10) -> DataFrame:
    """(source, required, code): for each required column a source lacks, its first columns
    with a hint in the name. Row-local up to the rank, which tasks cut before the shuffle."""
    lowered = F.lower("code")

    def near(column: str) -> Column:
        hit = reduce(or_, [lowered.contains(h) for h in hints[column]])
        return F.when(hit, F.lit(column))

    has = catalogue.groupBy("source").agg(
        F.array_compact(
            F.array(*[F.when(F.max(F.col("code") == c) == F.lit(False), F.lit(c)) for c in hints])
        ).alias("lacks")
    )
    offers = catalogue.select(
        "source", "pos", "code", F.explode(F.array_compact(F.array(*[near(c) for c in hints]))).alias("required")
    )
    wanted = offers.join(has.select("source", F.explode("lacks").alias("required")), ["source", "required"])
    order = Window.partitionBy("source", "required").orderBy("pos")
    return (
        wanted.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= most)
        .select("source", "required", "rank", "code")
    )


def require_columns(df: DataFrame, hints: Mapping[str, Sequence[str]], most: int = 10) -> None:
    """Error before any job if a required column is missing, with near names to look at."""
    missing = [c for c in hints if c not in df.columns]
    if not missing:
        return
    near = {
        c: [k for k in df.columns if any(h in k.lower() for h in hints[c])][:most] for c in missing
    }
    raise ValueError(f"required columns are not mapped: {missing}; similar columns: {near}")
