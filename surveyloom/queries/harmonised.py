"""The whole way from three raw sources to one table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators.combine import cell_counts
from surveyloom.plans.availability import availability as availability_plan
from surveyloom.plans.convergence import check_convergence
from surveyloom.plans.harmonise import Watch, finish, harmonise
from surveyloom.queries.base import SURVEY, SURVEY_SQL, survey
from surveyloom.queries.composites import ASSETS, SCORE, moments_sql, weights_sql
from surveyloom.queries.indices import lms_table, scores_sql
from surveyloom.session import checkpoint_root
from surveyloom.sources.tables import read_source
from surveyloom.specs import CohortRule, Composites, Encoding, ImputeRule, Profile, Recodes

SOURCES = ("A", "N", "R")
NAMES = [c for c in SURVEY if c != "source_flag"]
COMPOSITES = Composites(visit_prefix="visit_")
WORKS = ((2, 3, 4, 5, 6, 7, 8, 9), (1,))
PROFILE = Profile(
    sources=SOURCES,
    encoding=Encoding(
        {
            "biner": (
                "stunting_binary", "area_type", "sex_child", "occupation_mother", *ASSETS, "food_1", "food_2", "imm_1", "imm_2",
                "TTD_compliance", "imunisasi_lengkap",
            ),
            "ordinal": ("edu_mother",),
            "nominal": ("water_source",),
            "kontinu": (
                "haz_score", "waz_score", "whz_score", "age_child_months", "height_child_cm", "weight_child_kg", "visit_1",
                "visit_2", "ttd_count", "imm_vit_a_count", "wealth_index", "ANC_total_visit", "food_diversity_score",
            ),
            "meta": ("source_flag", "kohort", "svy_weight", "id_ruta"),
            "drop": ("measure_position", "pii_identitas"),
        }
    ),
    recodes=Recodes(
        swap={"A": {"measure_position": {1: 2, 2: 1}}, "R": {"measure_position": {1: 2, 2: 1}}},
        codes={"N": {"water_source": {1: 1, 2: 2, 3: 3, 4: 11, 5: 9, 6: None}, "edu_mother": {1: 1, 2: 1, 3: 2, 4: 3, 5: 3}}},
        binary_by_source={"A": {"occupation_mother": WORKS}, "N": {"occupation_mother": WORKS, "imm_1": ((1, 2, 3), (4,))}},
    ),
    special_codes=(88, 98, 99, 998),
    ranges={"height_child_cm": (40, 130), "weight_child_kg": (1, 40), "age_child_months": (0, 60)},
    cohort=CohortRule(young_only=frozenset({"food_1", "food_2", "food_diversity_score"})),
    composites=COMPOSITES,
    impute=ImputeRule(
        exclude=frozenset(
            {"stunting_binary", "haz_score", "waz_score", "whz_score", "source_flag", "kohort", "svy_weight", "id_ruta"}
        ),
        never=frozenset({"ANC_total_visit", "visit_1", "visit_2"}),
    ),
    name_hints={c: [c[:3]] for c in ("height_child_cm", "weight_child_kg", "age_child_months", "sex_child")},
)


def raw_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Each source under its own column codes, with personal data and a column nobody maps."""
    rows = survey(spark, sf)
    return {
        s: rows.where(F.col("source_flag") == s)
        .drop("source_flag")
        .select(
            *[F.col(c).alias(f"{s}{i:02d}") for i, c in enumerate(NAMES)],
            F.concat(F.lit("name of "), "id_ruta").alias("NIK"),
            F.lit(1).alias("unmapped"),
        )
        for s in SOURCES
    }


def spec(spark: SparkSession) -> DataFrame:
    marks = {"A": "{}", "N": " {}* ", "R": "{} (WUS)"}
    rows = [
        (i + 1, c, "any", c, "META" if c in ("svy_weight", "id_ruta") else "FITUR", s, marks[s].format(f"{s}{i:02d}".lower()))
        for i, c in enumerate(NAMES)
        for s in SOURCES
    ]
    rows += [(90, "pii_identitas", "any", "identity", "HAPUS_PRIVASI", s, "NIK") for s in SOURCES]
    rows += [(91, "haz_score", "any", "score", "LABEL", s, f"DERIVASI {s}01+{s}02") for s in SOURCES]
    return spark.createDataFrame(
        rows, "pos int, standard_name string, category string, concept string, role string, source string, code_cell string"
    )


def _rounded(df: DataFrame) -> DataFrame:
    scores = {"haz_score", "waz_score", "whz_score", "wealth_index"}
    return df.select(*[F.round(c, 6).alias(c) if c in scores else F.col(c) for c in df.columns])


def harmonised_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All stages but imputation."""
    return _rounded(harmonise(raw_sources(spark, sf), spec(spark), lms_table(spark), PROFILE, impute=None))


def harmonised_clean_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Codes cleared and answers recoded before composites; wealth grows with ownership."""
    return _rounded(harmonise(raw_sources(spark, sf), spec(spark), lms_table(spark), PROFILE, mode="clean", impute=None))


def harmonised_imputed(spark: SparkSession, sf: str) -> DataFrame:
    """All stages, with imputation and missing indicators."""
    return harmonise(raw_sources(spark, sf), spec(spark), lms_table(spark), PROFILE)


def harmonise_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the stages count of each source while the table is written: values out of range, valid scores, labels."""
    watch, path = Watch(), os.path.join(checkpoint_root(spark), f"counted-{uuid.uuid4().hex}")
    rows = harmonise(raw_sources(spark, sf), spec(spark), lms_table(spark), PROFILE, impute=None, watch=watch)
    finish(rows, path, PROFILE, watch)
    return read_source(spark, f"{path}/counts", "csv", schema="stage string, source string, name string, n bigint")


def convergence_of_trees(spark: SparkSession, sf: str) -> DataFrame:
    """The verdict on chained trees: small ones, and of fewer sweeps than the lines take."""
    rows = harmonise(raw_sources(spark, sf), spec(spark), lms_table(spark), PROFILE, impute=None)
    return check_convergence(rows, PROFILE, sweeps=4, impute="tree", trees=1, depth=3).features


def harmonised_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and labels per cell of the imputed table: imputation adds, loses and labels none."""
    cells = cell_counts(harmonised_imputed(spark, sf), ["source_flag", "kohort"], "stunting_binary")
    return cells.withColumn("total", F.col("total").cast("bigint"))


def availability_of_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Availability matrix of the raw sources, categories included."""
    return availability_plan(raw_sources(spark, sf), spec(spark), PROFILE)[1]


def convergence_of_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Ten sweeps on the encoded sources and a verdict per cell and feature."""
    rows = harmonise(raw_sources(spark, sf), spec(spark), lms_table(spark), PROFILE, impute=None)
    return check_convergence(rows, PROFILE).features


QUERIES = {
    f.__name__: f
    for f in (
        harmonised_rows, harmonised_clean_mode, harmonised_imputed, harmonised_cells, availability_of_sources,
        convergence_of_sources, convergence_of_trees, harmonise_counts,
    )
}

_SPECIAL = "(88, 98, 99, 998)"
_RANGED = ", ".join(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}" for c, (lo, hi) in PROFILE.ranges.items())
_OLD = "coalesce(age_child_months >= 24, false)"


def _cleared(c: str) -> str:
    return f"CASE WHEN {c} IN {_SPECIAL} THEN NULL ELSE {c} END"


def _flag(c: str) -> str:
    return f"CAST(CASE WHEN {c} = 1 THEN 1 WHEN {c} IN (0, 2) THEN 0 END AS TINYINT)"


def _listed(c: str, ones: str, zeros: str) -> str:
    return f"CAST(CASE WHEN {c} IN ({ones}) THEN 1 WHEN {c} IN ({zeros}) THEN 0 END AS TINYINT)"


_COHORT = """CASE WHEN age_child_months < 24 THEN 'baduta' WHEN age_child_months >= 24 THEN 'balita_tua' END AS kohort"""
_SWAP = """CASE WHEN source_flag IN ('A', 'R') AND measure_position = 1 THEN 2 WHEN source_flag IN ('A', 'R') AND measure_position = 2
 THEN 1 ELSE measure_position END AS measure_position"""
_PREPARED = f"""ranged AS (SELECT * REPLACE ({_RANGED}) FROM ({SURVEY_SQL})),
 masked AS (SELECT * REPLACE (CASE WHEN NOT {_OLD} THEN food_1 END AS food_1, CASE WHEN NOT {_OLD} THEN food_2 END AS food_2, {_SWAP}),
   {_COHORT} FROM ranged)"""
_WATER = """CASE WHEN source_flag = 'N' THEN CASE CAST(water_source AS DOUBLE) WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 11
 WHEN 5 THEN 9 END::DOUBLE ELSE CAST(water_source AS DOUBLE) END"""
_EDU = """CASE WHEN source_flag = 'N' THEN CASE edu_mother WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 3 END::DOUBLE
 ELSE edu_mother END"""


def _composed(rows: str, one: str = "= 1") -> str:
    return f"""composed AS (SELECT r.*,
   CASE WHEN visit_1 IS NOT NULL OR visit_2 IS NOT NULL THEN coalesce(visit_1, 0) + coalesce(visit_2, 0) END AS "ANC_total_visit",
   CASE WHEN food_1 IS NOT NULL OR food_2 IS NOT NULL
     THEN CAST(coalesce(food_1 = 1, false)::INT + coalesce(food_2 = 1, false)::INT AS DOUBLE) END AS food_diversity_score,
   CAST(ttd_count >= 90 AS BIGINT) AS "TTD_compliance",
   CAST(coalesce(imm_1 {one}, false) AND coalesce(imm_2 {one}, false) AS BIGINT) AS imunisasi_lengkap,
   {{score}} AS wealth_index
   FROM {rows} r JOIN moments USING (source_flag) JOIN weights USING (source_flag))"""


_OCCUPATION = f"""CASE WHEN source_flag IN ('A', 'N') THEN {_listed('occupation_mother', '2, 3, 4, 5, 6, 7, 8, 9', '1')}
 ELSE {_flag('occupation_mother')} END AS occupation_mother"""
_IMM_1 = f"CASE WHEN source_flag = 'N' THEN {_listed('imm_1', '1, 2, 3', '4')} ELSE {_flag('imm_1')} END"


def _encoded(measured: str, imm: str) -> str:
    return f"""SELECT source_flag, kohort, CAST(id_ruta AS DOUBLE) AS id_ruta, svy_weight, {measured},
 {', '.join(f'{_cleared(c)} AS "{c}"' for c in ('visit_1', 'visit_2', 'ttd_count', 'imm_vit_a_count', 'ANC_total_visit', 'food_diversity_score'))},
 {', '.join(f'round({_cleared(c)}, 6) AS {c}' for c in ('haz_score', 'waz_score', 'whz_score', 'wealth_index'))},
 {', '.join(f'{_flag(_cleared(c))} AS "{c}"' for c in ('stunting_binary', 'area_type', 'sex_child', *ASSETS, 'food_1', 'food_2', 'TTD_compliance', 'imunisasi_lengkap'))},
 {_OCCUPATION}, {imm}, {_cleared(_EDU)} AS edu_mother, {_cleared(_WATER)} AS water_source FROM composed"""


_MEASURED = ("age_child_months", "height_child_cm", "weight_child_kg")
_ALL_CLEARED = ", ".join(
    f"{_cleared(c)} AS {c}" for c in SURVEY if c not in ("source_flag", "id_ruta", "svy_weight", "water_source", *_MEASURED)
)
_HARMONISED = f"""WITH RECURSIVE {_PREPARED}, {scores_sql('SELECT * FROM masked')}, {moments_sql(SURVEY_SQL)}, {weights_sql()},
 {_composed('scored').format(score=SCORE)},
 encoded AS ({_encoded(', '.join(f'{_cleared(c)} AS {c}' for c in _MEASURED), f'{_IMM_1} AS imm_1, {_flag("imm_2")} AS imm_2')})"""

_CANDIDATES = [c for c in NAMES if c not in ("id_ruta", "svy_weight", "measure_position")]
_CELLS = [(s, k) for s in SOURCES for k in ("baduta", "balita_tua")]


def _known(c: str) -> str:
    # text is not cleared of codes; what is left under a raw name counts as there
    return f"count({c})" if c == "water_source" else f"count({_cleared(c)})"


_SHARES = " UNION ALL ".join(
    f"SELECT '{c}' AS variabel, source_flag, kohort, {_known(c)} / count(*) AS share FROM aged GROUP BY 2, 3" for c in _CANDIDATES
)
_PIVOT = ", ".join(
    f"coalesce(max(CASE WHEN source_flag = '{s}' AND kohort = '{k}' THEN share END), 0) AS \"{s}_{k}\"" for s, k in _CELLS
)


def _sources_with(k: str) -> str:
    return " + ".join(f'CASE WHEN "{s}_{k}" >= 0.5 THEN 1 ELSE 0 END' for s in SOURCES)


_AVAILABLE = f"""WITH aged AS (SELECT *, CASE WHEN age_child_months < 24 THEN 'baduta' ELSE 'balita_tua' END AS kohort FROM ({SURVEY_SQL})),
 shares AS ({_SHARES}), wide AS (SELECT variabel, {_PIVOT} FROM shares GROUP BY 1)
 SELECT variabel, 'any' AS kategori, {', '.join(f'round_even("{s}_{k}", 3) AS "{s}_{k}"' for s, k in _CELLS)},
 CAST({_sources_with('baduta')} AS INT) AS n_sumber_baduta, CAST({_sources_with('balita_tua')} AS INT) AS n_sumber_balita_tua,
 CASE {_sources_with('baduta')} WHEN 3 THEN 'kuat' WHEN 2 THEN 'sebagian' WHEN 1 THEN 'lemah' ELSE 'tidak' END AS lintas_sumber_baduta
 FROM wide"""

_OUTSIDE = " UNION ALL ".join(
    f"SELECT 'outside', source_flag, '{c}', count(CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 END) FROM ({SURVEY_SQL}) GROUP BY 2"
    for c, (lo, hi) in PROFILE.ranges.items()
)

SQL = {
    "harmonise_counts": f"""WITH {_PREPARED}, {scores_sql('SELECT * FROM masked')}
 SELECT 'outside' AS stage, source_flag AS source, 'rows' AS name, count(*) AS n FROM ({SURVEY_SQL}) GROUP BY 2
 UNION ALL {_OUTSIDE}
 UNION ALL SELECT 'label', source_flag, 'valid', count(haz_score) FROM scored GROUP BY 2
 UNION ALL SELECT 'label', source_flag, 'positive', count(CASE WHEN stunting_binary = 1 THEN 1 END) FROM scored GROUP BY 2""",
    "availability_of_sources": _AVAILABLE,
    "harmonised_rows": f"{_HARMONISED} SELECT * FROM encoded",
    "harmonised_clean_mode": f"""WITH RECURSIVE {_PREPARED}, cleared AS (SELECT * REPLACE ({_ALL_CLEARED}) FROM masked),
 {scores_sql('SELECT * FROM cleared')}, {moments_sql(SURVEY_SQL)}, {weights_sql()},
 answered AS (SELECT * REPLACE ({_IMM_1} AS imm_1, {_flag('imm_2')} AS imm_2) FROM scored),
 {_composed('answered').format(score='-' + SCORE)}
 {_encoded(', '.join(_MEASURED), 'imm_1, imm_2')}""",
    "harmonised_cells": f"""{_HARMONISED} SELECT source_flag, kohort, count(*) AS n, count(stunting_binary) AS n_known,
 CAST(sum(stunting_binary) AS BIGINT) AS total FROM encoded GROUP BY 1, 2""",
}
