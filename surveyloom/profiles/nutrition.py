"""Profile of three national child nutrition surveys.

Fixed values: codes, names, ranges and thresholds below are what the surveys and
their published encoding use; results are right only with exactly these. The variable
dictionary, the expected value labels and the growth tables are larger and are
supplied by the user as files (see ``sources.tables``).
"""

from surveyloom.specs import (
    CohortRule,
    Composites,
    Encoding,
    ImputeRule,
    Measures,
    Profile,
    Recodes,
)

SOURCES = ("ssgi22", "ssgi24", "ski23")

# Codes that are no answer.
SPECIAL_CODES = (88, 98, 99, 888, 998, 999, 9999, 99999)

# Plausible ranges.
RANGES = {
    "height_child_cm": (40, 130),
    "weight_child_kg": (1, 40),
    "age_child_months": (0, 60),
}

# Columns only the young cohort was asked for.
YOUNG_ONLY = (
    "food_water", "food_formula", "food_cereal", "food_vit_a_veg", "food_green_veg", "food_vit_a_fruit",
    "food_organ_meat", "food_meat", "food_egg", "food_fish", "food_legume", "meal_frequency",
    "food_diversity_score", "breastfed_current", "mpasi_age_months", "prelacteal_feed", "imd_skin_contact",
    "colostrum_action", "breastfed_ever", "imd_duration", "weaning_age_months",
)

# Groups of the published encoding.
ENCODING = Encoding({
    "biner": (
        "stunting_binary", "area_type", "sex_child", "occupation_mother", "anc_received", "anc_lila_measured",
        "anc_hb_tested", "pregnancy_class", "kek_flag", "anemia_preg_flag", "hypertension_preg", "diabetes_preg",
        "ttd_received", "pmt_received", "mms_received", "imd_skin_contact", "breastfed_ever", "breastfed_current",
        "food_water", "food_formula", "food_cereal", "food_vit_a_veg", "food_green_veg", "food_vit_a_fruit",
        "food_organ_meat", "food_meat", "food_egg", "food_fish", "food_legume", "imm_hepb0", "imm_bcg",
        "imm_dpt1", "imm_dpt2", "imm_dpt3", "imm_dpt_boost", "imm_pcv", "imm_polio", "imm_measles_9mo",
        "imm_measles_boost", "ispa_1month", "diarrhea_1month", "pneumonia_1year", "tb_1year", "worm_1year",
        "jkn_used", "kia_book", "asset_gas", "asset_washing_machine", "asset_fridge", "asset_phone",
        "asset_computer", "asset_tv", "asset_motorcycle", "asset_car", "asset_gold", "asset_land",
        "asset_livestock", "bansos_kks", "bansos_pkh", "bansos_bpnt", "bansos_blt", "malaria_rdt",
        "TTD_compliance", "imunisasi_lengkap", "prelacteal_feed", "sanitation_own", "height_measure_12mo",
        "kpsp_sdidtk", "know_stunting",
    ),
    "ordinal": (
        "edu_mother", "percep_hereditary", "percep_asi", "percep_ttd", "percep_obese_misc", "percep_cognition",
        "percep_environment",
    ),
    "nominal": (
        "delivery_place", "delivery_assistant", "delivery_method", "marital_status", "anc_place",
        "colostrum_action", "water_source", "toilet_type", "feces_disposal", "building_ownership", "cooking_fuel",
        "lighting_source", "jkn_owned", "know_info_source", "immunity_serology",
    ),
    "kontinu": (
        "haz_score", "waz_score", "whz_score", "age_child_months", "weight_child_kg", "height_child_cm",
        "lila_child_cm", "weight_gain_trend", "birth_weight_g", "birth_length_cm", "gestational_age_wk",
        "head_circ_birth_cm", "age_mother_yr", "gravida", "height_mother_cm", "weight_mother_kg",
        "lila_mother_cm", "anc_freq_doc_t1", "anc_freq_doc_t2", "anc_freq_doc_t3", "anc_freq_mid_t1",
        "anc_freq_mid_t2", "anc_freq_mid_t3", "ttd_count", "imd_duration", "weaning_age_months",
        "mpasi_age_months", "meal_frequency", "imm_vit_a_count", "weigh_freq_12mo", "water_fetch_time",
        "floor_area_m2", "hb_level_gdl", "retinol_level", "wealth_index", "ANC_total_visit",
        "food_diversity_score",
    ),
    "meta": (
        "source_flag", "kohort", "province", "district", "svy_weight", "svy_psu", "svy_strata", "id_ruta",
    ),
    "drop": (
        "pii_identitas", "subdistrict", "village", "health_facility", "child_birth_date", "measure_date",
        "measure_position",
    ),
})

# Recodes of the published encoding.
RECODES = Recodes(
    swap={
        "ssgi22": {"measure_position": {1: 2, 2: 1}},
        "ski23": {"measure_position": {1: 2, 2: 1}},
    },
    binary={"kia_book": ((1, 2), (3, 4))},
    # (codes that mean 1, codes that mean 0)
    binary_by_source={
        "ssgi22": {
            "ttd_received": ((1, 2, 3), (4,)),
            "jkn_used": ((1, 2, 3), (4,)),
        },
        "ssgi24": {
            "imm_hepb0": ((1, 2, 3), (4,)),
            "imm_bcg": ((1, 2, 3), (4,)),
            "imm_dpt1": ((1, 2, 3), (4,)),
            "imm_dpt2": ((1, 2, 3), (4,)),
            "imm_dpt3": ((1, 2, 3), (4,)),
            "imm_dpt_boost": ((1, 2, 3), (4,)),
            "imm_measles_9mo": ((1, 2, 3), (4,)),
            "imm_measles_boost": ((1, 2, 3), (4,)),
            "ispa_1month": ((1, 2), (3,)),
            "diarrhea_1month": ((1, 2), (3,)),
            "pneumonia_1year": ((1, 2), (3,)),
            "tb_1year": ((1, 2), (3,)),
            "sanitation_own": ((1, 2, 3), (4,)),
            "occupation_mother": ((2, 3, 4, 5, 6, 7, 8, 9), (1,)),
        },
        "ski23": {
            "occupation_mother": ((2, 3, 4, 5, 6, 7, 8, 9), (1,)),
            "kia_book": ((1, 2, 3, 4, 5), (6, 7)),
        },
    },
    # source code: canonical code
    codes={
        "ssgi22": {
            "jkn_owned": {1: 1, 2: 2, 3: 3, 4: 4, 5: 5},
        },
        "ssgi24": {
            "water_source": {
                1: 1, 2: 2, 3: 3, 4: 11, 5: 9, 6: 10, 7: 7, 8: 8, 9: 6, 10: 13, 11: 14,
            },
            "cooking_fuel": {1: 8, 2: 7, 3: 6, 4: 5, 5: 3, 6: 2, 7: 1},
            "toilet_type": {1: 1, 2: 2, 3: 3, 4: 4, 5: 6},
            "jkn_owned": {
                1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 2, 7: 1, 8: 3, 9: 4, 10: 4, 11: 4, 12: 4,
                13: 4, 14: 4, 15: 4, 16: 6, 17: 1, 18: 2, 19: 1, 20: 1, 21: 1, 22: 2, 23: 1,
                24: 3, 25: 4, 26: 4, 27: 4, 28: 4, 29: 4, 30: 4, 31: 4, 32: 5,
            },
            "edu_mother": {1: 1, 2: 1, 3: 1, 4: 2, 5: 3, 6: 4, 7: 5, 8: 5},
        },
        "ski23": {
            "water_source": {
                1: 1, 2: 2, 3: 3, 4: 11, 5: 9, 6: 10, 7: 7, 8: 8, 9: 6, 10: 13, 11: 4, 12: 5, 13: 12,
            },
            "cooking_fuel": {1: 1, 2: 2, 3: 3, 4: 5, 5: 6, 6: 7, 7: 8},
            "delivery_place": {1: 1, 2: 1, 3: 2, 4: 3, 5: 5, 6: 4, 7: 7, 8: 8, 9: 9},
            "jkn_owned": {1: 1, 2: 2, 4: 1, 5: 1, 8: 3, 10: 4, 16: 6, 32: 5, 99: 6},
            "edu_mother": {0: None, 1: 1, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5, 7: 5},
        },
    },
)

# Columns imputation leaves alone.
NOT_IMPUTED = (
    "stunting_binary", "haz_score", "waz_score", "whz_score", "source_flag", "kohort", "province", "district",
    "svy_weight", "svy_psu", "svy_strata", "id_ruta",
)

# Visits that are never imputed.
VISIT_BLOCK = (
    "ANC_total_visit", "anc_freq_doc_t1", "anc_freq_doc_t2", "anc_freq_doc_t3", "anc_freq_mid_t1",
    "anc_freq_mid_t2", "anc_freq_mid_t3",
)

# Keywords of personal data.
PII_KEYWORDS = (
    "nik", "nama", "alamat", "no hp", "nomor hp", "telepon", "telpon", "rt", "rw", "kk",
    "kartu keluarga", "nomor urut", "responden", "pewawancara", "enumerator", "gps",
    "koordinat", "lintang", "bujur", "id art", "id ruta", "id rumah tangga",
    "tanggal lahir", "tgl lahir",
)

# Parts of names that hint at a required column.
NAME_HINTS = {
    "height_child_cm": ("tinggi", "height", "panjang", "length", "tb", "1503", "j02"),
    "weight_child_kg": ("berat", "weight", "bb", "1502", "1509", "j01"),
    "age_child_months": ("umur", "age", "bln", "month", "usia", "4072", "b4k7"),
    "sex_child": ("sex", "kelamin", "jenis", "jk", "404", "b4k4"),
}

#: Fixed values of synthetic tables: label share per cohort, share of rows per source and of the young.
PREVALENCE = {"baduta": 0.1427, "balita_tua": 0.2215}
SOURCE_SHARE = {"ssgi22": 0.464, "ssgi24": 0.416, "ski23": 0.120}
YOUNG_SHARE = 0.36

#: Mean, standard deviation, lowest and highest value of continuous features.
CONTINUOUS = {
    "age_child_months": (30.0, 16.0, 0.0, 59.0),
    "height_child_cm": (85.0, 12.0, 45.0, 125.0),
    "weight_child_kg": (11.5, 3.0, 2.0, 30.0),
    "lila_child_cm": (14.5, 1.8, 8.0, 22.0),
    "haz_score": (-1.0, 1.3, -6.0, 6.0),
    "waz_score": (-0.9, 1.2, -6.0, 5.0),
    "whz_score": (-0.4, 1.2, -5.0, 5.0),
    "weight_gain_trend": (0.0, 1.0, -3.0, 3.0),
    "birth_weight_g": (3100.0, 480.0, 1000.0, 5000.0),
    "birth_length_cm": (48.0, 2.6, 38.0, 56.0),
    "gestational_age_wk": (38.5, 1.8, 28.0, 43.0),
    "head_circ_birth_cm": (34.0, 1.8, 28.0, 40.0),
    "age_mother_yr": (29.0, 6.2, 15.0, 49.0),
    "gravida": (2.2, 1.2, 1.0, 8.0),
    "height_mother_cm": (153.0, 5.8, 135.0, 175.0),
    "weight_mother_kg": (56.0, 10.0, 35.0, 110.0),
    "lila_mother_cm": (26.0, 3.0, 17.0, 40.0),
    "anc_freq_doc_t1": (1.0, 1.0, 0.0, 6.0),
    "anc_freq_doc_t2": (1.2, 1.1, 0.0, 6.0),
    "anc_freq_doc_t3": (2.0, 1.4, 0.0, 8.0),
    "anc_freq_mid_t1": (1.1, 1.0, 0.0, 6.0),
    "anc_freq_mid_t2": (1.3, 1.1, 0.0, 6.0),
    "anc_freq_mid_t3": (2.1, 1.5, 0.0, 8.0),
    "ttd_count": (55.0, 30.0, 0.0, 120.0),
    "imd_duration": (35.0, 25.0, 0.0, 180.0),
    "weaning_age_months": (13.0, 6.0, 0.0, 24.0),
    "mpasi_age_months": (6.2, 1.6, 0.0, 18.0),
    "meal_frequency": (3.0, 1.1, 1.0, 8.0),
    "imm_vit_a_count": (1.4, 0.9, 0.0, 4.0),
    "weigh_freq_12mo": (7.0, 3.2, 0.0, 12.0),
    "water_fetch_time": (8.0, 12.0, 0.0, 120.0),
    "floor_area_m2": (60.0, 32.0, 8.0, 400.0),
    "hb_level_gdl": (11.2, 1.5, 5.0, 17.0),
    "retinol_level": (30.0, 9.0, 5.0, 70.0),
    "wealth_index": (0.0, 1.0, -4.0, 4.0),
    "ANC_total_visit": (6.0, 3.0, 0.0, 20.0),
    "food_diversity_score": (4.2, 1.8, 0.0, 8.0),
}

PROFILE = Profile(
    sources=SOURCES,
    encoding=ENCODING,
    recodes=RECODES,
    special_codes=SPECIAL_CODES,
    ranges=RANGES,
    cohort=CohortRule(young_only=frozenset(YOUNG_ONLY)),
    measures=Measures(),
    composites=Composites(),
    impute=ImputeRule(exclude=frozenset(NOT_IMPUTED), never=frozenset(VISIT_BLOCK)),
    pii_keywords=PII_KEYWORDS,
    name_hints=NAME_HINTS,
)
