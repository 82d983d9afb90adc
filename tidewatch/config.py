"""Clinical constants. Every operator takes them as parameters with these defaults."""

from __future__ import annotations

# Item allowlists, accepted units and plausibility bounds.
CREATININE_ITEMS = (50912, 51081, 52024, 52546)
URINE_ITEMS = (226559, 226560, 226561, 226567, 226627, 226631, 227489)
CREATININE_UNIT = "mg/dL"
URINE_UNIT = "mL"
CREATININE_BOUNDS = (0.1, 20.0)
URINE_BOUNDS = (0.0, 10000.0)
CLEAN_CREATININE_BOUNDS = (0.3, 15.0)
CLEAN_URINE_BOUNDS = (0.0, 5000.0)
AGE_BOUNDS = (0, 120)
WEIGHT_BOUNDS = (30, 250)
MAX_MISSING_KEY_RATIO = 0.01
DEFAULT_WEIGHT_KG = 70.0
CREATININE_LABEL = "creatinine"
URINE_LABEL_PATTERN = "urine|foley|void"
DIALYSIS_PATTERN = "dialysis|crrt|hemodialysis"
OFFSET_EPOCH = "2022-01-01 00:00:00"
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Generalisation bins for ages, right-closed.
AGE_EDGES = (0, 18, 30, 40, 50, 60, 70, 80, 120)
AGE_LABELS = ("<18", "18-30", "30-40", "40-50", "50-60", "60-70", "70-80", "80+")

# The model features, in vector order.
FEATURES = (
    "creatinine",
    "baseline_creatinine",
    "creatinine_ratio",
    "creatinine_delta_1h",
    "creatinine_delta_48h",
    "urine_output_ml",
    "urine_ml_per_kg_hr_6h",
    "urine_ml_per_kg_hr_12h",
    "urine_ml_per_kg_hr_24h",
)
TARGET = "target_progress_to_stage3_48h"

# Required columns per source table.
REQUIRED_COLUMNS = {
    "patients": ("subject_id",),
    "admissions": ("subject_id", "hadm_id", "admittime", "dischtime"),
    "icustays": ("subject_id", "hadm_id", "stay_id", "intime", "outtime"),
    "labevents": ("subject_id", "hadm_id", "itemid", "charttime", "valuenum", "valueuom"),
    "d_labitems": ("itemid", "label"),
    "outputevents": (
        "subject_id", "hadm_id", "stay_id", "itemid", "charttime", "value", "valueuom",
    ),
    "d_items": ("itemid", "label"),
}

# Demographic columns carried from the second cohort's patient table.
PATIENT_COLUMNS = (
    "patientunitstayid", "uniquepid", "hospitalid", "region", "unittype",
    "age", "gender", "ethnicity", "admissionweight", "apacheadmissiondx",
)

# Differential-privacy value range and the minimum subgroup size of reports.
DP_RANGE = (0.5, 5.0)
MIN_SUBGROUP = 10
CALIBRATION_DECAY_LIMIT = 0.05

# Fall-back distribution parameters (means, standard deviations).
DISTRIBUTION_DEFAULTS = {"creat_mean": 1.0, "creat_std": 0.3, "urine_mean": 50.0, "urine_std": 20.0}
GENERATOR_DEFAULTS = {"creat_mean": 1.2, "creat_std": 0.4, "urine_mean": 60.0, "urine_std": 25.0}

# What the cross-site report calls its two sites.
SITE_NAMES = ("Hospital A (Source)", "Hospital B (Target)")
