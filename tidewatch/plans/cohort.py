"""The feature chain of both cohorts: clean, align to hours, engineer, label, target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators import hourly, joins, staging

OFFSET_HOUR_KEYS = ("patientunitstayid", "admissionweight", "hospitalid", "age", "gender")


def hospital_hourly(creatinine: DataFrame, urine: DataFrame) -> DataFrame:
    """First cohort: one row per subject, admission and hour, and per stay where urine has one."""
    left = hourly.hourly_last(creatinine, ["subject_id", "hadm_id"], "creatinine", "labevent_id")
    right = hourly.hourly_sum_by(urine, ["subject_id", "hadm_id", "stay_id"], "urine_output_ml")
    return joins.hourly_outer_join(left, right, ["subject_id", "hadm_id", "hour_bucket"])


def hospital_timeline(creatinine: DataFrame, urine: DataFrame) -> DataFrame:
    return staging.union_timelines(
        staging.to_event_timeline(
            creatinine, ["subject_id", "hadm_id"], "creatinine", "creatinine", config.CREATININE_UNIT
        ),
        staging.to_event_timeline(
            urine, ["subject_id", "hadm_id", "stay_id"], "urine_output_ml", "urine_output", config.URINE_UNIT
        ),
    )


def offset_creatinine(lab: DataFrame, patients: DataFrame) -> DataFrame:
    """Second cohort: creatinine rows with times and demographics."""
    rows = (
        staging.conditional_range_filter(staging.dedup_rows(lab))
        .filter(F.col("labname") == "creatinine")
        .withColumnRenamed("labresult", "creatinine")
        .withColumn("event_time", staging.offset_to_time("labresultoffset"))
    )
    return joins.demographics_left_join(rows, staging.clean_patients(patients), config.PATIENT_COLUMNS)


def offset_urine(intake: DataFrame, patients: DataFrame) -> DataFrame:
    rows = (
        staging.clean_intake(staging.dedup_rows(intake))
        .withColumnRenamed("cellvaluenumeric", "urine_output_ml")
        .withColumn("event_time", staging.offset_to_time("intakeoutputoffset"))
    )
    return joins.demographics_left_join(rows, staging.clean_patients(patients), config.PATIENT_COLUMNS)


def offset_hourly(
    creatinine: DataFrame, urine: DataFrame, keys: Sequence[str] = OFFSET_HOUR_KEYS
) -> DataFrame:
    """Hours keyed by patient and demographics: a patient without them has no hours."""
    left = hourly.hourly_last(creatinine, keys, "creatinine", "event_id")
    right = hourly.hourly_sum_by(urine, keys, "urine_output_ml")
    return joins.hourly_outer_join(left, right, [*keys, "hour_bucket"])


def offset_timeline(creatinine: DataFrame, urine: DataFrame) -> DataFrame:
    keys = [
        "patientunitstayid", "uniquepid", "hospitalid", "age", "gender", "ethnicity",
        "admissionweight", "unittype", "apacheadmissiondx",
    ]
    return staging.union_timelines(
        staging.to_event_timeline(creatinine, keys, "creatinine", "creatinine", config.CREATININE_UNIT),
        staging.to_event_timeline(urine, keys, "urine_output_ml", "urine_output", config.URINE_UNIT),
    )
