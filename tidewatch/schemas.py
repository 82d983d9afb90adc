"""Explicit schemas; nothing in a job infers types."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw extracts: every column is a string.
RAW_LABEVENTS = strings(
    "labevent_id", "subject_id", "hadm_id", "specimen_id", "itemid", "order_provider_id",
    "charttime", "storetime", "value", "valuenum", "valueuom", "ref_range_lower",
    "ref_range_upper", "flag", "priority", "comments",
)
RAW_OUTPUTEVENTS = strings(
    "subject_id", "hadm_id", "stay_id", "caregiver_id", "charttime", "storetime",
    "itemid", "value", "valueuom",
)
RAW_ICUSTAYS = strings(
    "subject_id", "hadm_id", "stay_id", "first_careunit", "last_careunit", "intime", "outtime", "los",
)

PATIENT = T.StructType(
    [
        T.StructField("patientunitstayid", T.LongType()),
        T.StructField("uniquepid", T.StringType()),
        T.StructField("hospitalid", T.LongType()),
        T.StructField("region", T.StringType()),
        T.StructField("unittype", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("ethnicity", T.StringType()),
        T.StructField("admissionweight", T.DoubleType()),
        T.StructField("apacheadmissiondx", T.StringType()),
    ]
)
LAB = T.StructType(
    [
        T.StructField("patientunitstayid", T.LongType()),
        T.StructField("labname", T.StringType()),
        T.StructField("labresultoffset", T.IntegerType()),
        T.StructField("labresult", T.DoubleType()),
    ]
)
INTAKE_OUTPUT = T.StructType(
    [
        T.StructField("patientunitstayid", T.LongType()),
        T.StructField("intakeoutputoffset", T.IntegerType()),
        T.StructField("cellvaluenumeric", T.DoubleType()),
    ]
)

# One live event, as carried in JSON.
LIVE_EVENT = T.StructType(
    [
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("stay_id", T.LongType()),
        T.StructField("charttime", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("uom", T.StringType()),
    ]
)

METRIC_LOG = T.StructType(
    [
        T.StructField("metric_ts", T.TimestampType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("extra_json", T.StringType()),
    ]
)

# The sample array in a metric row's extra JSON.
METRIC_EXTRA = T.StructType(
    [
        T.StructField(
            "sample",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("value", T.DoubleType()),
                        T.StructField("event_type", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

# A trace of the live path, as its sink holds it.
TRACE = (
    "patient_id string, `timestamp` string, batch_id long, record struct<type: string, value: double, uom: string>, "
    "algorithms struct<bloom: string, fm_distinct_patients: long, dgim_events_1h: long, k_anonymity: string>, "
    "features struct<creatinine: double, baseline_cr: double, cr_ratio: double, cr_delta_recent: double, "
    "uo_ml_kg_hr_6h: double, uo_ml_kg_hr_24h: double>, vector array<double>, kdigo_stage int, anomaly_score double, "
    "twins array<struct<id: string, outcome: string, dist: double, cr: double, uo: double>>"
)
