"""Staging, cleaning, rules and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions import rules
from tidewatch.operators import series, staging
from tidewatch.plans import bindings as b
from tidewatch.plans import cohort, fixtures
from tidewatch.plans.oracle import VIEWS
from tidewatch.plans.registry import query

VIEWS["v_stg_labs"] = """
SELECT TRY_CAST(subject_id AS BIGINT) AS subject_id, TRY_CAST(hadm_id AS BIGINT) AS hadm_id,
       TRY_CAST(itemid AS BIGINT) AS itemid, TRY_CAST(charttime AS TIMESTAMP) AS charttime,
       TRY_CAST(valuenum AS DOUBLE) AS creatinine_mg_dl
FROM fx_labs_raw
WHERE itemid IN ('50912', '51081', '52024', '52546') AND valueuom = 'mg/dL'
  AND TRY_CAST(valuenum AS DOUBLE) BETWEEN 0.1 AND 20.0"""

VIEWS["v_stg_outputs"] = """
SELECT TRY_CAST(subject_id AS BIGINT) AS subject_id, TRY_CAST(hadm_id AS BIGINT) AS hadm_id,
       TRY_CAST(stay_id AS BIGINT) AS stay_id, TRY_CAST(itemid AS BIGINT) AS itemid,
       TRY_CAST(charttime AS TIMESTAMP) AS charttime, TRY_CAST(value AS DOUBLE) AS urine_ml
FROM fx_outputs_raw
WHERE itemid IN ('226559', '226560', '226561', '226567', '226627', '226631', '227489')
  AND valueuom = 'mL' AND TRY_CAST(value AS DOUBLE) >= 0 AND TRY_CAST(value AS DOUBLE) <= 10000"""

VIEWS["v_stg_stays"] = """
SELECT * FROM (
  SELECT subject_id::BIGINT AS subject_id, hadm_id::BIGINT AS hadm_id, stay_id::BIGINT AS stay_id,
         first_careunit, last_careunit, intime::TIMESTAMP AS intime, outtime::TIMESTAMP AS outtime,
         los::DOUBLE AS los FROM fx_stays_raw)
WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL AND stay_id IS NOT NULL
  AND intime IS NOT NULL AND outtime IS NOT NULL AND intime < outtime"""

VIEWS["v_cohort"] = """
SELECT subject_id, hadm_id, stay_id, first_careunit, last_careunit, intime, outtime, los FROM v_stg_stays"""

VIEWS["v_creat"] = """
SELECT c.subject_id, c.hadm_id, c.stay_id, e.charttime, e.creatinine_mg_dl
FROM v_cohort c JOIN v_stg_labs e ON c.subject_id = e.subject_id AND c.hadm_id = e.hadm_id
 AND e.charttime BETWEEN c.intime AND c.outtime"""

VIEWS["v_urine"] = """
SELECT c.subject_id, c.hadm_id, c.stay_id, u.charttime, u.urine_ml
FROM v_cohort c JOIN v_stg_outputs u ON c.stay_id = u.stay_id
 AND u.charttime BETWEEN c.intime AND c.outtime"""

VIEWS["v_hourly"] = """
SELECT coalesce(c.subject_id, u.subject_id) AS subject_id, coalesce(c.hadm_id, u.hadm_id) AS hadm_id,
       coalesce(c.stay_id, u.stay_id) AS stay_id, coalesce(c.hr, u.hr) AS charttime,
       c.creatinine_mg_dl, u.urine_ml, coalesce(c.s, 0) AS kdigo_creat_stage,
       coalesce(u.s, 0) AS kdigo_urine_stage, greatest(coalesce(c.s, 0), coalesce(u.s, 0)) AS kdigo_stage
FROM (SELECT *, CASE WHEN base IS NULL OR base = 0 THEN 0
                     WHEN creatinine_mg_dl / base >= 3.0 OR creatinine_mg_dl >= 4.0 THEN 3
                     WHEN creatinine_mg_dl / base >= 2.0 THEN 2
                     WHEN creatinine_mg_dl / base >= 1.5 THEN 1 ELSE 0 END AS s
      FROM (SELECT subject_id, hadm_id, stay_id, hr, max(creatinine_mg_dl) AS creatinine_mg_dl, base
            FROM (SELECT *, date_trunc('hour', charttime) AS hr,
                         min(creatinine_mg_dl) OVER (PARTITION BY stay_id) AS base FROM v_creat)
            GROUP BY subject_id, hadm_id, stay_id, hr, base)) c
FULL OUTER JOIN
     (SELECT *, CASE WHEN urine_ml < 30 THEN 2 WHEN urine_ml < 60 THEN 1 ELSE 0 END AS s
      FROM (SELECT subject_id, hadm_id, stay_id, date_trunc('hour', charttime) AS hr,
                   sum(urine_ml) AS urine_ml FROM v_urine GROUP BY ALL)) u
  ON c.stay_id = u.stay_id AND c.hr = u.hr"""

VIEWS["v_features"] = """
SELECT k.subject_id, k.hadm_id, k.stay_id, k.charttime, k.creatinine_mg_dl, k.urine_ml, k.kdigo_stage,
       max(k.kdigo_stage) OVER (PARTITION BY k.stay_id ORDER BY k.charttime
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rolling_max_kdigo,
       datediff('hour', c.intime, k.charttime) AS hours_since_admit
FROM v_hourly k LEFT JOIN v_cohort c ON k.stay_id = c.stay_id"""

VIEWS["v_mart"] = """
SELECT subject_id, hadm_id, stay_id, charttime, creatinine_mg_dl, urine_ml, hours_since_admit, kdigo_stage,
       rolling_max_kdigo, CASE WHEN rolling_max_kdigo >= 3 THEN 1 ELSE 0 END AS label_stage3_progression
FROM v_features WHERE creatinine_mg_dl IS NOT NULL AND urine_ml IS NOT NULL"""

# First cohort of the feature chain.
VIEWS["v_hosp_labs"] = """
SELECT labevent_id::BIGINT AS labevent_id, subject_id::BIGINT AS subject_id, hadm_id::BIGINT AS hadm_id,
       itemid::BIGINT AS itemid, charttime, TRY_CAST(valuenum AS DOUBLE) AS valuenum, valueuom
FROM fx_labs_raw"""
VIEWS["v_hosp_outputs"] = """
SELECT subject_id::BIGINT AS subject_id, hadm_id::BIGINT AS hadm_id, stay_id::BIGINT AS stay_id,
       itemid::BIGINT AS itemid, charttime, TRY_CAST(value AS DOUBLE) AS value, valueuom
FROM fx_outputs_raw"""
VIEWS["v_clean_labs"] = """
SELECT DISTINCT l.itemid, l.labevent_id, l.subject_id, l.hadm_id, l.charttime, l.valuenum AS creatinine,
       l.valueuom, TRY_CAST(l.charttime AS TIMESTAMP) AS event_time, d.label AS lab_label
FROM v_hosp_labs l
JOIN (SELECT DISTINCT itemid, label FROM fx_d_labitems WHERE contains(lower(label), 'creatinine')) d
  ON l.itemid = d.itemid
WHERE l.subject_id IS NOT NULL AND l.hadm_id IS NOT NULL
  AND TRY_CAST(l.charttime AS TIMESTAMP) IS NOT NULL AND l.valuenum BETWEEN 0.3 AND 15"""
VIEWS["v_clean_outputs"] = """
SELECT DISTINCT o.itemid, o.subject_id, o.hadm_id, o.stay_id, o.charttime, o.value AS urine_output_ml,
       o.valueuom, TRY_CAST(o.charttime AS TIMESTAMP) AS event_time, d.label AS output_label
FROM v_hosp_outputs o
JOIN (SELECT DISTINCT itemid, label FROM fx_d_items
      WHERE regexp_matches(label, 'urine|foley|void', 'i')) d ON o.itemid = d.itemid
WHERE o.subject_id IS NOT NULL AND o.hadm_id IS NOT NULL AND o.stay_id IS NOT NULL
  AND TRY_CAST(o.charttime AS TIMESTAMP) IS NOT NULL AND o.value BETWEEN 0 AND 5000"""

# Second cohort.
VIEWS["v_patients"] = """
SELECT * FROM fx_patients_raw
WHERE patientunitstayid IS NOT NULL AND age BETWEEN 0 AND 120 AND admissionweight BETWEEN 30 AND 250"""
VIEWS["v_lab"] = """
SELECT * FROM (SELECT event_id, patientunitstayid, coalesce(lower(trim(labname)), 'nan') AS labname,
                      labresultoffset, labresult FROM fx_lab)
WHERE patientunitstayid IS NOT NULL AND labresultoffset IS NOT NULL AND labresult IS NOT NULL
  AND (labname <> 'creatinine' OR labresult BETWEEN 0.3 AND 15.0)"""
VIEWS["v_intake"] = "SELECT * FROM fx_intake WHERE cellvaluenumeric BETWEEN 0 AND 5000"
VIEWS["v_off_creat"] = """
SELECT l.event_id, l.patientunitstayid, l.labname, l.labresultoffset, l.labresult AS creatinine,
       TIMESTAMP '2022-01-01 00:00:00' + to_minutes(l.labresultoffset) AS event_time,
       p.uniquepid, p.hospitalid, p.region, p.unittype, p.age, p.gender, p.ethnicity, p.admissionweight,
       p.apacheadmissiondx
FROM v_lab l LEFT JOIN v_patients p ON l.patientunitstayid = p.patientunitstayid
WHERE l.labname = 'creatinine'"""
VIEWS["v_off_urine"] = """
SELECT i.event_id, i.patientunitstayid, i.intakeoutputoffset, i.cellvaluenumeric AS urine_output_ml,
       TIMESTAMP '2022-01-01 00:00:00' + to_minutes(i.intakeoutputoffset) AS event_time,
       p.uniquepid, p.hospitalid, p.region, p.unittype, p.age, p.gender, p.ethnicity, p.admissionweight,
       p.apacheadmissiondx
FROM v_intake i LEFT JOIN v_patients p ON i.patientunitstayid = p.patientunitstayid"""


@query("stage_labs", "SELECT * FROM v_stg_labs")
def _(spark, sf):
    return staging.stage_labs(fixtures.labs_raw(spark, sf))


@query("stage_outputs", "SELECT * FROM v_stg_outputs")
def _(spark, sf):
    return staging.stage_outputs(fixtures.outputs_raw(spark, sf))


@query("stage_stays", "SELECT * FROM v_stg_stays")
def _(spark, sf):
    return staging.stage_stays(fixtures.stays_raw(spark, sf))


@query("icu_cohort", "SELECT * FROM v_cohort")
def _(spark, sf):
    return b.warehouse(spark, sf).cohort


@query("clean_labs_by_label", "SELECT * FROM v_clean_labs")
def _(spark, sf):
    return b.hospital_creatinine(spark, sf)


@query("clean_outputs_by_label", "SELECT * FROM v_clean_outputs")
def _(spark, sf):
    return b.hospital_urine(spark, sf)


@query("clean_patients", "SELECT * FROM v_patients")
def _(spark, sf):
    return staging.clean_patients(fixtures.patients_raw(spark, sf))


@query("conditional_range_filter", "SELECT * FROM v_lab")
def _(spark, sf):
    return staging.conditional_range_filter(fixtures.lab(spark, sf))


@query("clean_intake", "SELECT * FROM v_intake")
def _(spark, sf):
    return staging.clean_intake(fixtures.intake(spark, sf))


@query("dedup_rows", "SELECT DISTINCT subject_id, charttime, event_type, value, uom FROM fx_live")
def _(spark, sf):
    return staging.dedup_rows(
        fixtures.live_events(spark, sf).select("subject_id", "charttime", "event_type", "value", "uom")
    )


@query(
    "to_event_timeline",
    """SELECT subject_id, hadm_id, event_time, 'creatinine' AS event_type, creatinine AS value, 'mg/dL' AS unit
       FROM v_clean_labs""",
)
def _(spark, sf):
    return staging.to_event_timeline(
        b.hospital_creatinine(spark, sf), ["subject_id", "hadm_id"], "creatinine", "creatinine", "mg/dL"
    )


@query(
    "offset_to_time",
    """SELECT event_id, labresultoffset, TIMESTAMP '2022-01-01 00:00:00' + to_minutes(labresultoffset) AS event_time
       FROM fx_lab""",
)
def _(spark, sf):
    return fixtures.lab(spark, sf).select(
        "event_id", "labresultoffset", staging.offset_to_time("labresultoffset").alias("event_time")
    )


VIEWS["v_offset_hourly"] = """
SELECT coalesce(c.patientunitstayid, u.patientunitstayid) AS patientunitstayid,
       coalesce(c.admissionweight, u.admissionweight) AS admissionweight,
       coalesce(c.hospitalid, u.hospitalid) AS hospitalid, coalesce(c.age, u.age) AS age,
       coalesce(c.gender, u.gender) AS gender, coalesce(c.hour_bucket, u.hour_bucket) AS hour_bucket,
       c.creatinine, u.urine_output_ml
FROM (SELECT patientunitstayid, admissionweight, hospitalid, age, gender,
             date_trunc('hour', event_time) AS hour_bucket, last(creatinine ORDER BY event_time, event_id) AS creatinine
      FROM v_off_creat WHERE creatinine IS NOT NULL AND admissionweight IS NOT NULL AND hospitalid IS NOT NULL
        AND age IS NOT NULL AND gender IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6) c
FULL OUTER JOIN
     (SELECT patientunitstayid, admissionweight, hospitalid, age, gender,
             date_trunc('hour', event_time) AS hour_bucket, sum(urine_output_ml) AS urine_output_ml
      FROM v_off_urine WHERE admissionweight IS NOT NULL AND hospitalid IS NOT NULL
        AND age IS NOT NULL AND gender IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6) u
  ON c.patientunitstayid = u.patientunitstayid AND c.admissionweight = u.admissionweight
 AND c.hospitalid = u.hospitalid AND c.age = u.age AND c.gender = u.gender AND c.hour_bucket = u.hour_bucket"""


def engineered(source: str, key: str, weight: str, order: str) -> str:
    """Feature columns over a table of hours."""
    w = f"OVER (PARTITION BY {key} ORDER BY {order}"
    sums = ", ".join(
        f"sum(urine_output_ml) {w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS urine_ml_{n}h" for n in (6, 12, 24)
    )
    rates = ", ".join(f"urine_ml_{n}h / ({weight} * {n}) AS urine_ml_per_kg_hr_{n}h" for n in (6, 12, 24))
    return f"""
SELECT *, creatinine / nullif(baseline_creatinine, 0) AS creatinine_ratio,
       creatinine - creatinine_prev_1h AS creatinine_delta_1h,
       creatinine - creatinine_prev_48h AS creatinine_delta_48h, {rates}
FROM (SELECT *, min(creatinine) OVER (PARTITION BY {key}) AS baseline_creatinine,
             lag(creatinine, 1) {w}) AS creatinine_prev_1h, lag(creatinine, 48) {w}) AS creatinine_prev_48h, {sums}
      FROM (SELECT * REPLACE (coalesce(urine_output_ml, 0) AS urine_output_ml) FROM {source}))"""


VIEWS["v_offset_features"] = engineered("v_offset_hourly", "patientunitstayid", "admissionweight", "hour_bucket")
VIEWS["v_offset_labeled"] = """
SELECT *, CASE WHEN creatinine_ratio >= 3.0 THEN 3 WHEN creatinine >= 4.0 THEN 3
               WHEN urine_ml_per_kg_hr_24h < 0.3 THEN 3 WHEN creatinine_ratio >= 2.0 THEN 2
               WHEN urine_ml_per_kg_hr_12h < 0.5 THEN 2 WHEN creatinine_delta_48h >= 0.3 THEN 1
               WHEN creatinine_ratio >= 1.5 THEN 1 WHEN urine_ml_per_kg_hr_6h < 0.5 THEN 1
               ELSE 0 END AS kdigo_stage
FROM v_offset_features"""
VIEWS["v_training_rows"] = """
SELECT * EXCLUDE (nxt), CASE WHEN kdigo_stage < 3 AND future_max_stage_48h >= 3 THEN 1 ELSE 0 END
         AS target_progress_to_stage3_48h
FROM (SELECT *, max(nxt) OVER (PARTITION BY patientunitstayid ORDER BY hour_bucket
                               ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS future_max_stage_48h
      FROM (SELECT *, lead(kdigo_stage, 1) OVER (PARTITION BY patientunitstayid ORDER BY hour_bucket) AS nxt
            FROM v_offset_labeled))"""
FEATURE_LIST = ", ".join(config.FEATURES)
VIEWS["v_training_set"] = f"""
SELECT patientunitstayid, hour_bucket, kdigo_stage, target_progress_to_stage3_48h, {FEATURE_LIST},
       patientunitstayid || '|' || strftime(hour_bucket, '%Y%m%d%H') AS row_key
FROM v_training_rows"""


@query("kdigo_rules_full", "SELECT patientunitstayid, hour_bucket, kdigo_stage FROM v_offset_labeled")
def _(spark, sf):
    features = series.engineer(b.offset_hourly(spark, sf), "patientunitstayid")
    return series.label_stages(features).select("patientunitstayid", "hour_bucket", "kdigo_stage")


@query("kdigo_rules_hourly", "SELECT * FROM v_hourly")
def _(spark, sf):
    return b.warehouse(spark, sf).stages


VIEWS["v_live_pairs"] = """
SELECT id, round(prob * 4, 3) AS cr_ratio, prob - 0.5 AS cr_delta_recent,
       CASE WHEN id % 7 = 0 THEN NULL ELSE prob END AS uo_ml_kg_hr_6h FROM fx_scores"""


def _pairs(spark, sf):
    """Ratios, rises and rates spread over every rule's thresholds."""
    p = F.col("prob")
    return fixtures.scores(spark, sf).select(
        "id",
        F.round(p * 4, 3).alias("cr_ratio"),
        (p - 0.5).alias("cr_delta_recent"),
        F.when(F.col("id") % 7 != 0, p).alias("uo_ml_kg_hr_6h"),
    )


@query(
    "kdigo_rules_live",
    """SELECT id, cr_ratio, uo_ml_kg_hr_6h,
       greatest(CASE WHEN cr_ratio >= 3 THEN 3 WHEN cr_ratio >= 2 THEN 2 WHEN cr_ratio >= 1.5 THEN 1 ELSE 0 END,
                CASE WHEN uo_ml_kg_hr_6h < 0.3 THEN 3 WHEN uo_ml_kg_hr_6h < 0.5 THEN 2 ELSE 0 END) AS kdigo_stage
       FROM v_live_pairs""",
)
def _(spark, sf):
    return _pairs(spark, sf).select("id", "cr_ratio", "uo_ml_kg_hr_6h", rules.kdigo_live().alias("kdigo_stage"))


VIEWS["v_score"] = """
SELECT id, least(round(coalesce(least(cr_ratio * 20, 50.0), 0)
   + CASE WHEN cr_delta_recent > 0.3 THEN 15.0 WHEN cr_delta_recent > 0.1 THEN 8.0 ELSE 0.0 END
   + CASE WHEN uo_ml_kg_hr_6h < 0.3 THEN 30.0 WHEN uo_ml_kg_hr_6h < 0.5 THEN 15.0 ELSE 0.0 END, 1), 100.0)::DOUBLE
   AS anomaly_score FROM v_live_pairs"""


@query("anomaly_score", "SELECT * FROM v_score")
def _(spark, sf):
    return _pairs(spark, sf).select("id", rules.anomaly_score().alias("anomaly_score"))


@query(
    "risk_band",
    """SELECT CASE WHEN anomaly_score >= 60 THEN 'high' WHEN anomaly_score >= 30 THEN 'medium' ELSE 'low' END
         AS risk_band, count(*) AS n FROM v_score GROUP BY 1""",
)
def _(spark, sf):
    scored = _pairs(spark, sf).withColumn("anomaly_score", rules.anomaly_score())
    return scored.groupBy(rules.risk_band().alias("risk_band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "rrt_flag",
    """SELECT doc_id, (coalesce(regexp_matches(text, 'dialysis|crrt|hemodialysis|license', 'i'), false))::INTEGER
         AS possible_rrt_flag, 0 AS flag_without_column FROM documents""",
)
def _(spark, sf):
    # The prose holds no dialysis text, so the pattern is widened by a word it does hold.
    return fixtures.table(spark, sf, "documents").select(
        "doc_id",
        rules.rrt_flag("text", config.DIALYSIS_PATTERN + "|license").alias("possible_rrt_flag"),
        rules.rrt_flag(None).alias("flag_without_column"),
    )


@query(
    "fill_defaults",
    """SELECT subject_id, hadm_id, stay_id, charttime, coalesce(creatinine_mg_dl, 0) AS creatinine_mg_dl,
       coalesce(urine_ml, 0) AS urine_ml, kdigo_stage FROM v_hourly""",
)
def _(spark, sf):
    return staging.fill_defaults(
        b.warehouse(spark, sf).stages, {"creatinine_mg_dl": 0.0, "urine_ml": 0.0}
    ).drop("kdigo_creat_stage", "kdigo_urine_stage")


AGE_BAND_SQL = """CASE WHEN age <= 0 OR age > 120 THEN NULL WHEN age <= 18 THEN '<18' WHEN age <= 30 THEN '18-30'
  WHEN age <= 40 THEN '30-40' WHEN age <= 50 THEN '40-50' WHEN age <= 60 THEN '50-60'
  WHEN age <= 70 THEN '60-70' WHEN age <= 80 THEN '70-80' WHEN age <= 120 THEN '80+' END"""


@query("age_band", f"SELECT patientunitstayid, age, {AGE_BAND_SQL} AS age_group FROM fx_patients_raw")
def _(spark, sf):
    return fixtures.patients_raw(spark, sf).select(
        "patientunitstayid", "age", rules.age_band().alias("age_group")
    )


@query(
    "stage_label",
    """SELECT stay_id, charttime, CASE WHEN rolling_max_kdigo >= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
       FROM v_features""",
)
def _(spark, sf):
    return b.warehouse(spark, sf).features.select(
        "stay_id", "charttime", rules.stage_label(dtype="double").alias("label")
    )


@query("training_mart", "SELECT * FROM v_mart")
def _(spark, sf):
    return b.warehouse(spark, sf).mart


@query("training_projection", "SELECT * EXCLUDE (row_key) FROM v_training_set")
def _(spark, sf):
    return series.training_projection(b.training_rows(spark, sf))


@query("normalize_column_names", "SELECT c_custkey AS custkey, c_name AS name FROM customer")
def _(spark, sf):
    upper = fixtures.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CUSTKEY"), F.col("c_name").alias("NAME")
    )
    return staging.normalize_column_names(upper)


@query(
    "normalize_units",
    """SELECT labevent_id, CASE WHEN valueuom = 'umol/L' THEN TRY_CAST(valuenum AS DOUBLE) * 0.0113
         ELSE TRY_CAST(valuenum AS DOUBLE) END AS valuenum, 'mg/dL' AS valueuom FROM fx_labs_raw""",
)
def _(spark, sf):
    labs = fixtures.labs_raw(spark, sf).select(
        "labevent_id", F.col("valuenum").try_cast("double").alias("valuenum"), "valueuom"
    )
    # Fixed value: mg/dL of creatinine per umol/L.
    factors = labs.select(F.col("valueuom").alias("unit")).distinct().select(
        "unit", F.when(F.col("unit") == "umol/L", 0.0113).alias("factor")
    )
    return staging.normalize_units(labs, factors.filter("factor is not null"), "valuenum")


@query(
    "union_all_events",
    """SELECT subject_id, hadm_id, stay_id, charttime, creatinine_mg_dl, NULL::DOUBLE AS urine_ml,
         'creatinine' AS event_type FROM v_creat
       UNION ALL SELECT subject_id, hadm_id, stay_id, charttime, NULL, urine_ml, 'urine' FROM v_urine""",
)
def _(spark, sf):
    return b.warehouse(spark, sf).events


VIEWS["v_timeline"] = """
SELECT subject_id, hadm_id, event_time, 'creatinine' AS event_type, creatinine AS value, 'mg/dL' AS unit,
       NULL::BIGINT AS stay_id FROM v_clean_labs
UNION ALL
SELECT subject_id, hadm_id, event_time, 'urine_output', urine_output_ml, 'mL', stay_id FROM v_clean_outputs"""


@query("union_missing_columns", "SELECT * FROM v_timeline")
def _(spark, sf):
    return cohort.hospital_timeline(b.hospital_creatinine(spark, sf), b.hospital_urine(spark, sf))


@query(
    "offset_timeline",
    """SELECT patientunitstayid, uniquepid, hospitalid, age, gender, ethnicity, admissionweight, unittype,
         apacheadmissiondx, event_time, 'creatinine' AS event_type, creatinine AS value, 'mg/dL' AS unit
       FROM v_off_creat
       UNION ALL SELECT patientunitstayid, uniquepid, hospitalid, age, gender, ethnicity, admissionweight,
         unittype, apacheadmissiondx, event_time, 'urine_output', urine_output_ml, 'mL' FROM v_off_urine""",
)
def _(spark, sf):
    return cohort.offset_timeline(b.offset_creatinine(spark, sf), b.offset_urine(spark, sf))


@query("timeline_sort", "SELECT * FROM v_timeline ORDER BY subject_id, event_time, event_type")
def _(spark, sf):
    timeline = cohort.hospital_timeline(b.hospital_creatinine(spark, sf), b.hospital_urine(spark, sf))
    return staging.timeline_sort(timeline, ["subject_id", "event_time", "event_type"])


@query(
    "key_intersection",
    "SELECT hadm_id FROM fx_labs_raw WHERE hadm_id IS NOT NULL INTERSECT SELECT hadm_id FROM fx_admissions_raw",
)
def _(spark, sf):
    from tidewatch.operators.joins import key_intersection

    return key_intersection(fixtures.labs_raw(spark, sf), fixtures.admissions_raw(spark, sf), "hadm_id")


@query(
    "json_samples",
    """SELECT CASE WHEN contains(event_type, 'creat') THEN 'creatinine' WHEN contains(event_type, 'urine') THEN 'urine'
         ELSE 'other' END AS measure, count(*) AS n, round(avg(value), 6) AS avg_value FROM fx_live GROUP BY 1""",
)
def _(spark, sf):
    from tidewatch.sources.metrics import sample_rows

    sample = F.array(F.struct("value", "event_type")).alias("sample")
    log = fixtures.live_events(spark, sf).select(F.to_json(F.struct(sample)).alias("extra_json"))
    return (
        sample_rows(log)
        .groupBy("measure")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("avg_value"))
    )


@query(
    "json_props",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
)
def _(spark, sf):
    return fixtures.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k int").getField("k").alias("k")
    )
