"""Interval joins, outer joins, key overlaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import hourly, joins, privacy, series, staging
from tidewatch.plans import bindings as b
from tidewatch.plans import fixtures
from tidewatch.plans.catalog import projections  # noqa: F401
from tidewatch.plans.oracle import VIEWS
from tidewatch.plans.registry import query


@query("window_join_labs", "SELECT * FROM v_creat")
def _(spark, sf):
    return b.warehouse(spark, sf).creatinine


@query("window_join_outputs", "SELECT * FROM v_urine")
def _(spark, sf):
    return b.warehouse(spark, sf).urine


VIEWS["v_kdigo_events"] = """
SELECT subject_id, hadm_id, stay_id, charttime, creatinine_mg_dl, NULL::DOUBLE AS urine_ml,
       'creatinine' AS event_type FROM v_creat
UNION ALL
SELECT subject_id, hadm_id, stay_id, charttime, NULL, urine_ml, 'urine' FROM v_urine"""


@query("kdigo_events", "SELECT * FROM v_kdigo_events")
def _(spark, sf):
    return b.warehouse(spark, sf).events


@query(
    "baseline_join",
    """SELECT c.*, m.baseline_creatinine FROM v_creat c
       JOIN (SELECT stay_id, min(creatinine_mg_dl) AS baseline_creatinine FROM v_creat GROUP BY stay_id) m
         ON c.stay_id = m.stay_id""",
)
def _(spark, sf):
    events = b.warehouse(spark, sf).creatinine
    return hourly.baseline_join(events, hourly.baseline_min(events))


@query(
    "hourly_outer_join",
    """SELECT coalesce(c.subject_id, u.subject_id) AS subject_id, coalesce(c.hadm_id, u.hadm_id) AS hadm_id,
              coalesce(c.hour_bucket, u.hour_bucket) AS hour_bucket, c.creatinine, u.stay_id, u.urine_output_ml
       FROM (SELECT subject_id, hadm_id, date_trunc('hour', event_time) AS hour_bucket,
                    last(creatinine ORDER BY event_time, labevent_id) AS creatinine
             FROM v_clean_labs GROUP BY 1, 2, 3) c
       FULL OUTER JOIN (SELECT subject_id, hadm_id, stay_id, date_trunc('hour', event_time) AS hour_bucket,
                    sum(urine_output_ml) AS urine_output_ml FROM v_clean_outputs GROUP BY 1, 2, 3, 4) u
         ON c.subject_id = u.subject_id AND c.hadm_id = u.hadm_id AND c.hour_bucket = u.hour_bucket""",
)
def _(spark, sf):
    return b.hospital_hourly(spark, sf)


@query(
    "cohort_left_join",
    "SELECT k.*, c.intime, c.los FROM v_hourly k LEFT JOIN v_cohort c ON k.stay_id = c.stay_id",
)
def _(spark, sf):
    w = b.warehouse(spark, sf)
    return joins.cohort_left_join(w.stages, w.cohort, ["intime", "los"])


@query("demographics_left_join", "SELECT * FROM v_off_creat")
def _(spark, sf):
    return b.offset_creatinine(spark, sf)


@query(
    "dictionary_join",
    """SELECT l.itemid, l.labevent_id, l.subject_id, l.hadm_id, l.charttime, l.valuenum, l.valueuom, d.label
       FROM v_hosp_labs l JOIN (SELECT DISTINCT itemid, label FROM fx_d_labitems) d ON l.itemid = d.itemid""",
)
def _(spark, sf):
    return staging.dictionary_join(b.hospital_labs(spark, sf), fixtures.d_labitems(spark, sf))


VIEWS["v_training_people"] = f"""
SELECT t.* EXCLUDE (age, gender), p.age, p.gender, p.ethnicity, p.unittype,
       {projections.AGE_BAND_SQL.replace("age ", "p.age ")} AS age_group
FROM v_training_rows t
LEFT JOIN (SELECT DISTINCT patientunitstayid, age, gender, ethnicity, unittype FROM fx_patients_raw) p
  ON t.patientunitstayid = p.patientunitstayid"""

VIEWS["v_scored_people"] = f"""
SELECT s.*, p.patientunitstayid, p.age, p.gender, p.unittype,
       {projections.AGE_BAND_SQL.replace("age ", "p.age ")} AS age_group,
       CASE WHEN s.prob >= 0.5 THEN 1 ELSE 0 END AS pred
FROM fx_scores s LEFT JOIN fx_patients_raw p ON s.user_id = p.patientunitstayid"""


@query(
    "group_semi_join",
    """SELECT id, age_group, gender, unittype FROM v_scored_people
       WHERE (age_group, gender, unittype) IN (
         SELECT (age_group, gender, unittype) FROM v_scored_people
         WHERE age_group IS NOT NULL AND gender IS NOT NULL AND unittype IS NOT NULL
         GROUP BY age_group, gender, unittype HAVING count(*) >= 70)
         AND age_group IS NOT NULL AND gender IS NOT NULL AND unittype IS NOT NULL""",
)
def _(spark, sf):
    people = b.scored_people(spark, sf).select("id", *privacy.QUASI_IDENTIFIERS)
    return joins.group_semi_join(people, privacy.QUASI_IDENTIFIERS, 70)


@query(
    "key_overlap",
    """SELECT count(*) FILTER (WHERE hadm_id IN (SELECT hadm_id FROM fx_admissions_raw WHERE hadm_id IS NOT NULL))
         AS matched, count(*) AS total
       FROM (SELECT DISTINCT hadm_id FROM fx_labs_raw WHERE hadm_id IS NOT NULL)""",
)
def _(spark, sf):
    return joins.key_overlap(fixtures.labs_raw(spark, sf), fixtures.admissions_raw(spark, sf), "hadm_id")


@query(
    "anti_join_excluded",
    "SELECT * FROM fx_labs_raw WHERE itemid <> '50971'",
)
def _(spark, sf):
    # The excluded list: items of the dictionary that are not creatinine.
    excluded = fixtures.d_labitems(spark, sf).filter(~F.lower("label").contains("creatinine")).select(
        F.col("itemid").cast("string").alias("itemid")
    )
    return staging.anti_join_excluded(fixtures.labs_raw(spark, sf), excluded)


@query(
    "referential_check",
    """SELECT itemid, count(*) AS rows FROM v_hosp_labs
       WHERE itemid NOT IN (SELECT itemid FROM fx_d_labitems WHERE label LIKE '%reatinine%')
       GROUP BY itemid""",
)
def _(spark, sf):
    dictionary = fixtures.d_labitems(spark, sf).filter(F.col("label").contains("reatinine"))
    return joins.referential_check(b.hospital_labs(spark, sf), dictionary)


@query(
    "join_diagnostics",
    """SELECT 'labs_to_stays' AS step, count(*) AS rows_in,
         count(*) FILTER (WHERE EXISTS (SELECT 1 FROM v_cohort c WHERE c.subject_id = e.subject_id
            AND c.hadm_id = e.hadm_id AND e.charttime BETWEEN c.intime AND c.outtime)) AS matched,
         count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM v_cohort c WHERE c.subject_id = e.subject_id
            AND c.hadm_id = e.hadm_id AND e.charttime BETWEEN c.intime AND c.outtime)) AS unmatched
       FROM v_stg_labs e
       UNION ALL
       SELECT 'outputs_to_stays', count(*),
         count(*) FILTER (WHERE EXISTS (SELECT 1 FROM v_cohort c WHERE c.stay_id = u.stay_id
            AND u.charttime BETWEEN c.intime AND c.outtime)),
         count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM v_cohort c WHERE c.stay_id = u.stay_id
            AND u.charttime BETWEEN c.intime AND c.outtime))
       FROM v_stg_outputs u""",
)
def _(spark, sf):
    w = b.warehouse(spark, sf)
    return joins.join_diagnostics(
        w.labs, w.cohort, ["subject_id", "hadm_id"], "labs_to_stays"
    ).unionByName(joins.join_diagnostics(w.outputs, w.cohort, ["stay_id"], "outputs_to_stays"))


@query(
    "baseline_before_admission",
    """SELECT c.stay_id, count(*) AS readings, min(e.creatinine_mg_dl) AS baseline_creatinine
       FROM v_cohort c JOIN v_stg_labs e ON c.subject_id = e.subject_id AND c.hadm_id = e.hadm_id
        AND e.charttime < c.intime GROUP BY c.stay_id""",
)
def _(spark, sf):
    w = b.warehouse(spark, sf)
    return series.baseline_before_admission(w.labs, w.cohort)
