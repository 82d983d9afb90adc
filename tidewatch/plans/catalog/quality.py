"""Gate, quarantine, column tests, profiles, privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators import privacy, quality, series
from tidewatch.plans import bindings as b
from tidewatch.plans import fixtures
from tidewatch.plans.catalog import joining, windows  # noqa: F401
from tidewatch.plans.catalog.inputs import layer_database
from tidewatch.plans.oracle import VIEWS, exact_mean, hash32
from tidewatch.plans.registry import query
from tidewatch.session import work_dir
from tidewatch.plans.warehouse import Warehouse
from tidewatch.sources import layers
from tidewatch.sources.layers import settle
from tidewatch.streaming import sinks, sources


def _missing(columns, conditions=None):
    conditions = conditions or {}
    parts = [
        f"CASE WHEN ({c} IS NULL OR trim({c}) = ''){' AND ' + conditions[c] if c in conditions else ''} THEN '{c}' END"
        for c in columns
    ]
    return f"nullif(concat_ws(',', {', '.join(parts)}), '')"


_CR = "itemid IN ('50912', '51081', '52024', '52546')"
_UO = "itemid IN ('226559', '226560', '226561', '226567', '226627', '226631', '227489')"

VIEWS["v_gate_labs"] = f"""
SELECT *, CASE WHEN missing IS NOT NULL THEN 'missing_required:' || missing
    WHEN {_CR} AND valueuom = 'mg/dL' AND TRY_CAST(valuenum AS DOUBLE) NOT BETWEEN 0.1 AND 20.0
    THEN 'out_of_range:creatinine_mg/dL' END AS failure_reason
FROM (SELECT *, {_missing(config.REQUIRED_COLUMNS["labevents"], {"valuenum": _CR, "valueuom": _CR})} AS missing
      FROM fx_labs_raw)"""
VIEWS["v_gate_outputs"] = f"""
SELECT *, CASE WHEN missing IS NOT NULL THEN 'missing_required:' || missing
    WHEN {_UO} AND TRY_CAST(value AS DOUBLE) < 0 THEN 'out_of_range:urine_negative'
    WHEN {_UO} AND TRY_CAST(value AS DOUBLE) > 10000 THEN 'out_of_range:urine_too_large' END AS failure_reason
FROM (SELECT *, {_missing(config.REQUIRED_COLUMNS["outputevents"], {"value": _UO, "valueuom": _UO})} AS missing
      FROM fx_outputs_raw)"""
VIEWS["v_gate_admissions"] = f"""
SELECT *, CASE WHEN missing IS NOT NULL THEN 'missing_required:' || missing
    WHEN TRY_CAST(admittime AS TIMESTAMP) >= TRY_CAST(dischtime AS TIMESTAMP)
    THEN 'bad_time_order:admittime>=dischtime' END AS failure_reason
FROM (SELECT *, {_missing(config.REQUIRED_COLUMNS["admissions"])} AS missing FROM fx_admissions_raw)"""
VIEWS["v_gate_stays"] = f"""
SELECT *, CASE WHEN missing IS NOT NULL THEN 'missing_required:' || missing
    WHEN TRY_CAST(intime AS TIMESTAMP) >= TRY_CAST(outtime AS TIMESTAMP)
    THEN 'bad_time_order:intime>=outtime' END AS failure_reason
FROM (SELECT *, {_missing(config.REQUIRED_COLUMNS["icustays"])} AS missing FROM fx_stays_raw)"""
VIEWS["v_gate_d_labitems"] = """
SELECT *, CASE WHEN label IS NULL THEN 'missing_required:label' END AS failure_reason
FROM fx_d_labitems"""
VIEWS["v_gate_d_items"] = """
SELECT *, CASE WHEN label IS NULL THEN 'missing_required:label' END AS failure_reason
FROM fx_d_items"""
VIEWS["v_gate_patients"] = """
SELECT *, CASE WHEN subject_id IS NULL THEN 'missing_required:subject_id' END AS failure_reason
FROM fx_people_raw"""


@query(
    "quarantine_split",
    """SELECT labevent_id, itemid, failure_reason IS NULL AS passed, failure_reason FROM v_gate_labs""",
)
def _(spark, sf):
    passed, failed = quality.quarantine_split(fixtures.labs_raw(spark, sf), quality.standard_rules()["labevents"])
    return passed.select(
        "labevent_id", "itemid", F.lit(True).alias("passed"), F.lit(None).cast("string").alias("failure_reason")
    ).unionByName(failed.select("labevent_id", "itemid", F.lit(False).alias("passed"), "failure_reason"))


def _report(table: str, view: str) -> str:
    return f"""
SELECT '{table}' AS table_name, count(*) AS processed, count(*) FILTER (WHERE failure_reason IS NULL) AS passed,
       count(failure_reason) AS failed,
       round(count(*) FILTER (WHERE failure_reason IS NULL) * 100.0::DOUBLE / count(*), 2) AS passed_pct,
       coalesce((SELECT string_agg(failure_reason || '=' || n, ';' ORDER BY failure_reason)
          FROM (SELECT failure_reason, count(*) AS n FROM {view} WHERE failure_reason IS NOT NULL GROUP BY 1)), '')
         AS reasons
FROM {view}"""


@query(
    "gate_report",
    " UNION ALL ".join(
        [
            _report("labevents", "v_gate_labs"),
            _report("outputevents", "v_gate_outputs"),
            _report("admissions", "v_gate_admissions"),
            _report("icustays", "v_gate_stays"),
            _report("d_labitems", "v_gate_d_labitems"),
            _report("d_items", "v_gate_d_items"),
            _report("patients", "v_gate_patients"),
        ]
    ),
)
def _(spark, sf):
    tables = {
        "labevents": fixtures.labs_raw(spark, sf),
        "outputevents": fixtures.outputs_raw(spark, sf),
        "admissions": fixtures.admissions_raw(spark, sf),
        "icustays": fixtures.stays_raw(spark, sf),
        "d_labitems": fixtures.d_labitems(spark, sf).withColumn("itemid", F.col("itemid").cast("string")),
        "d_items": fixtures.d_items(spark, sf).withColumn("itemid", F.col("itemid").cast("string")),
        "patients": fixtures.people_raw(spark, sf),
    }
    rules = quality.standard_rules()
    reports = [quality.gate_report(df, rules[name], name) for name, df in tables.items()]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


GATE_CHECKS = """SELECT 'training_set' AS dataset, 'creatinine_range_valid' AS "check",
         bool_and(coalesce(creatinine BETWEEN 0.3 AND 15.0, false)) AS passed FROM v_training_set
       UNION ALL SELECT 'training_set', 'urine_non_negative', bool_and(coalesce(urine_output_ml >= 0, false)) FROM v_training_set
       UNION ALL SELECT 'training_set', 'no_missing_patient_ids', bool_and(patientunitstayid IS NOT NULL) FROM v_training_set
       UNION ALL SELECT 'training_set', 'valid_timestamps', true"""


@query("quality_gate_checks", GATE_CHECKS)
def _(spark, sf):
    return quality.quality_gate_checks(b.training_set(spark, sf), "training_set")


@query("gated_write", GATE_CHECKS)
def _(spark, sf):
    # Judged while it is written: no scan besides the write.
    return quality.gated_write(b.training_set(spark, sf), "training_set", work_dir(spark, "gated"))


@query("gated_stream", GATE_CHECKS)
def _(spark, sf):
    rows = b.training_set(spark, sf)
    path = work_dir(spark, "gated-stream")
    rows.write.parquet(f"{path}/in")
    stream = quality.observed_gate(sources.table_stream_source(spark, f"{path}/in", rows.schema))
    run = sinks.append_files(stream, f"{path}/out", f"{path}/checkpoint", available_now=True)
    run.awaitTermination()
    return quality.stream_verdicts(run, "training_set")


@query(
    "validation_summary",
    """SELECT 'second_cohort' AS dataset, count(*) AS row_count, count(DISTINCT patientunitstayid) AS unique_ids,
         count(*) FILTER (WHERE patientunitstayid IS NULL) AS missing_id_rows,
         count(*) FILTER (WHERE kdigo_stage NOT IN (0, 1, 2, 3)) AS invalid_kdigo_rows,
         count(*) FILTER (WHERE urine_output_ml < 0) AS negative_urine_rows,
         count(*) FILTER (WHERE creatinine < 0.3) AS low_creatinine_rows,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT patientunitstayid, hour_bucket FROM v_offset_labeled))
           AS duplicate_patient_hour_rows,
         count(*) FILTER (WHERE kdigo_stage = 0) AS stage_0_rows, count(*) FILTER (WHERE kdigo_stage = 1) AS stage_1_rows,
         count(*) FILTER (WHERE kdigo_stage = 2) AS stage_2_rows, count(*) FILTER (WHERE kdigo_stage = 3) AS stage_3_rows
       FROM v_offset_labeled""",
)
def _(spark, sf):
    labeled = series.label_stages(series.engineer(b.offset_hourly(spark, sf), "patientunitstayid"))
    return quality.validation_summary(labeled, "second_cohort", "patientunitstayid")


@query(
    "readiness_profile",
    f"""SELECT 'creatinine' AS measure, count(*) AS row_count, count(*) FILTER (WHERE subject_id IS NULL) AS subject_id_nulls,
          count(*) FILTER (WHERE hadm_id IS NULL) AS hadm_id_nulls, count(*) FILTER (WHERE charttime IS NULL) AS charttime_nulls,
          count(*) FILTER (WHERE valuenum IS NULL) AS value_nulls, count(DISTINCT trim(valueuom)) AS units,
          count(DISTINCT hadm_id) AS distinct_keys
        FROM fx_labs_raw WHERE {_CR} AND trim(valueuom) = 'mg/dL'
        UNION ALL
        SELECT 'urine', count(*), count(*) FILTER (WHERE subject_id IS NULL), count(*) FILTER (WHERE hadm_id IS NULL),
          count(*) FILTER (WHERE charttime IS NULL), count(*) FILTER (WHERE value IS NULL), count(DISTINCT trim(valueuom)),
          count(DISTINCT stay_id)
        FROM fx_outputs_raw WHERE {_UO}""",
)
def _(spark, sf):
    labs = quality.readiness_profile(
        fixtures.labs_raw(spark, sf).withColumnRenamed("valuenum", "value"),
        config.CREATININE_ITEMS, ["subject_id", "hadm_id", "charttime", "value"], "hadm_id", config.CREATININE_UNIT,
    )
    outputs = quality.readiness_profile(
        fixtures.outputs_raw(spark, sf),
        config.URINE_ITEMS, ["subject_id", "hadm_id", "charttime", "value"], "stay_id",
    )
    return labs.select(F.lit("creatinine").alias("measure"), "*").unionByName(
        outputs.select(F.lit("urine").alias("measure"), "*")
    )


@query(
    "dictionary_discovery",
    """SELECT 'creatinine' AS word, count(DISTINCT itemid) AS items FROM fx_d_labitems WHERE contains(lower(label), 'creatinine')
       UNION ALL SELECT 'urine', count(DISTINCT itemid) FROM fx_d_items
         WHERE contains(lower(label), 'urine') OR contains(lower(category), 'urine')""",
)
def _(spark, sf):
    return quality.dictionary_discovery(fixtures.d_labitems(spark, sf), "creatinine").unionByName(
        quality.dictionary_discovery(fixtures.d_items(spark, sf), "urine", ["label", "category"])
    )


@query(
    "unit_distribution",
    """SELECT itemid, valueuom, count(*) AS row_count, count(*) FILTER (WHERE valuenum IS NULL) AS missing_values
       FROM fx_labs_raw GROUP BY itemid, valueuom""",
)
def _(spark, sf):
    return quality.unit_distribution(fixtures.labs_raw(spark, sf))


@query(
    "missing_ratio_gate",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS key_column, round(avg(({c} IS NULL)::INTEGER), 6) AS missing_ratio,
              avg(({c} IS NULL)::INTEGER) <= 0.01 AS passed FROM fx_labs_raw"""
        for c in ("subject_id", "hadm_id", "itemid", "charttime", "valuenum")
    ),
)
def _(spark, sf):
    return quality.missing_ratio_gate(
        fixtures.labs_raw(spark, sf), ["subject_id", "hadm_id", "itemid", "charttime", "valuenum"]
    )


# The column tests of every silver and gold model.
NOT_NULL = {
    "silver_icu_cohort": ("v_cohort", ("stay_id", "subject_id", "hadm_id", "intime", "outtime")),
    "silver_creatinine_events": ("v_creat", ("stay_id", "charttime", "creatinine_mg_dl")),
    "silver_urine_output_events": ("v_urine", ("stay_id", "charttime", "urine_ml")),
    "gold_kdigo_hourly": ("v_hourly", ("stay_id", "charttime", "kdigo_stage")),
    "gold_features_hourly": ("v_features", ("stay_id", "charttime", "rolling_max_kdigo")),
}


@query(
    "not_null_test",
    " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {view}"
        for model, (view, columns) in NOT_NULL.items()
        for c in columns
    )
    + " UNION ALL SELECT 'gold_kdigo_hourly', 'creatinine_mg_dl', 'not_null', count(*) FILTER (WHERE creatinine_mg_dl IS NULL) FROM v_hourly",
)
def _(spark, sf):
    w = b.warehouse(spark, sf)
    models = {
        "silver_icu_cohort": w.cohort, "silver_creatinine_events": w.creatinine, "silver_urine_output_events": w.urine,
        "gold_kdigo_hourly": w.written_stages, "gold_features_hourly": w.features,
    }
    tests = None
    for model, (_, columns) in NOT_NULL.items():
        # One column more than the models promise: it has nulls, which shows that the test finds them.
        extra = ["creatinine_mg_dl"] if model == "gold_kdigo_hourly" else []
        own = quality.not_null_test(models[model], [*columns, *extra]).withColumn("model", F.lit(model))
        tests = own if tests is None else tests.unionByName(own)
    return tests


LAYERED = {
    "bronze": {"labevents": "fx_labs_raw", "outputevents": "fx_outputs_raw", "icustays": "fx_stays_raw"},
    "silver": {
        "silver_icu_cohort": "v_cohort", "silver_creatinine_events": "v_creat", "silver_urine_output_events": "v_urine",
    },
    "gold": {"gold_kdigo_hourly": "v_hourly", "gold_features_hourly": "v_features"},
    "mart": {"training_mart": "v_mart"},
}


def _nulls(name: str) -> str:
    columns = NOT_NULL[name][1] if name in NOT_NULL else ()
    return " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns) or "0"


@query(
    "layered_run",
    " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count, ({_nulls(name)})::BIGINT AS failures FROM {view}"
        for layer, tables in LAYERED.items()
        for name, view in tables.items()
    ),
)
def _(spark, sf):
    # Every layer is written, and the next one is made from its tables.
    for layer in LAYERED:
        layer_database(spark, layer)
    raw = (fixtures.labs_raw(spark, sf), fixtures.outputs_raw(spark, sf), fixtures.stays_raw(spark, sf))
    for name, df in zip(LAYERED["bronze"], raw, strict=True):
        layers.layer_write(df, "bronze", name)
    w = Warehouse(*[layers.layer_read(spark, "bronze", name) for name in LAYERED["bronze"]])
    models = {
        "silver_icu_cohort": w.cohort, "silver_creatinine_events": w.creatinine, "silver_urine_output_events": w.urine,
        "gold_kdigo_hourly": w.written_stages, "gold_features_hourly": w.features, "training_mart": w.mart,
    }
    report = None
    for layer, tables in LAYERED.items():
        for name in tables:
            if layer != "bronze":
                layers.layer_write(models[name], layer, name)
            table = layers.layer_read(spark, layer, name)
            nulls = F.lit(0).cast("bigint")
            for c in NOT_NULL[name][1] if name in NOT_NULL else ():
                nulls = nulls + F.count_if(F.col(c).isNull())
            own = table.agg(F.count(F.lit(1)).alias("row_count"), nulls.alias("failures")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count", "failures"
            )
            report = own if report is None else report.unionByName(own)
    return report


@query(
    "unique_test",
    """SELECT 'stay_id' AS column_name, 'unique' AS test, count(*) AS failures
       FROM (SELECT stay_id FROM v_cohort GROUP BY stay_id HAVING count(*) > 1)
       UNION ALL SELECT 'hadm_id', 'unique', count(*) FROM (SELECT hadm_id FROM v_cohort GROUP BY hadm_id HAVING count(*) > 1)""",
)
def _(spark, sf):
    cohort = b.warehouse(spark, sf).cohort
    return quality.unique_test(cohort, "stay_id").unionByName(quality.unique_test(cohort, "hadm_id"))


VIEWS["v_out"] = """
SELECT l.subject_id, l.charttime::TIMESTAMP AS charttime, l.arrival, s.prob * 1.001::DOUBLE AS prob,
       (l.arrival % 5)::INTEGER AS stage,
       max(l.charttime::TIMESTAMP) OVER (PARTITION BY l.subject_id ORDER BY l.arrival) AS latest
FROM fx_live l JOIN fx_scores s ON l.arrival % 1000000000 = s.id"""


@query(
    "output_gate",
    """SELECT 'score_in_range' AS rule, count(*) FILTER (WHERE prob < 0 OR prob > 1 OR prob IS NULL) AS violations FROM v_out
       UNION ALL SELECT 'keys_not_null', count(*) FILTER (WHERE subject_id IS NULL OR charttime IS NULL) FROM v_out
       UNION ALL SELECT 'stage_valid', count(*) FILTER (WHERE stage NOT IN (0, 1, 2, 3)) FROM v_out
       UNION ALL SELECT 'time_in_order', count(*) FILTER (WHERE charttime < latest) FROM v_out""",
)
def _(spark, sf):
    scores = fixtures.scores(spark, sf).select(F.col("id").alias("scored"), "prob")
    out = (
        b.live(spark, sf)
        .join(scores, F.col("arrival") % 1000000000 == F.col("scored"))
        .select(
            "subject_id", "arrival", (F.col("prob") * 1.001).alias("prob"),
            (F.col("arrival") % 5).cast("int").alias("stage"), F.col("event_time").alias("charttime"),
        )
    )
    return quality.output_gate(
        settle(out, "outputs"), ["subject_id", "charttime"], "charttime", "prob", "stage", "arrival"
    )


QI = ", ".join(privacy.QUASI_IDENTIFIERS)
VIEWS["v_k_groups"] = f"""
SELECT {QI}, count(*) AS group_size FROM v_training_people
WHERE age_group IS NOT NULL AND gender IS NOT NULL AND unittype IS NOT NULL GROUP BY {QI}"""
VIEWS["v_anonymized"] = f"""
SELECT t.* FROM v_training_people t JOIN v_k_groups g
  ON t.age_group = g.age_group AND t.gender = g.gender AND t.unittype = g.unittype WHERE g.group_size >= 40"""


@query("k_anonymize", "SELECT * FROM v_anonymized")
def _(spark, sf):
    return privacy.k_anonymize(b.training_people(spark, sf), k=40)


@query(
    "suppression_report",
    """SELECT 40 AS k, total_rows, kept_rows, total_rows - kept_rows AS suppressed_rows,
         round((total_rows - kept_rows) / total_rows::DOUBLE, 6) AS suppressed_share
       FROM (SELECT (SELECT count(*) FROM v_training_people) AS total_rows, (SELECT count(*) FROM v_anonymized) AS kept_rows)""",
)
def _(spark, sf):
    return privacy.suppression_report(b.training_people(spark, sf), k=40)


@query(
    "group_size_tag",
    """SELECT t.patientunitstayid, t.hour_bucket, coalesce(g.group_size, 0) AS group_size,
         'k=' || coalesce(g.group_size, 0) AS k_tag
       FROM v_training_people t LEFT JOIN v_k_groups g
         ON t.age_group = g.age_group AND t.gender = g.gender AND t.unittype = g.unittype""",
)
def _(spark, sf):
    people = b.training_people(spark, sf).select("patientunitstayid", "hour_bucket", *privacy.QUASI_IDENTIFIERS)
    return privacy.group_size_tag(people).drop(*privacy.QUASI_IDENTIFIERS)


CLIPPED = "CASE WHEN creatinine IS NOT NULL THEN greatest(least(creatinine, 5.0), 0.5) END"
VIEWS["v_dp"] = f"""
SELECT unittype, patient_count, mean, -((5.0 - 0.5) / 0.5 / patient_count) * sign(u) * ln(1 - 2 * abs(u)) AS noise
FROM (SELECT unittype, count(*) AS patient_count,
             {exact_mean(CLIPPED)} AS mean,
             ({hash32("unittype || '#42'")} + 0.5::DOUBLE) / 4294967296.0::DOUBLE - 0.5 AS u
      FROM v_training_people WHERE unittype IS NOT NULL GROUP BY unittype)"""


@query("dp_group_mean", "SELECT unittype, patient_count, round(mean + noise, 6) AS dp_mean FROM v_dp")
def _(spark, sf):
    return privacy.dp_group_mean(b.training_people(spark, sf), epsilon=0.5, seed=42)


@query(
    "dp_noise_report",
    """SELECT unittype, patient_count, round(mean + noise, 6) AS dp_mean, round(mean, 6) AS actual_mean,
         round(noise, 6) AS noise_added FROM v_dp""",
)
def _(spark, sf):
    return privacy.dp_noise_report(b.training_people(spark, sf), epsilon=0.5, seed=42)


@query(
    "dp_group_mean_without_noise",
    f"""SELECT unittype, count(*) AS patient_count, {exact_mean(CLIPPED)} AS dp_mean
       FROM v_training_people WHERE unittype IS NOT NULL GROUP BY unittype""",
)
def _(spark, sf):
    return privacy.dp_group_mean(b.training_people(spark, sf), epsilon=0, seed=42)



# 42 is a test value: a release draws its seed afresh and keeps it.
VIEWS["v_bounded"] = f"""
SELECT unittype, n, mean, 4.5::DOUBLE * CASE WHEN n > 10 THEN 5.0::DOUBLE / (n - 5) ELSE 1.0::DOUBLE END AS moved,
       ({hash32("unittype || '#42'")} + 0.5::DOUBLE) / 4294967296.0::DOUBLE - 0.5 AS u
FROM (SELECT unittype, count(*) AS n, {exact_mean(CLIPPED)} AS mean
      FROM (SELECT *, row_number() OVER (PARTITION BY patientunitstayid, unittype ORDER BY ('0x' || substr(md5(
                 '42|' || patientunitstayid || '|' || strftime(hour_bucket, '%Y-%m-%d %H:%M:%S')), 1, 13))::BIGINT, hour_bucket) AS turn
            FROM v_training_people WHERE unittype IS NOT NULL AND creatinine IS NOT NULL AND patientunitstayid IS NOT NULL)
      WHERE turn <= 5 GROUP BY unittype)"""


@query(
    "dp_person_mean",
    """SELECT unittype, n AS bounded_rows, round(moved, 9) AS sensitivity,
         round(mean - moved / 0.5 * sign(u) * ln(1 - 2 * abs(u)), 6) AS dp_mean FROM v_bounded""",
)
def _(spark, sf):
    people = b.training_people(spark, sf)
    return privacy.dp_person_mean(
        people, "unittype", "creatinine", "patientunitstayid", ["patientunitstayid", "hour_bucket"], 5, 0.5, seed=42
    )
