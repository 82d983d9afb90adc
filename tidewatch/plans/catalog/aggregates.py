"""Baselines, hours, distributions, histograms and fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators import evaluate, hourly, quality, sketches
from tidewatch.plans import bindings as b
from tidewatch.plans import cohort, fixtures
from tidewatch.plans.catalog import joining  # noqa: F401
from tidewatch.plans.oracle import hash32
from tidewatch.plans.registry import query
from tidewatch.sources import layers


@query("baseline_min", "SELECT stay_id, min(creatinine_mg_dl) AS baseline_creatinine FROM v_creat GROUP BY stay_id")
def _(spark, sf):
    return hourly.baseline_min(b.warehouse(spark, sf).creatinine)


@query(
    "hourly_max",
    """SELECT subject_id, hadm_id, stay_id, date_trunc('hour', charttime) AS chart_hour,
         max(creatinine_mg_dl) AS creatinine_mg_dl FROM v_creat GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    return hourly.hourly_max(b.warehouse(spark, sf).creatinine)


@query(
    "hourly_max_with_baseline",
    """SELECT subject_id, hadm_id, stay_id, date_trunc('hour', charttime) AS chart_hour,
         max(creatinine_mg_dl) AS creatinine_mg_dl, any_value(base) AS baseline_creatinine
       FROM (SELECT *, min(creatinine_mg_dl) OVER (PARTITION BY stay_id) AS base FROM v_creat)
       GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    return hourly.hourly_creatinine(b.warehouse(spark, sf).creatinine)


@query(
    "hourly_sum",
    """SELECT subject_id, hadm_id, stay_id, date_trunc('hour', charttime) AS chart_hour,
         sum(urine_ml) AS urine_ml FROM v_urine GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    return hourly.hourly_sum(b.warehouse(spark, sf).urine)


@query(
    "hourly_last",
    """SELECT subject_id, hadm_id, date_trunc('hour', event_time) AS hour_bucket,
         last(creatinine ORDER BY event_time, labevent_id) AS creatinine FROM v_clean_labs GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    return hourly.hourly_last(
        b.hospital_creatinine(spark, sf), ["subject_id", "hadm_id"], "creatinine", "labevent_id"
    )


@query(
    "hourly_sum_by_demographics",
    """SELECT patientunitstayid, admissionweight, hospitalid, age, gender,
         date_trunc('hour', event_time) AS hour_bucket, sum(urine_output_ml) AS urine_output_ml
       FROM v_off_urine WHERE admissionweight IS NOT NULL AND hospitalid IS NOT NULL AND age IS NOT NULL
         AND gender IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _(spark, sf):
    return hourly.hourly_sum_by(b.offset_urine(spark, sf), cohort.OFFSET_HOUR_KEYS, "urine_output_ml")


@query("stage_distribution", "SELECT kdigo_stage, count(*) AS row_count FROM v_hourly GROUP BY kdigo_stage")
def _(spark, sf):
    return quality.stage_distribution(b.warehouse(spark, sf).stages)


@query(
    "plausibility_stats",
    """SELECT 'creatinine_mg_dl' AS measure, min(creatinine_mg_dl) AS min_value, max(creatinine_mg_dl) AS max_value,
         round(avg(creatinine_mg_dl), 6) AS avg_value FROM v_hourly
       UNION ALL SELECT 'urine_ml', min(urine_ml), max(urine_ml), round(avg(urine_ml), 6) FROM v_hourly""",
)
def _(spark, sf):
    return quality.plausibility_stats(b.warehouse(spark, sf).stages, ["creatinine_mg_dl", "urine_ml"])


@query(
    "layer_row_counts",
    """SELECT 'bronze.labevents' AS table_name, count(*) AS row_count FROM fx_labs_raw
       UNION ALL SELECT 'bronze.outputevents', count(*) FROM fx_outputs_raw
       UNION ALL SELECT 'silver.creatinine_events', count(*) FROM v_creat
       UNION ALL SELECT 'silver.urine_events', count(*) FROM v_urine
       UNION ALL SELECT 'gold.kdigo_hourly', count(*) FROM v_hourly
       UNION ALL SELECT 'mart.training_dataset', count(*) FROM v_mart""",
)
def _(spark, sf):
    w = b.warehouse(spark, sf)
    return layers.layer_row_counts(
        {
            "bronze.labevents": w.labs_raw,
            "bronze.outputevents": w.outputs_raw,
            "silver.creatinine_events": w.creatinine,
            "silver.urine_events": w.urine,
            "gold.kdigo_hourly": w.written_stages,
            "mart.training_dataset": w.mart,
        }
    )


@query(
    "metric_rollup",
    """SELECT event_type AS metric_name, count(*) AS n, round(avg(value), 2) AS avg_value FROM events GROUP BY 1""",
)
def _(spark, sf):
    log = fixtures.table(spark, sf, "events").select(
        F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value")
    )
    return quality.metric_rollup(log)


@query(
    "distribution_params",
    """SELECT round(coalesce(nullif(avg(creatinine_mg_dl), 0), 1.0), 6) AS creat_mean,
         round(coalesce(nullif(stddev_samp(creatinine_mg_dl), 0), 0.3), 6) AS creat_std,
         round(coalesce(nullif(avg(urine_ml), 0), 50.0), 6) AS urine_mean,
         round(coalesce(nullif(stddev_samp(urine_ml), 0), 20.0), 6) AS urine_std FROM v_kdigo_events""",
)
def _(spark, sf):
    columns = {
        "creat_mean": ("avg", "creatinine_mg_dl"),
        "creat_std": ("stddev_samp", "creatinine_mg_dl"),
        "urine_mean": ("avg", "urine_ml"),
        "urine_std": ("stddev_samp", "urine_ml"),
    }
    return sketches.distribution_params(
        b.warehouse(spark, sf).events, columns, config.DISTRIBUTION_DEFAULTS
    )


CORRELATED = [*config.FEATURES, config.TARGET]


def _pairs(fn: str, out: str, diagonal: bool, names=config.FEATURES) -> str:
    names = list(names)
    cells = [(x, y) for i, x in enumerate(names) for y in names[i + 1 :]]
    cells += [(x, x) for x in names] if diagonal else []
    return " UNION ALL ".join(
        f"SELECT '{x}' AS a, '{y}' AS b, round({fn}({x}, {y}), 6) AS {out} FROM v_training_set" for x, y in cells
    )


@query("correlation_matrix", _pairs("corr", "corr", False, CORRELATED))
def _(spark, sf):
    return evaluate.correlation_matrix(b.training_set(spark, sf), CORRELATED)


@query("covariance_matrix", _pairs("covar_samp", "cov", True))
def _(spark, sf):
    return evaluate.covariance_matrix(b.training_set(spark, sf), config.FEATURES)


def _bucket(x: str, low: float, high: float, bins: int) -> str:
    return f"""CASE WHEN {x} < {low} THEN 0 WHEN {x} >= {high} THEN {bins + 1}
      ELSE (floor(({x} - {low}::DOUBLE) * {float(bins)}::DOUBLE / {high - low}::DOUBLE) + 1)::INTEGER END"""


# Bounds of the features' histograms, low and high; what lies outside has buckets of its own.
BOUNDS = {
    "creatinine": (0.0, 20.0), "baseline_creatinine": (0.0, 20.0), "creatinine_ratio": (0.0, 10.0),
    "creatinine_delta_1h": (-10.0, 10.0), "creatinine_delta_48h": (-10.0, 10.0), "urine_output_ml": (0.0, 1000.0),
    "urine_ml_per_kg_hr_6h": (0.0, 5.0), "urine_ml_per_kg_hr_12h": (0.0, 5.0), "urine_ml_per_kg_hr_24h": (0.0, 5.0),
}
HISTOGRAMS = [(c, *BOUNDS[c]) for c in config.FEATURES]


@query(
    "feature_histogram",
    " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {_bucket(x, lo, hi, 20)} AS bucket, count(*) AS n "
        f"FROM v_training_set WHERE {x} IS NOT NULL GROUP BY 2"
        for x, lo, hi in HISTOGRAMS
    ),
)
def _(spark, sf):
    return evaluate.feature_histograms(b.training_set(spark, sf), {x: (lo, hi) for x, lo, hi in HISTOGRAMS}, 20)


@query(
    "distribution_compare",
    f"""SELECT bucket, n_first, n_second, round(n_first / t1, 6) AS share_first, round(n_second / t2, 6) AS share_second,
         CASE WHEN n_first > 0 AND n_second > 0
              THEN round((n_second / t2 - n_first / t1) * ln((n_second / t2) / (n_first / t1)), 6) END AS psi_part
       FROM (SELECT *, sum(n_first) OVER () AS t1, sum(n_second) OVER () AS t2
             FROM (SELECT {_bucket("v", 0.0, 10.0, 25)} AS bucket, count(*) FILTER (WHERE src = 1) AS n_first,
                          count(*) FILTER (WHERE src = 2) AS n_second
                   FROM (SELECT creatinine AS v, 1 AS src FROM v_training_set WHERE creatinine IS NOT NULL
                         UNION ALL SELECT value, 2 FROM fx_live WHERE event_type = 'creatinine' AND value IS NOT NULL)
                   GROUP BY 1))""",
)
def _(spark, sf):
    live = fixtures.live_events(spark, sf).filter(F.col("event_type") == "creatinine")
    return evaluate.distribution_compare(
        b.training_set(spark, sf).select("creatinine"),
        live.select(F.col("value").alias("creatinine")),
        "creatinine",
        0.0,
        10.0,
        25,
    )


def _text(columns, doubles):
    parts = [f"coalesce({c}::VARCHAR, '~')" for c in columns]
    parts += [f"coalesce(round({c} * 1000000)::BIGINT::VARCHAR, '~')" for c in doubles]
    return "concat_ws('|', " + ", ".join(parts) + ")"


def fingerprint(integers, source):
    """Row count and both halves of the row hashes, summed."""
    text = _text(integers, config.FEATURES)
    return f"""
SELECT count(*) AS row_count, coalesce(sum(h >> 26), 0)::BIGINT || '.' || coalesce(sum(h & 67108863), 0)::BIGINT AS hash_sum
FROM (SELECT ('0x' || substr(md5({text}), 1, 13))::BIGINT AS h FROM {source})"""


@query(
    "dataset_fingerprint",
    f"""SELECT row_count, hash_sum, substr(md5(row_count || '|' || hash_sum), 1, 8) AS version
        FROM ({fingerprint(["patientunitstayid", "kdigo_stage", config.TARGET], "v_training_set")})""",
)
def _(spark, sf):
    return evaluate.dataset_fingerprint(
        b.training_set(spark, sf), ["patientunitstayid", "kdigo_stage", config.TARGET], config.FEATURES
    )


@query(
    "limited_read",
    "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 100",
)
def _(spark, sf):
    rows = fixtures.table(spark, sf, "events").select("event_id", "user_id", "value")
    ranked = rows.withColumn("_down", -F.col("value"))
    return layers.limited_read(ranked, 100, "_down", "event_id").drop("_down")


@query(
    "reservoir_sample",
    """SELECT event_id, user_id, event_type, value FROM events
       ORDER BY ('0x' || substr(md5('42:' || event_id), 1, 13))::BIGINT, event_id LIMIT 200""",
)
def _(spark, sf):
    rows = fixtures.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return sketches.reservoir_sample(rows, 200, "event_id")


@query(
    "distinct_estimate",
    f"""SELECT (2 ** coalesce(max(CASE WHEN h <> 0 THEN bit_count((h & -h) - 1) END), 0))::BIGINT AS estimate,
          count(DISTINCT subject_id) AS exact
        FROM (SELECT subject_id, {hash32("subject_id::VARCHAR")} AS h FROM fx_live)""",
)
def _(spark, sf):
    live = fixtures.live_events(spark, sf)
    estimate = sketches.distinct_estimate(live, "subject_id")
    exact = live.agg(F.count_distinct("subject_id")).scalar()
    return estimate.withColumn("exact", exact)
