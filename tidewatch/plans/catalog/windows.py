"""Ordered series: features, targets, running values, live order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators import series, skew, sketches
from tidewatch.operators.hourly import hour
from tidewatch.plans import bindings as b
from tidewatch.plans import fixtures, warehouse
from tidewatch.plans.catalog import joining, projections  # noqa: F401
from tidewatch.plans.oracle import VIEWS, hash32
from tidewatch.plans.registry import query
from tidewatch.sources.layers import settle

KEY = "patientunitstayid"


@query("gold_features_hourly", "SELECT * FROM v_features")
def _(spark, sf):
    return b.warehouse(spark, sf).features


def _features(spark, sf, *columns):
    return series.engineer(b.offset_hourly(spark, sf), KEY).select(KEY, "hour_bucket", *columns)


@query(
    "baseline_ratio",
    f"SELECT {KEY}, hour_bucket, baseline_creatinine, creatinine_ratio FROM v_offset_features",
)
def _(spark, sf):
    return _features(spark, sf, "baseline_creatinine", "creatinine_ratio")


@query("lag_delta_1", f"SELECT {KEY}, hour_bucket, creatinine_delta_1h FROM v_offset_features")
def _(spark, sf):
    return _features(spark, sf, "creatinine_delta_1h")


@query("lag_delta_48", f"SELECT {KEY}, hour_bucket, creatinine_delta_48h FROM v_offset_features")
def _(spark, sf):
    return _features(spark, sf, "creatinine_delta_48h")


@query("rolling_sums", f"SELECT {KEY}, hour_bucket, urine_ml_6h, urine_ml_12h, urine_ml_24h FROM v_offset_features")
def _(spark, sf):
    return _features(spark, sf, "urine_ml_6h", "urine_ml_12h", "urine_ml_24h")


@query(
    "rate_per_kg_hour",
    f"""SELECT {KEY}, hour_bucket, urine_ml_per_kg_hr_6h, urine_ml_per_kg_hr_12h, urine_ml_per_kg_hr_24h
        FROM v_offset_features""",
)
def _(spark, sf):
    return _features(spark, sf, *[f"urine_ml_per_kg_hr_{n}h" for n in series.ROLLING_ROWS])


VIEWS["v_hosp_hourly"] = """
SELECT coalesce(c.subject_id, u.subject_id) AS subject_id, coalesce(c.hadm_id, u.hadm_id) AS hadm_id,
       coalesce(c.hour_bucket, u.hour_bucket) AS hour_bucket, c.creatinine, u.stay_id, u.urine_output_ml,
       70.0::DOUBLE AS admissionweight
FROM (SELECT subject_id, hadm_id, date_trunc('hour', event_time) AS hour_bucket,
             last(creatinine ORDER BY event_time, labevent_id) AS creatinine
      FROM v_clean_labs GROUP BY 1, 2, 3) c
FULL OUTER JOIN (SELECT subject_id, hadm_id, stay_id, date_trunc('hour', event_time) AS hour_bucket,
             sum(urine_output_ml) AS urine_output_ml FROM v_clean_outputs GROUP BY 1, 2, 3, 4) u
  ON c.subject_id = u.subject_id AND c.hadm_id = u.hadm_id AND c.hour_bucket = u.hour_bucket"""
VIEWS["v_hosp_features"] = projections.engineered(
    "v_hosp_hourly", "subject_id", "admissionweight", "hour_bucket, hadm_id, stay_id NULLS FIRST"
)


@query("hospital_features", "SELECT * FROM v_hosp_features")
def _(spark, sf):
    rows = settle(b.hospital_hourly(spark, sf), "hospital-hourly")
    return series.engineer(rows, "subject_id", tie=["hadm_id", "stay_id"])


@query(
    "rolling_sum_sql",
    f"""SELECT {KEY}, hour_bucket, creatinine,
          creatinine / min(creatinine) OVER (PARTITION BY {KEY}) AS creatinine_ratio,
          sum(urine_output_ml) OVER (PARTITION BY {KEY} ORDER BY hour_bucket
                                     ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS urine_ml_6h
        FROM v_offset_hourly""",
)
def _(spark, sf):
    hourly = b.offset_hourly(spark, sf)
    rows, window = series.in_chunks(hourly, KEY, "hour_bucket", [], 5)
    rolled = skew.drop_halo(rows.withColumn("urine_ml_6h", series.rolling_sum("urine_output_ml", 6, window)))
    return series.with_baseline(rolled, KEY).select(
        KEY, "hour_bucket", "creatinine", series.baseline_ratio().alias("creatinine_ratio"), "urine_ml_6h"
    )


@query(
    "rolling_sums_by_time",
    f"""SELECT {KEY}, hour_bucket, urine_output_ml, """
    + ", ".join(
        f"""sum(urine_output_ml) OVER (PARTITION BY {KEY} ORDER BY hour_bucket
            RANGE BETWEEN INTERVAL {n - 1} HOUR PRECEDING AND CURRENT ROW) AS urine_ml_{n}h"""
        for n in (6, 12, 24)
    )
    + " FROM v_offset_hourly",
)
def _(spark, sf):
    return series.rolling_sums_by_time(b.offset_hourly(spark, sf), KEY)


@query("running_max_rows", "SELECT stay_id, charttime, kdigo_stage, rolling_max_kdigo FROM v_features")
def _(spark, sf):
    stages = b.warehouse(spark, sf).written_stages.select("stay_id", "charttime", "kdigo_stage")
    return series.running_max_rows(stages)


VIEWS["v_events_stage"] = """
SELECT subject_id, date_trunc('hour', charttime::TIMESTAMP) AS charttime,
       (arrival % 4)::INTEGER AS kdigo_stage, arrival FROM fx_live"""


@query(
    "running_max_range",
    """SELECT subject_id, charttime, kdigo_stage, arrival,
         max(kdigo_stage) OVER (PARTITION BY subject_id ORDER BY charttime
                                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rolling_max_kdigo
       FROM v_events_stage""",
)
def _(spark, sf):
    # Several events share an hour, so equal times do occur.
    events = settle(
        b.live(spark, sf).select(
            "subject_id",
            F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("charttime"),
            (F.col("arrival") % 4).cast("int").alias("kdigo_stage"),
            "arrival",
        ),
        "stage-events",
    )
    return series.running_max_range(events, key="subject_id", block=F.col("charttime"))


VIEWS["v_batch_features"] = """
SELECT k.stay_id, k.subject_id, k.hadm_id, k.charttime, coalesce(k.creatinine_mg_dl, 0) AS creatinine_mg_dl,
       coalesce(k.urine_ml, 0) AS urine_ml, k.kdigo_creat_stage, k.kdigo_urine_stage, k.kdigo_stage,
       max(k.kdigo_stage) OVER (PARTITION BY k.stay_id ORDER BY k.charttime) AS rolling_max_kdigo,
       c.intime, c.los, coalesce((epoch(k.charttime) - epoch(c.intime)) / 3600.0, 0)::DOUBLE AS hours_since_admit
FROM v_hourly k LEFT JOIN v_cohort c ON k.stay_id = c.stay_id"""


@query("batch_feature_table", "SELECT * FROM v_batch_features")
def _(spark, sf):
    w = b.warehouse(spark, sf)
    return warehouse.features_for_training(w.written_stages, w.cohort)


@query("hours_since_admit_boundary", "SELECT stay_id, charttime, hours_since_admit FROM v_features")
def _(spark, sf):
    return b.warehouse(spark, sf).features.select("stay_id", "charttime", "hours_since_admit")


@query("hours_since_admit_fraction", "SELECT stay_id, charttime, hours_since_admit FROM v_batch_features")
def _(spark, sf):
    w = b.warehouse(spark, sf)
    return warehouse.features_for_training(w.written_stages, w.cohort).select(
        "stay_id", "charttime", "hours_since_admit"
    )


@query(
    "progression_target",
    f"SELECT {KEY}, hour_bucket, kdigo_stage, future_max_stage_48h, {config.TARGET} FROM v_training_rows",
)
def _(spark, sf):
    labeled = settle(
        series.label_stages(series.engineer(b.offset_hourly(spark, sf), KEY)).select(KEY, "hour_bucket", "kdigo_stage"),
        "labeled",
    )
    return series.progression_target(labeled, KEY)


@query(
    "progression_target_forward",
    f"""SELECT {KEY}, hour_bucket, kdigo_stage, future_max_stage_48h,
          CASE WHEN kdigo_stage < 3 AND future_max_stage_48h >= 3 THEN 1 ELSE 0 END AS {config.TARGET}
        FROM (SELECT *, max(kdigo_stage) OVER (PARTITION BY {KEY} ORDER BY hour_bucket
                RANGE BETWEEN INTERVAL 1 HOUR FOLLOWING AND INTERVAL 48 HOUR FOLLOWING) AS future_max_stage_48h
              FROM v_offset_labeled)""",
)
def _(spark, sf):
    labeled = settle(
        series.label_stages(series.engineer(b.offset_hourly(spark, sf), KEY)).select(KEY, "hour_bucket", "kdigo_stage"),
        "labeled",
    )
    return series.progression_target_forward(labeled, KEY)


@query("training_rows", "SELECT * FROM v_training_rows")
def _(spark, sf):
    return b.training_rows(spark, sf)


@query(
    "baseline_median_early",
    """SELECT stay_id, count(*) AS readings, median(creatinine_mg_dl) AS baseline_creatinine
       FROM (SELECT *, row_number() OVER (PARTITION BY stay_id ORDER BY charttime, creatinine_mg_dl) AS n FROM v_creat)
       WHERE n <= 3 GROUP BY stay_id""",
)
def _(spark, sf):
    return series.baseline_median_early(
        b.warehouse(spark, sf).creatinine, "stay_id", "charttime", "creatinine_mg_dl", "creatinine_mg_dl"
    )


VIEWS["v_unique"] = """
SELECT * EXCLUDE (n) FROM (
  SELECT *, charttime::TIMESTAMP AS event_time,
         row_number() OVER (PARTITION BY subject_id, charttime, event_type, value ORDER BY arrival) AS n
  FROM fx_live) WHERE n = 1"""


@query("event_dedup", "SELECT * FROM v_unique")
def _(spark, sf):
    return b.live_unique(spark, sf)


@query(
    "duplicate_report",
    """SELECT arrivals, unique_events, arrivals - unique_events AS duplicates,
         round((arrivals - unique_events) / arrivals::DOUBLE, 6) AS duplicate_rate
       FROM (SELECT (SELECT count(*) FROM fx_live) AS arrivals, (SELECT count(*) FROM v_unique) AS unique_events)""",
)
def _(spark, sf):
    return sketches.duplicate_report(fixtures.live_events(spark, sf))


VIEWS["v_trailing"] = """
SELECT *, count(*) OVER (ORDER BY event_time RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW)
         AS events_1h FROM (SELECT *, charttime::TIMESTAMP AS event_time FROM fx_live)"""


@query("trailing_event_count", "SELECT * FROM v_trailing")
def _(spark, sf):
    return sketches.trailing_event_count(settle(b.live(spark, sf), "live"))


@query(
    "trailing_event_count_by_key",
    """SELECT *, count(*) OVER (PARTITION BY subject_id ORDER BY event_time
         RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS events_1h
       FROM (SELECT *, charttime::TIMESTAMP AS event_time FROM fx_live)""",
)
def _(spark, sf):
    return sketches.trailing_event_count(settle(b.live(spark, sf), "live"), key=["subject_id"])


VIEWS["v_running_distinct"] = f"""
SELECT arrival, subject_id, (2 ** coalesce(max(z) OVER (ORDER BY arrival), 0))::BIGINT AS distinct_estimate
FROM (SELECT arrival, subject_id, CASE WHEN h <> 0 THEN bit_count((h & -h) - 1) END AS z
      FROM (SELECT arrival, subject_id, {hash32("subject_id::VARCHAR")} AS h FROM fx_live))"""


@query("distinct_estimate_running", "SELECT * FROM v_running_distinct")
def _(spark, sf):
    return sketches.distinct_estimate_running(fixtures.live_events(spark, sf).select("arrival", "subject_id"))


@query(
    "running_count_per_patient",
    """SELECT arrival, subject_id, count(*) OVER (PARTITION BY subject_id ORDER BY event_time, arrival
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_count FROM v_unique""",
)
def _(spark, sf):
    events = settle(b.live_unique(spark, sf).select("arrival", "subject_id", "event_time"), "unique")
    return skew.running(
        events, ["subject_id"], ["event_time", "arrival"], hour("event_time"), {"event_count": ("count", F.lit(1))}
    ).drop("event_time")
