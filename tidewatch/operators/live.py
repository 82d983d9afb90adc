"""Per-patient live state in batch form: histories, features, stage, score and traces.

A patient's state after an event depends on the last 20 values of each measure. Histories come
from chunked series per (patient, measure); the state of the other measure is carried forward by
a two-level running pass. No task holds a whole patient.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions import rules
from tidewatch.functions.numeric import or_default, round_half_up
from tidewatch.operators import skew
from tidewatch.operators.hourly import hour
from tidewatch.sources.layers import settle

# History length, readings in the baseline, constant vector tail.
HISTORY = 20
BASELINE_READINGS = 3
VECTOR_TAIL = (65.0, 1.0, 0.0)


def _last(history: Column, back: int = 1) -> Column:
    return F.try_element_at(history, F.lit(-back))


def _median_first(history: Column) -> Column:
    first = F.array_sort(F.slice(history, 1, BASELINE_READINGS))
    size = F.size(first)
    return F.when(size == 2, (F.get(first, F.lit(0)) + F.get(first, F.lit(1))) / 2.0).otherwise(
        F.get(first, F.when(size == 3, 1).otherwise(0))
    )


def _urine_rate(history: Column, hours: int, weight: float, rate: str) -> Column:
    recent = F.slice(F.reverse(history), 1, hours)
    total = F.aggregate(recent, F.lit(0.0), lambda s, v: s + v)
    if rate == "reference":
        total = round_half_up(total / F.size(recent), 2)
    return round_half_up(total / F.lit(weight * hours), 3)


def creatinine_state(history: Column) -> Column:
    """Level, baseline, ratio and rise of a creatinine history; nulls, but no rise, while it is empty."""
    base = _median_first(history)
    rise = round_half_up(_last(history) - F.get(history, F.size(history) - 2), 3)
    return F.struct(
        _last(history).alias("creatinine"),
        base.alias("baseline"),
        F.when(base != 0, round_half_up(F.try_divide(_last(history), base), 3)).alias("cr_ratio"),
        F.when(F.size(history) >= 2, rise).otherwise(0.0).alias("cr_delta_recent"),
    )


def urine_state(history: Column, rate: str, weight: float) -> Column:
    """Output per kg and hour over the last 6 and 24 readings; null while there is none."""
    some = F.when(F.size(history) > 0, history)
    return F.struct(
        _urine_rate(some, 6, weight, rate).alias("uo_ml_kg_hr_6h"),
        _urine_rate(some, 24, weight, rate).alias("uo_ml_kg_hr_24h"),
    )


def known_values(events: DataFrame) -> DataFrame:
    """A reading without a value counts as 0.0, in batch and stream alike."""
    value = F.nanvl(F.col("value").cast("double"), F.lit(None).cast("double"))
    return events.withColumn("value", F.coalesce(value, F.lit(0.0)))


def measure_states(events: DataFrame, rate: str, weight: float, size: int) -> DataFrame:
    """Each event with the state of its own measure just after it, from the last 20 values."""
    measured = events.withColumn(
        "measure",
        F.when(F.col("event_type") == "creatinine", "creatinine").when(
            F.col("event_type").isin("urine", "urine_output"), "urine"
        ).otherwise("other"),
    )
    key = ["subject_id", "measure"]
    rows = skew.chunks(
        measured, key, ["event_time", "arrival"], hour("event_time"), HISTORY - 1, size=size
    )
    window = skew.chunk_window(key).rowsBetween(1 - HISTORY, 0)
    history = skew.drop_halo(rows.withColumn("_history", F.collect_list("value").over(window)))
    creatinine, urine = creatinine_state(F.col("_history")), urine_state(F.col("_history"), rate, weight)
    return history.select(
        *events.columns,
        F.when(F.col("measure") == "creatinine", creatinine).alias("_creatinine"),
        F.when(F.col("measure") == "urine", urine).alias("_urine"),
    )


def live_state(
    events: DataFrame, rate: str = "sum", weight: float = config.DEFAULT_WEIGHT_KG,
    size: int = skew.CHUNK_ROWS,
) -> DataFrame:
    """Per deduplicated event, the patient's state after it, in event-time order.

    `events` has subject_id, event_time, arrival, event_type and value. `rate="sum"` divides the
    recent urine by weight and hours; `rate="reference"` divides its mean, and so is smaller by
    the number of readings.
    """
    if rate not in ("sum", "reference"):
        raise ValueError("rate is sum or reference")
    events = settle(known_values(events), "live-events")
    states = settle(measure_states(events, rate, weight, size), "live-states")
    carried = skew.running(
        states,
        ["subject_id"],
        ["event_time", "arrival"],
        hour("event_time"),
        {"_cr": ("last", "_creatinine"), "_uo": ("last", "_urine"), "event_count": ("count", F.lit(1))},
    )
    return carried.select(
        *events.columns,
        "event_count",
        "_cr.creatinine",
        "_cr.baseline",
        "_cr.cr_ratio",
        F.coalesce("_cr.cr_delta_recent", F.lit(0.0)).alias("cr_delta_recent"),
        "_uo.uo_ml_kg_hr_6h",
        "_uo.uo_ml_kg_hr_24h",
    )


def scored(state: DataFrame) -> DataFrame:
    """The state with its stage, score and band."""
    return state.withColumns(
        {"kdigo_stage": rules.kdigo_live(), "anomaly_score": rules.anomaly_score()}
    ).withColumn("risk_band", rules.risk_band())


def live_feature_vector() -> Column:
    """Ten numbers: levels, ratio, rise, half of it, urine rates and three constants."""
    delta = F.coalesce(F.col("cr_delta_recent"), F.lit(0.0))
    parts = [
        round_half_up(or_default(F.col("creatinine"), 0.0), 3),
        round_half_up(or_default(F.col("baseline"), 1.0), 3),
        round_half_up(or_default(F.col("cr_ratio"), 1.0), 3),
        round_half_up(delta, 3),
        round_half_up(delta * 0.5, 3),
        round_half_up(or_default(F.col("uo_ml_kg_hr_6h"), 0.0), 3),
        round_half_up(or_default(F.col("uo_ml_kg_hr_24h"), 0.0), 3),
    ]
    return F.array(*parts, *[F.lit(v) for v in VECTOR_TAIL])


def traces(scored_events: DataFrame) -> DataFrame:
    """One nested record per accepted event.

    Expects batch_id, distinct_estimate, events_1h, group_size and twins next to the scored
    state; what a caller does not have it passes as null.
    """
    v = F.col("vector")
    return scored_events.withColumn("vector", live_feature_vector()).select(
        F.col("subject_id").cast("string").alias("patient_id"),
        F.date_format("event_time", config.EVENT_TIME_FORMAT).alias("timestamp"),
        "batch_id",
        F.struct(
            F.col("event_type").alias("type"), round_half_up(F.col("value"), 3).alias("value"), "uom"
        ).alias("record"),
        F.struct(
            F.lit("UNIQUE").alias("bloom"),
            F.col("distinct_estimate").alias("fm_distinct_patients"),
            F.col("events_1h").alias("dgim_events_1h"),
            F.concat(F.lit("k="), F.coalesce("group_size", F.lit(0)).cast("string")).alias("k_anonymity"),
        ).alias("algorithms"),
        F.struct(
            v[0].alias("creatinine"),
            v[1].alias("baseline_cr"),
            v[2].alias("cr_ratio"),
            v[3].alias("cr_delta_recent"),
            v[5].alias("uo_ml_kg_hr_6h"),
            v[6].alias("uo_ml_kg_hr_24h"),
        ).alias("features"),
        "vector",
        "kdigo_stage",
        "anomaly_score",
        "twins",
    )


def trace_json(trace_rows: DataFrame) -> DataFrame:
    """Traces as text, keyed by patient: what a file or topic sink takes."""
    return trace_rows.select(
        F.col("patient_id").alias("key"), F.to_json(F.struct(*trace_rows.columns)).alias("value")
    )


def patient_board(scored_events: DataFrame) -> DataFrame:
    """One row per patient: events, newest stage, score, type and value, worst first."""
    newest = F.struct("kdigo_stage", "anomaly_score", "event_type", "value")
    return (
        scored_events.groupBy("subject_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.max_by(newest, F.struct("event_time", "arrival")).alias("_n"),
        )
        .select(
            "subject_id",
            "events",
            F.col("_n.kdigo_stage").alias("kdigo_stage"),
            F.col("_n.anomaly_score").alias("anomaly_score"),
            F.col("_n.event_type").alias("last_type"),
            F.col("_n.value").alias("last_value"),
        )
        .orderBy(F.col("anomaly_score").desc(), "subject_id")
    )
