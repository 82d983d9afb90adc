"""Aggregation of events to hours. Every group combines before it is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import rules
from tidewatch.operators.joins import hourly_outer_join
from tidewatch.operators.skew import salted_join

STAY_KEYS = ("subject_id", "hadm_id", "stay_id")


def hour(time: str) -> Column:
    """The hour of a time, without zone."""
    return F.date_trunc("hour", F.col(time)).cast("timestamp_ntz")


def day(time: str) -> Column:
    return F.date_trunc("day", F.col(time)).cast("timestamp_ntz")


def baseline_min(events: DataFrame, key: str = "stay_id", value: str = "creatinine_mg_dl") -> DataFrame:
    return events.groupBy(key).agg(F.min(value).alias("baseline_creatinine"))


def hourly_max(
    events: DataFrame, keys: Sequence[str] = STAY_KEYS, time: str = "charttime",
    value: str = "creatinine_mg_dl",
) -> DataFrame:
    return events.groupBy(*keys, hour(time).alias("chart_hour")).agg(F.max(value).alias(value))


def hourly_sum(
    events: DataFrame, keys: Sequence[str] = STAY_KEYS, time: str = "charttime", value: str = "urine_ml"
) -> DataFrame:
    return events.groupBy(*keys, hour(time).alias("chart_hour")).agg(F.sum(value).alias(value))


def baseline_join(df: DataFrame, baseline: DataFrame, key: str = "stay_id") -> DataFrame:
    return salted_join(df, baseline, [key])


def hourly_creatinine(events: DataFrame) -> DataFrame:
    """Hourly maximum with the stay's minimum, from one pass over the events.

    The minimum is taken over the hours' minima. That window holds one row per hour of a stay,
    however many events the stay has.
    """
    hours = events.groupBy(*STAY_KEYS, hour("charttime").alias("chart_hour")).agg(
        F.max("creatinine_mg_dl").alias("creatinine_mg_dl"),
        F.min("creatinine_mg_dl").alias("_hour_min"),
    )
    whole_stay = Window.partitionBy("stay_id")
    return hours.withColumn("baseline_creatinine", F.min("_hour_min").over(whole_stay)).drop("_hour_min")


def hourly_stages(creatinine: DataFrame, urine: DataFrame) -> DataFrame:
    """One row per stay and hour with any event: both measures, both stages, the worse stage."""
    left = hourly_creatinine(creatinine).select(
        "stay_id",
        "chart_hour",
        F.col("subject_id").alias("_c_subject"),
        F.col("hadm_id").alias("_c_hadm"),
        "creatinine_mg_dl",
        rules.kdigo_creatinine().alias("_c_stage"),
    )
    right = hourly_sum(urine).select(
        "stay_id",
        "chart_hour",
        F.col("subject_id").alias("_u_subject"),
        F.col("hadm_id").alias("_u_hadm"),
        "urine_ml",
        rules.kdigo_urine().alias("_u_stage"),
    )
    return hourly_outer_join(left, right, ["stay_id", "chart_hour"]).select(
        F.coalesce("_c_subject", "_u_subject").alias("subject_id"),
        F.coalesce("_c_hadm", "_u_hadm").alias("hadm_id"),
        "stay_id",
        F.col("chart_hour").alias("charttime"),
        "creatinine_mg_dl",
        "urine_ml",
        F.coalesce("_c_stage", F.lit(0)).alias("kdigo_creat_stage"),
        F.coalesce("_u_stage", F.lit(0)).alias("kdigo_urine_stage"),
        F.greatest(F.coalesce("_c_stage", F.lit(0)), F.coalesce("_u_stage", F.lit(0))).alias("kdigo_stage"),
    )


def hourly_last(
    events: DataFrame, keys: Sequence[str], value: str, tie: str, time: str = "event_time"
) -> DataFrame:
    """The last non-null value per hour, by time and then by `tie`; null keys drop."""
    return (
        events.dropna(subset=[*keys, time, value])
        .groupBy(*keys, hour(time).alias("hour_bucket"))
        .agg(F.max_by(value, F.struct(time, tie)).alias(value))
    )


def hourly_sum_by(
    events: DataFrame, keys: Sequence[str], value: str, time: str = "event_time"
) -> DataFrame:
    """The hourly sum per group; a row with a null key belongs to no group."""
    return (
        events.dropna(subset=[*keys, time])
        .groupBy(*keys, hour(time).alias("hour_bucket"))
        .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value))
    )
