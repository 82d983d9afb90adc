"""Ordered series per patient: baselines, lags, rolling sums, running stages and targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions import rules
from tidewatch.operators import skew
from tidewatch.operators.hourly import day

LAG_ROWS = 48
ROLLING_ROWS = (6, 12, 24)
TARGET_ROWS = 48


def running_max_rows(
    df: DataFrame, key: str = "stay_id", time: str = "charttime", value: str = "kdigo_stage",
    out: str = "rolling_max_kdigo", block: Column | None = None,
) -> DataFrame:
    """The worst value so far, row by row. Hourly rows are cut by day; cut raw events finer."""
    return skew.running(df, [key], [time], day(time) if block is None else block, {out: ("max", value)})


def running_max_range(
    df: DataFrame, key: str = "stay_id", time: str = "charttime", value: str = "kdigo_stage",
    out: str = "rolling_max_kdigo", block: Column | None = None,
) -> DataFrame:
    """The worst value so far; rows of equal time share it."""
    cut = day(time) if block is None else block
    return skew.running(df, [key], [time], cut, {out: ("max", value)}, ties=True)


def hours_boundary(start: str, end: str) -> Column:
    """Hour boundaries crossed between two times: 00:50 to 01:10 is 1."""
    whole = F.timestamp_diff("SECOND", F.date_trunc("hour", start), F.date_trunc("hour", end))
    return F.floor(whole / 3600).cast("bigint")


def hours_fraction(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end)) / F.lit(3600.0)


def with_baseline(
    df: DataFrame, key: str, value: str = "creatinine", out: str = "baseline_creatinine"
) -> DataFrame:
    """The key's minimum on every row: minima combine before the shuffle, then a salted join."""
    low = df.groupBy(key).agg(F.min(value).alias(out))
    return skew.salted_join(df, low, [key], how="left")


def baseline_ratio(value: str = "creatinine", baseline: str = "baseline_creatinine") -> Column:
    return F.try_divide(F.col(value), F.col(baseline))


def lag_delta(value: str, rows: int, window: WindowSpec) -> Column:
    return F.col(value) - F.lag(value, rows).over(window)


def rolling_sum(value: str, rows: int, window: WindowSpec) -> Column:
    return F.sum(value).over(window.rowsBetween(1 - rows, 0))


def rate_per_kg_hour(volume: str, weight: str, hours: int) -> Column:
    return F.try_divide(F.col(volume), F.col(weight) * hours)


def in_chunks(
    df: DataFrame, key: str, time: str, tie: Sequence[str], back: int, ahead: int = 0,
    size: int = skew.CHUNK_ROWS,
) -> tuple[DataFrame, WindowSpec]:
    """The series cut into chunks by day and row position, and the window to use on it."""
    return (
        skew.chunks(df, [key], [time, *tie], day(time), back, ahead, size),
        skew.chunk_window([key]),
    )


def _feature_columns(df: DataFrame, window: WindowSpec, weight: str) -> DataFrame:
    df = df.withColumns(
        {
            "creatinine_ratio": baseline_ratio(),
            "creatinine_prev_1h": F.lag("creatinine", 1).over(window),
            "creatinine_delta_1h": lag_delta("creatinine", 1, window),
            "creatinine_prev_48h": F.lag("creatinine", LAG_ROWS).over(window),
            "creatinine_delta_48h": lag_delta("creatinine", LAG_ROWS, window),
            **{f"urine_ml_{n}h": rolling_sum("urine_output_ml", n, window) for n in ROLLING_ROWS},
        }
    )
    return df.withColumns(
        {f"urine_ml_per_kg_hr_{n}h": rate_per_kg_hour(f"urine_ml_{n}h", weight, n) for n in ROLLING_ROWS}
    )


def _feature_chunks(
    hourly: DataFrame, key: str, time: str, tie: Sequence[str], weight: str, back: int, ahead: int, size: int
) -> tuple[DataFrame, WindowSpec]:
    low = hourly.groupBy(key).agg(F.min("creatinine").alias("baseline_creatinine"))
    if weight not in hourly.columns:
        hourly = hourly.withColumn(weight, F.lit(config.DEFAULT_WEIGHT_KG))
    rows, window = in_chunks(
        hourly.fillna({"urine_output_ml": 0.0}), key, time, tie, back, ahead, size
    )
    return skew.salted_join(rows, low, [key], how="left"), window


def engineer(
    hourly: DataFrame, key: str, time: str = "hour_bucket", tie: Sequence[str] = (),
    weight: str = "admissionweight", size: int = skew.CHUNK_ROWS,
) -> DataFrame:
    """Baseline, ratio, deltas, rolling urine and rates over the rows of each key.

    `hourly` is read three times (positions, minima, rows): give it a written table.
    """
    rows, window = _feature_chunks(hourly, key, time, tie, weight, LAG_ROWS, 0, size)
    return skew.drop_halo(_feature_columns(rows, window, weight))


def label_stages(features: DataFrame) -> DataFrame:
    return features.withColumn("kdigo_stage", rules.kdigo_full())


def _trailing_target(window: WindowSpec) -> Column:
    # The series moved up one row, then a trailing window of 48 rows: it spans 46 rows behind
    # to one ahead, and never the key's first row, which the move dropped.
    seen = F.when(F.col(skew.POSITION) > 1, F.col("kdigo_stage"))
    return F.max(seen).over(window.rowsBetween(2 - TARGET_ROWS, 1))


def _target_columns(df: DataFrame, future: Column) -> DataFrame:
    hit = (F.col("kdigo_stage") < 3) & F.coalesce(F.col("future_max_stage_48h") >= 3, F.lit(False))
    return df.withColumn("future_max_stage_48h", future).withColumn(config.TARGET, hit.cast("int"))


def progression_target(
    labeled: DataFrame, key: str, time: str = "hour_bucket", tie: Sequence[str] = (),
    size: int = skew.CHUNK_ROWS,
) -> DataFrame:
    """Below stage 3 now, and a stage 3 in the shifted trailing window."""
    rows, window = in_chunks(labeled, key, time, tie, TARGET_ROWS - 2, 1, size)
    return skew.drop_halo(_target_columns(rows, _trailing_target(window)))


def progression_target_forward(
    labeled: DataFrame, key: str, time: str = "hour_bucket", hours: int = 48
) -> DataFrame:
    """Below stage 3 now, and stage 3 in one of the next `hours` hours, by the clock.

    Rows are first reduced to one worst stage per key and hour. The hours are cut into blocks
    as long as the horizon; each hour is copied to its own and the previous block, which
    covers every look ahead.
    """
    number = F.floor(
        F.timestamp_diff("SECOND", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.col(time)) / 3600
    ).cast("bigint")
    worst = (
        labeled.groupBy(key, number.alias("_hour"))
        .agg(F.max("kdigo_stage").alias("_worst"))
        .withColumn("_home", F.floor(F.col("_hour") / hours))
        .withColumn("_part", F.explode(F.array(F.col("_home"), F.col("_home") - 1)))
    )
    ahead = Window.partitionBy(key, "_part").orderBy("_hour").rangeBetween(1, hours)
    looked = (
        worst.withColumn("_future", F.max("_worst").over(ahead))
        .filter(F.col("_part") == F.col("_home"))
        .select(F.col(key), "_hour", "_future")
    )
    joined = labeled.withColumn("_hour", number).join(looked, [key, "_hour"], "left")
    return _target_columns(joined, F.col("_future")).select(
        *labeled.columns, "future_max_stage_48h", config.TARGET
    )


def training_rows(
    hourly: DataFrame, key: str, time: str = "hour_bucket", tie: Sequence[str] = (),
    weight: str = "admissionweight", size: int = skew.CHUNK_ROWS,
) -> DataFrame:
    """Features, stages and the trailing target on one partitioning of the series."""
    back = LAG_ROWS + TARGET_ROWS - 2
    rows, window = _feature_chunks(hourly, key, time, tie, weight, back, 1, size)
    staged = label_stages(_feature_columns(rows, window, weight))
    return skew.drop_halo(_target_columns(staged, _trailing_target(window)))


def rolling_sums_by_time(
    hourly: DataFrame, key: str, hours: Sequence[int] = ROLLING_ROWS, time: str = "hour_bucket",
    value: str = "urine_output_ml",
) -> DataFrame:
    """Rolling sums by the clock instead of by rows, per key and hour."""
    longest = max(hours)
    number = F.floor(
        F.timestamp_diff("SECOND", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.col(time)) / 3600
    ).cast("bigint")
    sums = (
        hourly.groupBy(key, time)
        .agg(F.sum(value).alias(value))
        .withColumn("_hour", number)
        .withColumn("_home", F.floor(F.col("_hour") / longest))
        .withColumn("_part", F.explode(F.array(F.col("_home"), F.col("_home") + 1)))
    )
    w = Window.partitionBy(key, "_part").orderBy("_hour")
    return (
        sums.withColumns({f"urine_ml_{n}h": F.sum(value).over(w.rangeBetween(1 - n, 0)) for n in hours})
        .filter(F.col("_part") == F.col("_home"))
        .drop("_hour", "_home", "_part")
    )


def training_projection(df: DataFrame, key: str = "patientunitstayid", features=config.FEATURES) -> DataFrame:
    wanted = [key, "hour_bucket", "kdigo_stage", config.TARGET, *features]
    return df.select(*[c for c in wanted if c in df.columns])


def baseline_median_early(
    events: DataFrame, key: str, time: str, value: str, tie: str, first: int = 3
) -> DataFrame:
    """The median of a key's first readings. Only `first` rows per key and task are shuffled."""
    w = Window.partitionBy(key).orderBy(time, tie)
    early = events.dropna(subset=[value]).withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= first)
    return early.groupBy(key).agg(
        F.count(F.lit(1)).alias("readings"), F.percentile(value, F.lit(0.5)).alias("baseline_creatinine")
    )


def baseline_before_admission(
    events: DataFrame, cohort: DataFrame, on: Sequence[str] = ("subject_id", "hadm_id"),
    time: str = "charttime", value: str = "creatinine_mg_dl",
) -> DataFrame:
    """Per stay, the lowest reading taken before it began."""
    earlier = skew.salted_join(
        events.select(*on, time, value),
        cohort.select(*on, "stay_id", "intime"),
        list(on),
        condition=F.col(time) < F.col("intime"),
    )
    return earlier.groupBy("stay_id").agg(
        F.count(F.lit(1)).alias("readings"), F.min(value).alias("baseline_creatinine")
    )
