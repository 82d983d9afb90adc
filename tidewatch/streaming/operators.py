"""Streaming forms of dedup, windows, samples and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.hashing import hash52
from tidewatch.operators import sketches

WATERMARK = "6 hours"


def stream_dedup(
    events: DataFrame, key: Sequence[str] = ("event_id",), time: str = "event_time", watermark: str = WATERMARK
) -> DataFrame:
    """The first copy of every event; keys are forgotten when the watermark passes them, so the
    state stays bounded. Without the columns it needs the stream passes unchanged."""
    if time not in events.columns or any(k not in events.columns for k in key):
        return events
    return events.withWatermark(time, watermark).dropDuplicatesWithinWatermark(list(key))


def stream_sliding_counts(
    events: DataFrame, time: str = "event_time", window: str = "1 hour", slide: str = "10 minutes",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Events per sliding window. Read it in update or complete mode to see open windows."""
    return sketches.sliding_counts(events.withWatermark(time, watermark), time, window, slide)


def stream_distinct_patients(
    events: DataFrame, key: str = "subject_id", time: str = "event_time", window: str = "1 hour",
    slide: str = "10 minutes", watermark: str = WATERMARK, rsd: float = 0.05,
) -> DataFrame:
    """Approximate distinct patients per sliding window; registers merge, ids are not kept."""
    return (
        events.withWatermark(time, watermark)
        .groupBy(F.window(time, window, slide).alias("w"))
        .agg(F.approx_count_distinct(key, rsd).alias("patients"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "patients",
        )
    )


def stream_score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """A fitted pipeline on a stream: transformers only, no state."""
    from tidewatch.operators.ml import score_batch

    return score_batch(model, rows)


def merge_sample(sample: DataFrame, batch: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """A reservoir after one more micro-batch: the k smallest hash priorities of both."""
    priority = hash52(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    both = sample.unionByName(batch.select(*sample.columns))
    return both.withColumn("_priority", priority).orderBy("_priority", key).limit(k).drop("_priority")
