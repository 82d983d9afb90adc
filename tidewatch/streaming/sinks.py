"""Running queries and writing their results; checkpoints lie in the shared folder."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators import sketches
from tidewatch.session import work_dir
from tidewatch.sources.metrics import metric_rows, write_metrics
from tidewatch.streaming.operators import WATERMARK, merge_sample, stream_dedup
from tidewatch.streaming.sources import with_event_time


def append_files(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = "3 seconds",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append mode into files; a micro-batch every few seconds, or all there is and stop."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start(path)


def each_batch(
    stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False,
    every: str = "3 seconds", mode: str = "append",
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def drain(stream: DataFrame, purpose: str) -> DataFrame:
    """Run an append-mode stream over all its present input and read back what it wrote."""
    spark = stream.sparkSession
    path = work_dir(spark, purpose)
    query = append_files(stream, f"{path}/data", f"{path}/checkpoint", available_now=True)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def drain_updates(stream: DataFrame, key: Sequence[str], purpose: str) -> DataFrame:
    """Run an aggregating stream over all its input in update mode; the newest row of each key counts.

    A micro-batch writes only the keys it changed, under its own number, so a replay changes
    nothing and state behind the watermark can go.
    """
    spark = stream.sparkSession
    path = work_dir(spark, purpose)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    each_batch(stream, write, f"{path}/checkpoint", available_now=True, mode="update").awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    written = spark.read.schema(schema).parquet(f"{path}/data")
    rest = [c for c in stream.columns if c not in key]
    newest = written.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_newest"))
    return newest.select(*key, "_newest.*").select(*stream.columns)


#: Tumbling windows of the statistics; the sliding hour is united from six of them.
SLIDE = "10 minutes"
#: Base-2 logarithm of a distinct-count sketch's registers, and three standard deviations of its estimate.
SKETCH_K = 12
SKETCH_ERROR = 3 * 0.8326 / math.sqrt(1 << SKETCH_K)
SLIDES = "slide timestamp, arrivals long, allowed long, patients binary"


def _slides(rows: DataFrame) -> DataFrame:
    """(slide, arrivals, allowed, patients): counts and a distinct-count sketch per tumbling window."""
    arrived = ~F.col("first")
    return rows.groupBy(F.window("event_time", SLIDE)["start"].alias("slide")).agg(
        F.count_if(arrived).alias("arrivals"), F.count_if("first").alias("allowed"),
        F.hll_sketch_agg(F.when(arrived, F.col("subject_id").cast("string")), F.lit(SKETCH_K)).alias("patients"),
    )


def _united(slides: DataFrame) -> DataFrame:
    return slides.groupBy("slide").agg(
        F.sum("arrivals").alias("arrivals"), F.sum("allowed").alias("allowed"), F.hll_union_agg("patients").alias("patients")
    )


def write_stats(batch: DataFrame, batch_id: int, path: str, sample: int, keep: str) -> None:
    """One micro-batch's windows, sample and metric rows, under its number.

    `batch` has every arrival (first is false) and the first copy of every event (first is true). What is read of
    earlier micro-batches is their last recent windows and sample, both of bounded size.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        if batch.isEmpty():
            return
        _slides(batch).coalesce(1).write.mode("overwrite").parquet(f"{path}/windows/batch={batch_id}")
        own = spark.read.schema(SLIDES).parquet(f"{path}/windows/batch={batch_id}")
        past = latest_version(spark, f"{path}/recent", before=batch_id)
        before = spark.read.schema(SLIDES).parquet(past) if past else own.limit(0)
        newest = F.greatest(own.agg(F.max("slide")).scalar(), before.agg(F.max("slide")).scalar())
        recent = _united(own.unionByName(before)).filter(F.col("slide") > newest - F.expr(f"INTERVAL {keep}"))
        recent.coalesce(1).write.mode("overwrite").parquet(f"{path}/recent/v={batch_id}")
        recent = spark.read.schema(SLIDES).parquet(f"{path}/recent/v={batch_id}")
        arrived = batch.filter(~F.col("first")).drop("first", "event_time")
        past = latest_version(spark, f"{path}/sample", before=batch_id)
        held = spark.read.schema(arrived.schema).parquet(past) if past else arrived.limit(0)
        merge_sample(held, arrived, sample, "arrival").write.mode("overwrite").parquet(f"{path}/sample/v={batch_id}")
    finally:
        batch.unpersist()
    sampled = spark.read.schema(arrived.schema).parquet(f"{path}/sample/v={batch_id}")
    # Six slides that end with the newest: the events of the last hour of the stream's own time.
    last_hour = recent.filter(F.col("slide") > F.lit(recent.agg(F.max("slide")).first()[0]) - F.expr("INTERVAL 1 HOUR"))
    stats = own.agg(
        F.sum("arrivals").alias("arrivals"), F.sum("allowed").alias("allowed"),
        F.hll_sketch_estimate(F.hll_union_agg("patients")).alias("patients"),
    ).withColumns(
        {"sample_size": sampled.agg(F.count(F.lit(1))).scalar(), "window_events": last_hour.agg(F.sum("arrivals")).scalar()}
    )
    n, unique = F.col("arrivals"), F.col("allowed")
    rows = metric_rows(
        stats,
        {
            "allowed_events": unique,
            "duplicate_events": n - unique,
            "duplicate_rate": F.coalesce(F.try_divide(n - unique, n), F.lit(0.0)),
            "distinct_patients": F.col("patients"),
            "sample_size": F.col("sample_size"),
            "window_events": F.col("window_events"),
        },
        F.to_json(F.struct(F.lit(batch_id).alias("batch_id"), F.lit(SKETCH_ERROR).alias("distinct_error"))),
    )
    write_metrics(rows, f"{path}/log", batch_id)
    for folder in ("recent", "sample"):
        forget_versions(spark, f"{path}/{folder}", batch_id)


def stream_stats(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = False, sample: int = 100,
    watermark: str = WATERMARK, keep: str = "7 HOURS",
) -> StreamingQuery:
    """Six metric rows per micro-batch below `path`/log: allowed and duplicate events, their rate, distinct
    patients, the size of the running sample, and the events of the last hour.

    Seen keys are in the state store and forgotten with the watermark, so a micro-batch's work does not
    grow with the stream's age; an arrival behind the watermark counts as a duplicate. Windows are kept with a
    distinct-count sketch each, see `window_estimates`. Arrivals without a time are left out.
    """
    timed = with_event_time(events).filter("event_time is not null")
    firsts = stream_dedup(timed, sketches.EVENT_KEY, watermark=watermark).withColumn("first", F.lit(True))
    both = timed.withColumn("first", F.lit(False)).unionByName(firsts)
    return each_batch(both, lambda batch, i: write_stats(batch, i, path, sample, keep), checkpoint, available_now)


def window_estimates(spark: SparkSession, path: str, slides: int = 6) -> DataFrame:
    """Events and distinct patients per sliding window, from the stored windows of `stream_stats`.

    Sketches of a window's slides are united over all micro-batches, so a patient counts once. `error` is three
    standard deviations of the estimate, as a share; small counts are exact.
    """
    minutes = int(SLIDE.split()[0])
    stored = _united(spark.read.schema(SLIDES).parquet(f"{path}/windows"))
    back = F.explode(F.sequence(F.lit(0), F.lit(slides - 1))).alias("back")
    copied = stored.select("*", back).withColumn("start", F.timestamp_add("MINUTE", -F.col("back") * minutes, F.col("slide")))
    found = copied.groupBy("start").agg(
        F.sum("arrivals").alias("events"), F.hll_sketch_estimate(F.hll_union_agg("patients")).alias("patients")
    )
    return found.select(
        F.col("start").cast("timestamp_ntz").alias("window_start"),
        F.timestamp_add("MINUTE", F.lit(slides * minutes), F.col("start")).cast("timestamp_ntz").alias("window_end"),
        "events", "patients", F.lit(SKETCH_ERROR).alias("error"),
    )


def drain_timed(stream: DataFrame, rows: int, purpose: str, every: str = "1 second", seconds: int = 300) -> DataFrame:
    """Run an append-mode stream with a processing-time trigger until it has written `rows` rows, or nothing for so long.

    Timers of processing time fire in micro-batches of their own, which a run over the present input does not wait for. A
    micro-batch at work is waited for, however long it takes.
    """
    spark = stream.sparkSession
    path = work_dir(spark, purpose)
    query = append_files(stream, f"{path}/data", f"{path}/checkpoint", every=every)
    until, written, told, busy = time.monotonic() + seconds, 0, None, 0
    try:
        while time.monotonic() < until and not query.awaitTermination(1):
            found = 0
            if exists(spark, f"{path}/data/_spark_metadata"):
                found = spark.read.schema(stream.schema).parquet(f"{path}/data").count()
                if found >= rows:
                    break
            before, told = told, (query.lastProgress or {}).get("timestamp")
            # Looks in a row that find the same trigger active, as an idle one is for a moment only.
            busy = busy + 1 if query.status["isTriggerActive"] and before == told else 0
            if busy >= 5 or found > written:
                until, written = time.monotonic() + seconds, found
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def stream_sample(
    events: DataFrame, path: str, checkpoint: str, k: int, key: str, available_now: bool = False
) -> StreamingQuery:
    """A reservoir of k events; each micro-batch writes the merged sample under its own number."""
    spark = events.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = latest_version(spark, path, before=batch_id)
        sample = spark.read.parquet(newest) if newest else batch.limit(0)
        merge_sample(sample, batch, k, key).write.mode("overwrite").parquet(f"{path}/v={batch_id}")

    return each_batch(events, merge, checkpoint, available_now)


def _folder(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    root, fs = _folder(spark, path)
    return fs.exists(root)


def versions(spark: SparkSession, path: str, prefix: str = "v=") -> list[int]:
    """The numbers of the folders below a path."""
    root, fs = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))


def forget_versions(spark: SparkSession, path: str, before: int, prefix: str = "v=") -> None:
    """Remove numbered folders that no batch can read again: all older than the newest before `before`."""
    for v in [v for v in versions(spark, path, prefix) if v < before][:-1]:
        root, fs = _folder(spark, f"{path}/{prefix}{v}")
        fs.delete(root, True)


def latest_version(
    spark: SparkSession, path: str, before: int | None = None, prefix: str = "v="
) -> str | None:
    """The newest numbered folder below a path, so that a replayed batch reads what it read first."""
    numbers = [v for v in versions(spark, path, prefix) if before is None or v < before]
    return f"{path}/{prefix}{max(numbers)}" if numbers else None
