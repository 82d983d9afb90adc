"""Stream sources: JSON lines, stored tables, a topic; and the replay of a stored timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas


def jsonl_stream_source(
    spark: SparkSession, path: str, schema: T.StructType = schemas.LIVE_EVENT, max_files: int | None = None
) -> DataFrame:
    """JSON lines in a folder, new files as they come. A line that does not parse is dropped."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_payload(reader.load(path), schema)


def parse_payload(raw: DataFrame, schema: T.StructType = schemas.LIVE_EVENT) -> DataFrame:
    """Events from a text or binary `value` column; what does not parse is ignored."""
    text = F.col("value").cast("string")
    strict = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    event = F.from_json(text, strict, {"columnNameOfCorruptRecord": "_bad"})
    return (
        raw.select(event.alias("e"))
        .filter(F.col("e").isNotNull() & F.col("e._bad").isNull())
        .select("e.*")
        .drop("_bad")
    )


def table_stream_source(
    spark: SparkSession, path: str, schema: T.StructType, files: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def kafka_source(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType = schemas.LIVE_EVENT,
    max_offsets: int | None = None,
) -> DataFrame:
    """Events of a topic from its latest offsets. Needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return parse_payload(reader.load(), schema)


def with_event_time(events: DataFrame, text: str = "charttime") -> DataFrame:
    """A zoned event time, which watermarks need, from the event's own text."""
    return events.withColumn("event_time", F.col(text).try_cast("timestamp"))


def write_turns(rows: DataFrame, path: str, turn: str, turns: int, files: int = 1) -> None:
    """Rows as `files` files a turn, turn after turn, so that a file stream of as many files per micro-batch
    reads one turn at a time."""
    for i in range(turns):
        one = rows.filter(F.col(turn) == i).drop(turn)
        one.repartition(files).write.mode("append").option("maxRecordsPerFile", 0).parquet(path)


def write_replay(timeline: DataFrame, path: str, time: str = "event_time", slice_rows: int = 1_000_000) -> None:
    """A stored timeline as files, one time range of about `slice_rows` rows per file.

    The number of slices follows the data. Tasks may finish, and files be read, in another order than that of
    time: `timeline_replay` puts the rows back in order.
    """
    slices = max(1, -(-timeline.count() // slice_rows))
    timeline.repartitionByRange(slices, time).sortWithinPartitions(time).write.mode("overwrite").parquet(path)


def with_closing_row(timeline: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """The timeline with a last row, without key or values, later than all others by twice the delay.

    Its arrival moves the watermark past the rest; `timeline_replay` leaves it out (column `closing`).
    """
    last = timeline.agg((F.max(time) + F.expr(f"INTERVAL {delay}") * 2).alias(time)).withColumn("closing", F.lit(True))
    return timeline.withColumn("closing", F.lit(False)).unionByName(last, allowMissingColumns=True)


def timeline_replay(
    spark: SparkSession, path: str, schema: T.StructType, key: str, time: str = "event_time", delay: str = "1 DAY",
    files_per_batch: int = 1,
) -> DataFrame:
    """A stored timeline as a stream in time order, however its files come within `delay` of each other.

    So many files are read per micro-batch; rows wait in keyed state until the watermark has passed them, see
    `buffers.reorder`, which adds `position` and `released_at`. A plain time is taken as one of the session's zone. Rows
    with `closing` set only move the watermark.
    """
    from tidewatch.streaming.buffers import reorder

    rows = table_stream_source(spark, path, schema, "*.parquet", files_per_batch)
    zoned = rows.withColumn("_zoned", F.col(time).cast("timestamp"))
    ordered = reorder(zoned, key, "_zoned", delay).drop("_zoned")
    return ordered.filter(~F.col("closing")).drop("closing") if "closing" in schema.names else ordered
