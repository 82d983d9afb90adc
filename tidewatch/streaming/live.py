"""The live path as one stream: dedup, patient state, twins and traces, under one checkpoint.

The stream carries two kinds of rows: every arrival, and every accepted event with its patient's state, which
has passed two stateful operators (the seen keys, then the histories). A micro-batch is written once under
its number and read from there, so the state is computed once. What events share across patients, the
counts of recent seconds and the first arrival of each number of hash zeros, is a table of bounded size
that each micro-batch writes anew. Every file carries its batch number: a replayed batch writes the same again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators import live, sketches
from tidewatch.operators.skew import salted_join
from tidewatch.streaming import sinks, twins
from tidewatch.streaming.operators import WATERMARK, stream_dedup
from tidewatch.streaming.sources import with_event_time
from tidewatch.streaming.state import stream_patient_state

#: Seconds whose counts are kept: the hour that is counted, and how late an event may come.
KEEP_SECONDS = 7 * 3600
SHARED = "kind string, k long, n long"


def arrivals_and_states(events: DataFrame, rate: str = "sum", watermark: str = WATERMARK) -> DataFrame:
    """Every arrival (accepted is false) and every event after dedup with its state (accepted is true)."""
    timed = with_event_time(events)
    unique = stream_dedup(timed, sketches.EVENT_KEY, watermark=watermark)
    states = stream_patient_state(unique.select("subject_id", "charttime", "event_type", "value", "arrival", "uom"), rate)
    arrived = timed.select("subject_id", "charttime", "arrival")
    return states.withColumn("accepted", F.lit(True)).unionByName(
        arrived.withColumn("accepted", F.lit(False)), allowMissingColumns=True
    )


def _second(charttime: str = "charttime"):
    return sketches.second_of(F.col(charttime).try_cast("timestamp_ntz"))


def merge_shared(before: DataFrame, arrived: DataFrame, keep: int = KEEP_SECONDS) -> DataFrame:
    """The shared table after one more micro-batch: counts per recent second, and when each number of zeros
    first came. At most 33 rows, the micro-batch's own seconds and `keep` seconds before them."""
    newest = before.filter("kind = 'second'").agg(F.max("k")).scalar()
    before = before.filter((F.col("kind") == "zeros") | (F.col("k") > newest - keep))
    seconds = arrived.groupBy(_second().alias("k")).agg(F.count(F.lit(1)).alias("n")).filter("k is not null")
    zeros = arrived.groupBy(sketches.trailing_zeros(F.col("subject_id")).cast("long").alias("k")).agg(F.min("arrival").alias("n"))
    parts = before.unionByName(seconds.select(F.lit("second").alias("kind"), "k", "n"))
    parts = parts.unionByName(zeros.filter("k is not null").select(F.lit("zeros").alias("kind"), "k", "n"))
    return parts.groupBy("kind", "k").agg(F.when(F.col("kind") == "second", F.sum("n")).otherwise(F.min("n")).alias("n"))


def with_shared(states: DataFrame, shared: DataFrame) -> DataFrame:
    """Adds events_1h and distinct_estimate: what had arrived by the end of the event's micro-batch."""
    seconds = shared.filter("kind = 'second'").select(F.col("k").alias("_second"), F.col("n").alias("_n"))
    counts = sketches.trailing_totals(seconds, "_second", "_n").select("_second", "events_1h")
    steps = shared.filter("kind = 'zeros'").agg(
        F.collect_list(F.struct(F.col("k").cast("int").alias("z"), F.col("n").alias("since")))
    ).scalar()
    counted = salted_join(states.withColumn("_second", _second()), counts, ["_second"], how="left").drop("_second")
    return counted.withColumn("_steps", steps).withColumn("distinct_estimate", sketches.estimate_at("_steps", "arrival")).drop("_steps")


def trace_batch(
    batch: DataFrame, batch_id: int, path: str, people: DataFrame, index: twins.TwinIndex, k: int = 3,
    write: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """One micro-batch of `arrivals_and_states`: the shared table renewed and the traces written.

    The sink is JSON lines below `path`/traces, or what `write` does with (key, value) rows and a folder of the batch's own.
    """
    # The stream's own session plans without measured sizes; what follows reads files, in the session of the tables beside it.
    spark = people.sparkSession
    batch.write.mode("overwrite").partitionBy("accepted").parquet(f"{path}/staged/v={batch_id}")
    staged = spark.read.schema(batch.schema).parquet(f"{path}/staged/v={batch_id}")
    if staged.isEmpty():  # a micro-batch that only moves the watermark
        return
    newest = sinks.latest_version(spark, f"{path}/shared", before=batch_id)
    before = spark.read.schema(SHARED).parquet(newest) if newest else spark.createDataFrame([], SHARED)
    shared_path = f"{path}/shared/v={batch_id}"
    merge_shared(before, staged.filter("not accepted")).coalesce(1).write.mode("overwrite").parquet(shared_path)
    states = staged.filter("accepted").drop("accepted")
    counted = with_shared(states, spark.read.schema(SHARED).parquet(shared_path))
    # Events are read three times to find their twins, so what was joined to them is written first.
    tagged = salted_join(counted, people, ["subject_id"], how="left")
    tagged.write.mode("overwrite").parquet(f"{path}/tagged/v={batch_id}")
    tagged = spark.read.schema(tagged.schema).parquet(f"{path}/tagged/v={batch_id}")
    twinned = twins.with_twins(tagged, index, "arrival", k)
    told = live.traces(
        twinned.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("event_time", F.col("charttime").cast("timestamp_ntz"))
    )
    lines = live.trace_json(told)
    if write is None:
        lines.select("value").write.mode("overwrite").text(f"{path}/traces/batch={batch_id}")
    else:
        write(lines, f"{path}/traces/batch={batch_id}")
    for folder in ("staged", "shared", "tagged"):
        sinks.forget_versions(spark, f"{path}/{folder}", batch_id)


def live_stream(
    events: DataFrame, demographics: DataFrame, history: DataFrame, path: str, checkpoint: str, rate: str = "sum",
    k: int = 3, n_tables: int = 3, n_bits: int | None = None, available_now: bool = False, every: str = "3 seconds",
) -> StreamingQuery:
    """One query from raw events to traces with twins; started again with the same folders, it goes on.

    `demographics` is (subject_id, group_size), see `plans.live.sizes_of`; `history` the training set. Both are
    written once below `path` and kept over restarts. An event that comes later than the watermark is
    counted as an arrival but gets no trace. A null or unreadable time has no event window: its count is null.
    """
    spark = events.sparkSession
    if not sinks.exists(spark, f"{path}/people/_SUCCESS"):
        demographics.select("subject_id", "group_size").write.mode("overwrite").parquet(f"{path}/people")
    people = spark.read.schema(demographics.select("subject_id", "group_size").schema).parquet(f"{path}/people")
    index = twins.index_of(history, f"{path}/twin-index", n_tables=n_tables, n_bits=n_bits, again=True)
    rows = arrivals_and_states(events, rate)
    return sinks.each_batch(rows, lambda batch, i: trace_batch(batch, i, path, people, index, k), checkpoint, available_now, every)
