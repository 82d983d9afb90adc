"""Per-patient state on a stream: two short histories in the state store by shards of patients, scored per event.

The processor only keeps and emits histories; features are the column expressions of the batch form.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch import config
from tidewatch.operators.live import HISTORY, creatinine_state, known_values, scored, urine_state

#: Patients are dealt to so many shards. A shard's patients share a call and a state value per micro-batch, as a call
#: and its state requests cost more than the work on a patient's few events.
SHARDS = 1024
HISTORIES = pa.schema(
    [
        ("known", pa.bool_()), ("subject", pa.int64()), ("creatinine", pa.list_(pa.float64())), ("urine", pa.list_(pa.float64())),
        ("event_count", pa.int64()), ("touched", pa.int64()),
    ]
)
#: An event with both histories of its patient just after it; a null patient or arrival is 0, and marked.
OUTPUT = (
    "known boolean, subject long, charttime string, event_type string, value double, unnumbered boolean, arrival long, uom string, "
    "event_count long, creatinine_history array<double>, urine_history array<double>"
)
CARRIED = ("known", "subject", "charttime", "event_type", "value", "unnumbered", "arrival", "uom")
COLUMNS = ("subject_id", "charttime", "event_type", "value", "arrival", "uom")


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(stored: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(stored))).read_all()


class PatientState(StatefulProcessor):
    """Keeps the last 20 values of each measure per patient of a shard."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("histories", "patients binary", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_ms else 0
        stored = self.state.get()
        patients = list(zip(*[c.to_pylist() for c in from_bytes(stored[0]).columns])) if stored else []
        kept = {p[:2]: p[2:] for p in patients if not self.ttl_ms or p[5] + self.ttl_ms > now}
        # One shard's events of one micro-batch; the source's batch limit bounds them.
        out = pd.concat(list(rows), ignore_index=True)[list(CARRIED)]
        out = out.sort_values(["known", "subject", "charttime", "unnumbered", "arrival"], ignore_index=True)
        known, subject, values = out["known"].to_numpy(bool), out["subject"].to_numpy(np.int64), out["value"].to_numpy(np.float64)
        kinds = ((out["event_type"] == "creatinine").to_numpy(bool), out["event_type"].isin(["urine", "urine_output"]).to_numpy(bool))
        cuts = np.flatnonzero((subject[1:] != subject[:-1]) | (known[1:] != known[:-1])) + 1
        counts, histories = np.zeros(len(out), np.int64), ([], [])
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(out)], strict=True):
            who = bool(known[start]), int(subject[start])
            *before, count, _ = kept.get(who, ([], [], 0, 0))
            ends = []
            for lists, had, own in zip(histories, before, kinds, strict=True):
                own = own[start:end]
                series = np.concatenate([np.array(had, np.float64), values[start:end][own]])
                lists += [series[max(0, n - HISTORY) : n] for n in (len(had) + np.cumsum(own)).tolist()]
                ends.append(series[-HISTORY:].tolist())
            counts[start:end] = count + np.arange(1, end - start + 1)
            kept[who] = (*ends, count + end - start, now)
        out["event_count"], out["creatinine_history"], out["urine_history"] = counts, *histories
        columns = zip(*[(*who, *state) for who, state in kept.items()], strict=True)
        self.state.update((to_bytes(pa.table([list(c) for c in columns], schema=HISTORIES)),))
        yield out

    def close(self) -> None:
        pass


def with_state(spark: SparkSession, module: str) -> None:
    """Settings of a stream whose processor stands in `module`."""
    # The state's Python process on the driver knows no shipped files: it gets the class itself, and the helpers of this module.
    for name in {module, __name__}:
        cloudpickle.register_pickle_by_value(sys.modules[name])
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def stream_patient_state(
    events: DataFrame, rate: str = "sum", weight: float = config.DEFAULT_WEIGHT_KG, ttl_hours: int | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """The live state, stage and score of every event of a stream.

    Events of a micro-batch are taken in event-time order; across micro-batches the order is
    that of arrival. State is in RocksDB, 40 numbers per patient, and can expire patient by patient; patients are dealt
    to `shards`, which a checkpoint keeps. Limit the source's micro-batch (files or offsets per trigger): one shard's events
    of one micro-batch are ordered in memory.
    """
    with_state(events.sparkSession, __name__)
    ttl = ttl_hours * 3600 * 1000 if ttl_hours else None
    dealt = known_values(events).withColumns(
        {
            "_shard": F.pmod(F.xxhash64(F.col("subject_id").cast("bigint")), F.lit(shards)),
            "known": F.col("subject_id").isNotNull(), "subject": F.coalesce(F.col("subject_id").cast("bigint"), F.lit(0)),
            "unnumbered": F.col("arrival").isNull(), "arrival": F.coalesce(F.col("arrival").cast("bigint"), F.lit(0)),
        }
    )
    kept = dealt.select("_shard", *CARRIED).groupBy("_shard").transformWithStateInPandas(
        statefulProcessor=PatientState(ttl),
        outputStructType=OUTPUT,
        outputMode="append",
        timeMode="processingTime" if ttl else "none",
    )
    state = kept.withColumns({"subject_id": F.when(F.col("known"), F.col("subject")), "arrival": F.when(~F.col("unnumbered"), F.col("arrival"))})
    features = F.struct(
        creatinine_state(F.col("creatinine_history")).alias("c"), urine_state(F.col("urine_history"), rate, weight).alias("u")
    )
    return scored(state.withColumn("_f", features).select(*COLUMNS, "event_count", "_f.c.*", "_f.u.*"))
