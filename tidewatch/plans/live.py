"""The live path in batch form: dedup, estimates, state, score, traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import live, privacy, sketches
from tidewatch.operators.skew import salted_join
from tidewatch.session import work_dir
from tidewatch.sources.layers import settle
from tidewatch.streaming import twins
from tidewatch.streaming.twins import TWINS

def traced(
    events: DataFrame, demographics: DataFrame, history: DataFrame | None = None, rate: str = "sum", batch_id: int = 0,
    n_tables: int = 3, n_bits: int | None = None,
) -> DataFrame:
    """One trace per accepted event, with its twins in `history` if there is one.

    Duplicates count in the estimates and are then dropped; the k tag is the real size of the
    patient's quasi-identifier group.
    """
    arrived = settle(events, "arrived")
    counted = sketches.trailing_event_count(arrived)
    estimated = sketches.distinct_estimate_running(counted)
    unique = sketches.event_dedup(estimated)
    state = live.scored(live.live_state(unique, rate))
    tagged = salted_join(state, sizes_of(demographics), ["subject_id"], how="left")
    if history is None:
        twinned = tagged.withColumn("twins", F.lit(None).cast(TWINS))
    else:
        tagged = settle(tagged, "to-twin")
        index = twins.index_of(history, work_dir(events.sparkSession, "twin-index"), n_tables=n_tables, n_bits=n_bits)
        twinned = twins.with_twins(tagged, index)
    return live.traces(twinned.withColumn("batch_id", F.lit(batch_id).cast("bigint")))


def sizes_of(demographics: DataFrame) -> DataFrame:
    """(subject_id, group_size): how many patients share a patient's quasi-identifiers."""
    return privacy.group_size_tag(privacy.generalize(demographics)).select(
        F.col("patientunitstayid").alias("subject_id"), "group_size"
    )
