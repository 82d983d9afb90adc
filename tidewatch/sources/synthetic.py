"""Seeded live events: half creatinine, half urine, one patient in five sick.

All draws are hashes of the event's id and the seed, so a retried task makes the same events.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions.hashing import hash32, unit_uniform
from tidewatch.functions.numeric import round_half_up
from tidewatch.operators.skew import running
from tidewatch.sources.layers import settle

# The patient pool, the sick shifts, the floors and the clock steps in minutes.
FIRST_PATIENT = 9000000
PATIENTS = 100
SICK_EVERY = 5
SICK_CREATININE = (1.0, 3.5)
SICK_URINE = (10.0, 30.0)
CREATININE_FLOOR = 0.2
STEP_MINUTES = (1, 15)


def _draw(name: str, ident: Column, seed: int) -> Column:
    return unit_uniform(F.concat(F.lit(f"{seed}:{name}:"), ident.cast("string")))


def _gauss(ident: Column, seed: int) -> Column:
    u, v = _draw("g1", ident, seed), _draw("g2", ident, seed)
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v)


def synthetic_values(
    ids: DataFrame, ident: str = "id", params: Mapping[str, float] = config.GENERATOR_DEFAULTS, seed: int = 42,
    patients: int = PATIENTS,
) -> DataFrame:
    """One event per id, next to the other columns of `ids`. Works on a stream as well."""
    i = F.col(ident)
    patient = F.lit(FIRST_PATIENT) + hash32(F.concat(F.lit(f"{seed}:p:"), i.cast("string"))) % patients
    is_creatinine = _draw("kind", i, seed) > 0.5
    sick = F.col("subject_id") % SICK_EVERY == 0
    shift = _draw("shift", i, seed)
    low, high = SICK_CREATININE
    creatinine = (
        F.lit(params["creat_mean"])
        + F.lit(params["creat_std"]) * _gauss(i, seed)
        + F.when(sick, F.lit(low) + F.lit(high - low) * shift).otherwise(0.0)
    )
    low, high = SICK_URINE
    urine = (
        F.lit(params["urine_mean"])
        + F.lit(params["urine_std"]) * _gauss(i, seed)
        - F.when(sick, F.lit(low) + F.lit(high - low) * shift).otherwise(0.0)
    )
    return ids.withColumn("subject_id", patient).select(
        *ids.columns,
        "subject_id",
        (F.col("subject_id") * 10).alias("hadm_id"),
        (F.col("subject_id") * 100).alias("stay_id"),
        F.when(is_creatinine, "creatinine").otherwise("urine").alias("event_type"),
        F.when(is_creatinine, F.greatest(F.lit(CREATININE_FLOOR), round_half_up(creatinine, 2)))
        .otherwise(F.greatest(F.lit(0.0), round_half_up(urine, 2)))
        .alias("value"),
        F.when(is_creatinine, config.CREATININE_UNIT).otherwise(config.URINE_UNIT).alias("uom"),
    )


def synthetic_events(
    ids: DataFrame, ident: str = "id", start: str = "2024-01-01 00:00:00",
    params: Mapping[str, float] = config.GENERATOR_DEFAULTS, seed: int = 42,
) -> DataFrame:
    """Events with a clock that moves on by 1 to 15 minutes per event, in id order.

    The clock is a running sum in two levels: inside blocks of ids, then over the blocks.
    """
    low, high = STEP_MINUTES
    i = F.col(ident)
    step = F.lit(low) + hash32(F.concat(F.lit(f"{seed}:step:"), i.cast("string"))) % (high - low + 1)
    numbered = settle(ids.select(ident), "synthetic-ids").withColumn("_step", step)
    timed = running(numbered, [], [ident], F.floor(i / 100000), {"_clock": ("sum", "_step")})
    clock = F.timestamp_add(
        "MINUTE", (F.col("_clock") - F.col("_step")).cast("int"), F.lit(start).cast("timestamp_ntz")
    )
    timed = timed.select(ident, F.date_format(clock, config.EVENT_TIME_FORMAT).alias("charttime"))
    return synthetic_values(timed, ident, params, seed)


def synthetic_stream(
    spark: SparkSession, rows_per_second: int = 5, params: Mapping[str, float] = config.GENERATOR_DEFAULTS, seed: int = 42
) -> DataFrame:
    """An endless stream of events at a steady rate, on the wall clock."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    ids = rate.select(
        F.col("value").alias("id"), F.date_format("timestamp", config.EVENT_TIME_FORMAT).alias("charttime")
    )
    return synthetic_values(ids, "id", params, seed)
