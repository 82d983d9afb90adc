"""Counts and samples over event streams: batch forms, each mergeable or pre-aggregated."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.hashing import hash32, hash52

EVENT_KEY = ("subject_id", "charttime", "event_type", "value")


def event_key(columns: Sequence[str] = EVENT_KEY) -> Column:
    """The identity of an event as text. Doubles enter as thousandths."""
    parts = []
    for c in columns:
        text = F.round(F.col(c) * 1000).cast("bigint") if c == "value" else F.col(c)
        parts.append(F.coalesce(text.cast("string"), F.lit("~")))
    return F.concat_ws("|", *parts)


def event_dedup(df: DataFrame, key: Sequence[str] = EVENT_KEY, arrival: str = "arrival") -> DataFrame:
    """The first arrival of every key. Copies of a hot event collapse before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    firsts = df.groupBy(*key).agg(F.min_by(F.struct(*rest), arrival).alias("_first"))
    return firsts.select(*key, "_first.*").select(*df.columns)


def duplicate_report(df: DataFrame, key: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Arrivals, distinct events, duplicates and their rate."""
    copies = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("arrivals"), F.count(F.lit(1)).alias("unique_events")
    ).select(
        "arrivals",
        "unique_events",
        (F.col("arrivals") - F.col("unique_events")).alias("duplicates"),
        F.round(F.try_divide(F.col("arrivals") - F.col("unique_events"), F.col("arrivals").cast("double")), 6).alias(
            "duplicate_rate"
        ),
    )


def trailing_event_count(
    df: DataFrame, time: str = "event_time", key: Sequence[str] = (), seconds: int = 3600,
    out: str = "events_1h",
) -> DataFrame:
    """Events in the trailing window, both ends included, on every event.

    Events are counted per distinct second first. Seconds are cut into blocks as long as the
    window and each is copied to the next block, so a frame never leaves its block: a block
    holds at most two windows of seconds, however many events they stand for.
    """
    per_second = (
        df.groupBy(*key, time)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_second", second_of(F.col(time)))
    )
    counts = trailing_totals(per_second, "_second", "_n", key, seconds, out).select(*key, time, out)
    # There are about as many counts as events; seconds spread them already.
    return df.join(counts, [*key, time])


def second_of(time: Column) -> Column:
    """Whole seconds of a time since 2000."""
    return F.timestamp_diff("SECOND", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), time)


def trailing_totals(
    per_second: DataFrame, second: str, n: str, key: Sequence[str] = (), seconds: int = 3600, out: str = "events_1h"
) -> DataFrame:
    """Adds the total of `n` over the trailing window, given one row per key and second."""
    home = F.floor(F.col(second) / seconds)
    copied = per_second.withColumn("_home", home).withColumn("_part", F.explode(F.array(F.col("_home"), F.col("_home") + 1)))
    w = Window.partitionBy(*key, "_part").orderBy(second).rangeBetween(-seconds, 0)
    totals = copied.withColumn(out, F.sum(n).over(w)).filter(F.col("_part") == F.col("_home"))
    return totals.select(*per_second.columns, out)


def trailing_zeros(value: Column) -> Column:
    """Trailing zero bits of a hash's 32-bit value; null for 0."""
    h = hash32(value)
    return F.when(h != 0, F.bit_count(h.bitwiseAND(-h) - 1))


def distinct_estimate(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """2 to the most trailing zeros: a coarse distinct count that merges by max."""
    return df.groupBy(*by).agg(
        F.pow(F.lit(2), F.coalesce(F.max(trailing_zeros(F.col(column))), F.lit(0))).cast("bigint").alias("estimate")
    )


def distinct_estimate_running(
    df: DataFrame, column: str = "subject_id", arrival: str = "arrival", out: str = "distinct_estimate"
) -> DataFrame:
    """The estimate after every arrival.

    It only depends on when each number of zeros was first reached: at most 33 pairs, which one
    small aggregate finds. No ordered pass over the events is needed.
    """
    reached = df.select(trailing_zeros(F.col(column)).alias("z"), F.col(arrival).alias("a")).groupBy("z").agg(
        F.min("a").alias("since")
    )
    steps = reached.filter(F.col("z").isNotNull()).agg(F.collect_list(F.struct("z", "since"))).scalar()
    return df.withColumn("_steps", steps).withColumn(out, estimate_at("_steps", arrival)).drop("_steps")


def estimate_at(steps: str, arrival: str) -> Column:
    """The estimate at an arrival, given an array of (z, since): when each number of zeros was first reached."""
    reached = F.filter(steps, lambda s: s["since"] <= F.col(arrival))
    so_far = F.array_max(F.transform(reached, lambda s: s["z"]))
    return F.pow(F.lit(2), F.coalesce(so_far, F.lit(0))).cast("bigint")


def sliding_counts(
    df: DataFrame, time: str, window: str = "1 hour", slide: str = "10 minutes"
) -> DataFrame:
    """Events per sliding window; partial counts combine before the shuffle."""
    return (
        df.groupBy(F.window(time, window, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "events",
        )
    )


WORD_BITS = 62


def _positions(key: Column, bits: int, hashes: int) -> Column:
    return F.array(*[hash52(F.concat(F.lit(f"{i}:"), key)) % F.lit(bits).cast("bigint") for i in range(hashes)])


def bloom_shape(error_rate: float) -> tuple[int, int]:
    """Bits per key and number of hashes for a wanted rate of wrong answers."""
    per_key = math.ceil(-math.log(error_rate) / math.log(2) ** 2)
    return per_key, max(1, round(per_key * math.log(2)))


def bloom_bits(keys: int, error_rate: float) -> int:
    """Size of a filter for so many distinct keys."""
    return max(1, keys) * bloom_shape(error_rate)[0]


def bloom_build(keys: DataFrame, key: str, bits: int, hashes: int) -> DataFrame:
    """A Bloom filter as a table of 62-bit words: at most bits / 62 rows, merged by bit-or."""
    return (
        keys.select(F.explode(_positions(F.col(key), bits, hashes)).alias("p"))
        .groupBy(F.floor(F.col("p") / WORD_BITS).cast("bigint").alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("p") % WORD_BITS).cast("int"))).alias("mask"))
    )


def bloom_membership(
    probes: DataFrame, bloom: DataFrame, key: str, bits: int, hashes: int
) -> DataFrame:
    """Every distinct probe key with `maybe_seen`: false is certain, true may be wrong."""
    spots = probes.select(key).distinct().select(
        key, F.explode(_positions(F.col(key), bits, hashes)).alias("p")
    ).withColumn("word", F.floor(F.col("p") / WORD_BITS).cast("bigint"))
    bit = F.call_function("shiftright", F.col("mask"), (F.col("p") % WORD_BITS).cast("int")).bitwiseAND(F.lit(1))
    hit = F.coalesce(bit == 1, F.lit(False))
    return spots.join(bloom, "word", "left").groupBy(key).agg(F.bool_and(hit).alias("maybe_seen"))


def reservoir_sample(df: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """k rows, each equally likely: the k smallest hash priorities, so samples merge."""
    priority = hash52(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_priority", priority).orderBy("_priority", key).limit(k).drop("_priority")


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row per key; one row per key and task is shuffled."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")


def last_n_per_key(df: DataFrame, key: str, order: Sequence[str], n: int = 100) -> DataFrame:
    """The newest n rows per key. Each task keeps at most n per key before the shuffle."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= n)


def latest_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def distribution_params(df: DataFrame, columns: dict[str, tuple[str, str]], defaults: dict[str, float]) -> DataFrame:
    """Means and sample deviations; a default stands in for null and for zero.

    `columns` maps an output name to (avg or stddev_samp, input column).
    """
    return df.agg(
        *[
            F.round(F.coalesce(F.nullif(getattr(F, fn)(c), F.lit(0.0)), F.lit(defaults[out])), 6).alias(out)
            for out, (fn, c) in columns.items()
        ]
    )
