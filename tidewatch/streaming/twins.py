"""Nearest historical rows for the events of a stream."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch import config
from tidewatch.functions.numeric import round_half_up
from tidewatch.operators import similarity
from tidewatch.streaming.sinks import each_batch, exists


def live_features(scored_events: DataFrame, key: str) -> DataFrame:
    """The live state under the names of the historical features; what it lacks is null."""
    known = {
        "creatinine": F.col("creatinine"),
        "baseline_creatinine": F.col("baseline"),
        "creatinine_ratio": F.col("cr_ratio"),
        "creatinine_delta_1h": F.col("cr_delta_recent"),
        "urine_ml_per_kg_hr_6h": F.col("uo_ml_kg_hr_6h"),
        "urine_ml_per_kg_hr_24h": F.col("uo_ml_kg_hr_24h"),
    }
    null = F.lit(None).cast("double")
    return scored_events.select(key, *[known.get(c, null).alias(c) for c in config.FEATURES])


SHOWN = ("outcome", "cr", "uo")


def shown(history: DataFrame) -> DataFrame:
    """History with what is told about a twin: its outcome, creatinine and urine."""
    return history.select(
        "*",
        F.when(F.col(config.TARGET) == 1, "Stage 3 AKI").otherwise("Stable").alias("outcome"),
        round_half_up(F.col("creatinine"), 2).alias("cr"),
        round_half_up(F.col("urine_output_ml"), 1).alias("uo"),
    )


TWINS = "array<struct<id:string,outcome:string,dist:double,cr:double,uo:double>>"


class TwinIndex(NamedTuple):
    """A history hashed and written by table and bucket, and what a search of it needs."""

    rows: DataFrame
    moments: similarity.Moments
    key: str
    n_tables: int
    n_bits: int


def index_of(
    history: DataFrame, path: str, key: str = "row_key", n_tables: int = 3, n_bits: int | None = None,
    again: bool = False,
) -> TwinIndex:
    """The index of a history below `path`; with `again`, the one that is there already, if any.

    Without `n_bits` the buckets follow the number of rows. The shape and the moments are written beside the
    index, last of all, so that a restarted stream searches what it searched before.
    """
    spark = history.sparkSession
    about = f"{path}-about"
    schema = "mean array<double>, spread array<double>, n_tables int, n_bits int"
    if not (again and exists(spark, f"{about}/_SUCCESS")):
        moments = similarity.feature_moments(history)
        n_bits = similarity.bits_for(history.count()) if n_bits is None else n_bits
        rows = similarity.lsh_index(shown(history), key, moments, n_tables=n_tables, n_bits=n_bits, keep=SHOWN)
        similarity.write_index(rows, path)
        one = spark.createDataFrame([(*moments, n_tables, n_bits)], schema)
        one.coalesce(1).write.mode("overwrite").parquet(about)
    told = spark.read.schema(schema).parquet(about).first()
    moments = similarity.Moments(told["mean"], told["spread"])
    # The schema is that of any index of this history; no row is hashed for it.
    empty = similarity.lsh_index(shown(history.limit(0)), key, moments, n_tables=told["n_tables"], n_bits=told["n_bits"], keep=SHOWN)
    return TwinIndex(spark.read.schema(empty.schema).parquet(path), moments, key, told["n_tables"], told["n_bits"])


def twins_of(events: DataFrame, index: TwinIndex, key: str = "arrival", k: int = 3, features: Sequence[str] = config.FEATURES) -> DataFrame:
    """Per event its nearest rows with outcome, distance, creatinine and urine, by rank.

    Events with the same features are searched once where they meet. The index holds what is shown; only the
    folders of the events' own buckets are read.
    """
    lists = twin_lists(events, index, key, k, features)
    return lists.select(key, F.posexplode("nearest").alias("_at", "_t")).select(
        key, (F.col("_at") + 1).alias("rank"), F.col(f"_t.{index.key}").alias("twin_id"), "_t.outcome", "_t.distance", "_t.cr", "_t.uo"
    )


def twin_lists(events: DataFrame, index: TwinIndex, key: str = "arrival", k: int = 3, features: Sequence[str] = config.FEATURES) -> DataFrame:
    """Per event the list `nearest` of its nearest rows, null or empty where no row shares a bucket."""
    return similarity.lsh_lists(
        live_features(events, key), index.rows, index.moments, index.key, features, k, index.n_tables, index.n_bits, query_key=key, keep=SHOWN
    )


def with_twins(events: DataFrame, index: TwinIndex, key: str = "arrival", k: int = 3) -> DataFrame:
    """Adds `twins`, the k nearest rows in order of distance; an empty list where no row shares a bucket."""
    found = twin_lists(events, index, key, k)
    ranked = F.transform("nearest", lambda t, i: F.struct(
        (i + 1).alias("rank"), t[index.key].cast("string").alias("id"), t["outcome"].alias("outcome"), t["distance"].alias("dist"),
        t["cr"].alias("cr"), t["uo"].alias("uo"),
    ))
    # A key that events share has the twins of all of them.
    lists = found.groupBy(F.col(key).alias("_twins_of")).agg(F.sort_array(F.flatten(F.collect_list(ranked))).alias("_ranked"))
    joined = events.join(lists, F.col(key) == F.col("_twins_of"), "left")
    plain = F.transform("_ranked", lambda t: F.struct(*[t[c].alias(c) for c in ("id", "outcome", "dist", "cr", "uo")]))
    return joined.withColumn("twins", F.coalesce(plain, F.array().cast(TWINS))).drop("_twins_of", "_ranked")


def stream_twins(
    scored_events: DataFrame, history: DataFrame, path: str, checkpoint: str, k: int = 3,
    history_key: str = "row_key", n_tables: int = 3, n_bits: int | None = None, available_now: bool = False,
) -> StreamingQuery:
    """Twins of every event. The history is hashed and written once, by table and bucket; a
    micro-batch reads the buckets of its own events and never the history."""
    index = index_of(history, f"{path}-index", history_key, n_tables, n_bits, again=True)

    def search(batch: DataFrame, batch_id: int) -> None:
        twins_of(batch, index, "arrival", k).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return each_batch(scored_events, search, checkpoint, available_now)
