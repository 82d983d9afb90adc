"""The metric log: rows of (time, name, value, JSON extra)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas


def metric_rows(stats: DataFrame, metrics: Mapping[str, Column], extra: Column | None = None) -> DataFrame:
    """Wide statistics as metric rows, one per metric and input row."""
    extra = F.lit(None).cast("string") if extra is None else extra
    cells = F.array(
        *[F.struct(F.lit(n).alias("metric_name"), c.cast("double").alias("metric_value")) for n, c in metrics.items()]
    )
    return stats.select(
        F.current_timestamp().alias("metric_ts"), extra.alias("extra_json"), F.inline(cells)
    ).select("metric_ts", "metric_name", "metric_value", "extra_json")


def append_metrics(rows: DataFrame, path: str) -> None:
    rows.select(*schemas.METRIC_LOG.fieldNames()).write.mode("append").parquet(path)


def write_metrics(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows of one micro-batch under its number: written again, they replace themselves."""
    rows.select(*schemas.METRIC_LOG.fieldNames()).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def sample_rows(log: DataFrame) -> DataFrame:
    """The sampled events inside the log's JSON, with the measure told from the type's name."""
    extra = F.from_json("extra_json", schemas.METRIC_EXTRA)
    kind = F.lower(F.coalesce("s.event_type", F.lit("")))
    return (
        log.select(F.explode(extra.getField("sample")).alias("s"))
        .select(
            F.col("s.value").alias("value"),
            F.when(kind.contains("creat"), "creatinine")
            .when(kind.contains("urine"), "urine")
            .otherwise("other")
            .alias("measure"),
        )
    )
