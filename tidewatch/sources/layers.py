"""Layered tables: read, write, settle, and the sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import work_dir

LAYERS = ("bronze", "silver", "gold", "mart")


def _name(layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}; one of {LAYERS}")
    return f"{layer}.{table}"


def layer_read(spark: SparkSession, layer: str, table: str) -> DataFrame:
    return spark.read.table(_name(layer, table))


def layer_write(df: DataFrame, layer: str, table: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a table of a layer; the layer's database is made on first use."""
    name = _name(layer, table)
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    df.write.format(fmt).mode(mode).saveAsTable(name)
    return name


def materialize(df: DataFrame, layer: str, table: str) -> DataFrame:
    """Staging models are views, all other layers are tables."""
    if layer == "staging":
        df.createOrReplaceTempView(table)
        return df.sparkSession.table(table)
    return df.sparkSession.read.table(layer_write(df, layer, table))


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Cuts the lineage, so a lost executor re-reads files instead of re-running the plan, and
    lets operators that read their input more than once do so cheaply.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_sink(df: DataFrame, path: str, fmt: str = "csv") -> None:
    options = {"header": "true"} if fmt == "csv" else {}
    df.write.format(fmt).options(**options).mode("overwrite").save(path)


def layer_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def limited_read(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in a stated order, so that the answer is repeatable."""
    return df.orderBy(*order).limit(n)
