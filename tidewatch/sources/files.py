"""Delimited files: raw all-string loads, typed loads, input checks, bronze ingest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import config

CORRUPT = "_corrupt_record"


def raw_csv_load(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, multi_line: bool = False
) -> DataFrame:
    """Every column a string. A row with too few or too many fields is padded or cut, not lost,
    and its text is kept in `_corrupt_record`. A doubled quote inside quotes is a quote. With
    `multi_line` quoted line feeds are kept, and each file is one task, as gzip files are anyway."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", True)
        .csv(path)
    )


def typed_csv_load(
    spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None, multi_line: bool = False
) -> DataFrame:
    """A typed load with the same quoting. A gzip file is one split, so it can be spread right after reading."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("timestampNTZFormat", config.EVENT_TIME_FORMAT)
        .option("timestampFormat", config.EVENT_TIME_FORMAT)
        .csv(path)
    )
    return df.repartition(partitions) if partitions else df


def required_inputs(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Fail before any work when inputs are missing, naming all of them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for name, path in paths.items():
        target = jvm.org.apache.hadoop.fs.Path(path)
        if not target.getFileSystem(conf).exists(target):
            missing.append(f"{name}: {path}")
    if missing:
        raise FileNotFoundError("missing required inputs: " + "; ".join(missing))


def schema_coverage(
    tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]] = config.REQUIRED_COLUMNS
) -> DataFrame:
    """Per table, its required columns, those missing, and whether it is complete."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        missing = [c for c in required[name] if c not in df.columns]
        rows.append((name, len(required[name]), ",".join(missing), not missing))
    return spark.createDataFrame(
        rows, "table_name string, required_columns int, missing_columns string, complete boolean"
    )


def bronze_ingest(df: DataFrame, batch_id: str) -> DataFrame:
    """Raw rows with load time, source file and batch."""
    return df.select(
        "*",
        F.current_timestamp().alias("ingest_ts"),
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(batch_id).alias("batch_id"),
    )
