"""From raw strings to typed, filtered events; cleaning; long timelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators.skew import salted_join


def ntz(text: str | Column) -> Column:
    """A raw time string as a timestamp without zone, null when it does not parse."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("timestamp_ntz")


def stage_labs(
    raw: DataFrame,
    items: Sequence[int] = config.CREATININE_ITEMS,
    unit: str = config.CREATININE_UNIT,
    bounds: tuple[float, float] = config.CREATININE_BOUNDS,
) -> DataFrame:
    """Creatinine events: allowlisted items in one unit and a plausible range."""
    value = F.col("valuenum").try_cast("double")
    return raw.filter(
        F.col("itemid").isin([str(i) for i in items])
        & (F.col("valueuom") == unit)
        & value.between(*bounds)
    ).select(
        F.col("subject_id").try_cast("bigint").alias("subject_id"),
        F.col("hadm_id").try_cast("bigint").alias("hadm_id"),
        F.col("itemid").try_cast("bigint").alias("itemid"),
        ntz("charttime").alias("charttime"),
        value.alias("creatinine_mg_dl"),
    )


def stage_outputs(
    raw: DataFrame,
    items: Sequence[int] = config.URINE_ITEMS,
    unit: str = config.URINE_UNIT,
    bounds: tuple[float, float] = config.URINE_BOUNDS,
) -> DataFrame:
    """Urine events. A row whose time does not parse stays, and finds no stay later."""
    value = F.col("value").try_cast("double")
    return raw.filter(
        F.col("itemid").isin([str(i) for i in items])
        & (F.col("valueuom") == unit)
        & value.between(*bounds)
    ).select(
        F.col("subject_id").try_cast("bigint").alias("subject_id"),
        F.col("hadm_id").try_cast("bigint").alias("hadm_id"),
        F.col("stay_id").try_cast("bigint").alias("stay_id"),
        F.col("itemid").try_cast("bigint").alias("itemid"),
        ntz("charttime").alias("charttime"),
        value.alias("urine_ml"),
    )


def stage_stays(raw: DataFrame) -> DataFrame:
    """Typed stays with all keys and a positive length. Bad values raise: casts are strict."""
    typed = raw.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("subject_id", "hadm_id", "stay_id")],
        "first_careunit",
        "last_careunit",
        F.col("intime").cast("timestamp_ntz").alias("intime"),
        F.col("outtime").cast("timestamp_ntz").alias("outtime"),
        F.col("los").cast("double").alias("los"),
    )
    return typed.dropna(subset=["subject_id", "hadm_id", "stay_id", "intime", "outtime"]).filter(
        F.col("intime") < F.col("outtime")
    )


def icu_cohort(stays: DataFrame) -> DataFrame:
    return stays.select(
        "subject_id", "hadm_id", "stay_id", "first_careunit", "last_careunit", "intime", "outtime", "los"
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates removed; equal rows already collapse before the shuffle."""
    return df.dropDuplicates()


def dictionary_join(events: DataFrame, dictionary: DataFrame, label_as: str = "label") -> DataFrame:
    """Events with their item's label; a frequent item is spread over tasks."""
    items = dictionary.select("itemid", F.col("label").alias(label_as)).dropDuplicates()
    return salted_join(events, items, ["itemid"])


def clean_labs_by_label(
    labs: DataFrame,
    dictionary: DataFrame,
    word: str = config.CREATININE_LABEL,
    bounds: tuple[float, float] = config.CLEAN_CREATININE_BOUNDS,
) -> DataFrame:
    """Lab rows whose dictionary label contains a word, complete, timed and in range."""
    wanted = dictionary.filter(F.lower("label").contains(word.lower()))
    rows = labs.withColumn("event_time", ntz("charttime")).filter(
        F.col("subject_id").isNotNull()
        & F.col("hadm_id").isNotNull()
        & F.col("event_time").isNotNull()
        & F.col("valuenum").between(*bounds)
    )
    return dedup_rows(dictionary_join(rows, wanted, "lab_label").withColumnRenamed("valuenum", "creatinine"))


def clean_outputs_by_label(
    outputs: DataFrame,
    dictionary: DataFrame,
    pattern: str = config.URINE_LABEL_PATTERN,
    bounds: tuple[float, float] = config.CLEAN_URINE_BOUNDS,
) -> DataFrame:
    """Output rows whose dictionary label matches a pattern anywhere, also inside a word."""
    wanted = dictionary.filter(F.col("label").rlike(f"(?i){pattern}"))
    rows = outputs.withColumn("event_time", ntz("charttime")).filter(
        F.col("subject_id").isNotNull()
        & F.col("hadm_id").isNotNull()
        & F.col("stay_id").isNotNull()
        & F.col("event_time").isNotNull()
        & F.col("value").between(*bounds)
    )
    return dedup_rows(
        dictionary_join(rows, wanted, "output_label").withColumnRenamed("value", "urine_output_ml")
    )


def clean_patients(
    patients: DataFrame, ages=config.AGE_BOUNDS, weights=config.WEIGHT_BOUNDS
) -> DataFrame:
    return dedup_rows(patients).filter(
        F.col("patientunitstayid").isNotNull()
        & F.col("age").between(*ages)
        & F.col("admissionweight").between(*weights)
    )


def conditional_range_filter(
    labs: DataFrame, name: str = "creatinine", bounds=config.CLEAN_CREATININE_BOUNDS
) -> DataFrame:
    """Names tidied; the range applies to one lab only. A missing name is kept, as "nan"."""
    tidy = F.coalesce(F.lower(F.trim("labname")), F.lit("nan"))
    return (
        labs.withColumn("labname", tidy)
        .dropna(subset=["patientunitstayid", "labresultoffset", "labresult"])
        .filter((F.col("labname") != name) | F.col("labresult").between(*bounds))
    )


def clean_intake(intake: DataFrame, bounds=config.CLEAN_URINE_BOUNDS) -> DataFrame:
    return intake.dropna(
        subset=["patientunitstayid", "intakeoutputoffset", "cellvaluenumeric"]
    ).filter(F.col("cellvaluenumeric").between(*bounds))


def offset_to_time(minutes: str, epoch: str = config.OFFSET_EPOCH) -> Column:
    return F.timestamp_add("MINUTE", F.col(minutes), F.lit(epoch).cast("timestamp_ntz"))


def to_event_timeline(
    df: DataFrame, keys: Sequence[str], measure: str, event_type: str, unit: str
) -> DataFrame:
    """A wide measure as long events: keys, time, type, value, unit."""
    return df.select(
        *keys,
        "event_time",
        F.lit(event_type).alias("event_type"),
        F.col(measure).alias("value"),
        F.lit(unit).alias("unit"),
    )


def union_timelines(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; a column that only one side has is null on the other."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def timeline_sort(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A global order, by range partitions: no single task sorts everything."""
    return df.orderBy(*keys)


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.fillna(defaults)


def normalize_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def normalize_units(
    df: DataFrame, factors: DataFrame, value: str = "value", unit: str = "valueuom", target: str = "mg/dL"
) -> DataFrame:
    """Values converted by a (unit, factor) table; a unit without a factor keeps its value."""
    units = factors.select(F.col("unit").alias(unit), F.col("factor").cast("double").alias("_factor"))
    known = F.col("_factor").isNotNull()
    return (
        salted_join(df, units, [unit], how="left")
        .withColumn(value, F.when(known, F.col(value) * F.col("_factor")).otherwise(F.col(value)))
        .withColumn(unit, F.when(known, F.lit(target)).otherwise(F.col(unit)))
        .drop("_factor")
    )


def anti_join_excluded(df: DataFrame, excluded: DataFrame, key: str = "itemid") -> DataFrame:
    return salted_join(df, excluded.select(key).distinct(), [key], how="left_anti")
