"""The plans bound to the tables derived from a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import privacy, series, sketches, staging
from tidewatch.plans import cohort, fixtures
from tidewatch.plans.warehouse import Warehouse
from tidewatch.sources.layers import settle


def warehouse(spark: SparkSession, sf: str) -> Warehouse:
    return Warehouse(
        fixtures.labs_raw(spark, sf), fixtures.outputs_raw(spark, sf), fixtures.stays_raw(spark, sf)
    )


def hospital_labs(spark: SparkSession, sf: str) -> DataFrame:
    """Labs with typed keys and numbers, the time still text."""
    return fixtures.labs_raw(spark, sf).select(
        *[F.col(c).try_cast("bigint").alias(c) for c in ("labevent_id", "subject_id", "hadm_id", "itemid")],
        "charttime",
        F.col("valuenum").try_cast("double").alias("valuenum"),
        "valueuom",
    )


def hospital_outputs(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.outputs_raw(spark, sf).select(
        *[F.col(c).try_cast("bigint").alias(c) for c in ("subject_id", "hadm_id", "stay_id", "itemid")],
        "charttime",
        F.col("value").try_cast("double").alias("value"),
        "valueuom",
    )


def hospital_creatinine(spark: SparkSession, sf: str) -> DataFrame:
    return staging.clean_labs_by_label(hospital_labs(spark, sf), fixtures.d_labitems(spark, sf))


def hospital_urine(spark: SparkSession, sf: str) -> DataFrame:
    return staging.clean_outputs_by_label(hospital_outputs(spark, sf), fixtures.d_items(spark, sf))


def hospital_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.hospital_hourly(hospital_creatinine(spark, sf), hospital_urine(spark, sf))


def offset_creatinine(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.offset_creatinine(fixtures.lab(spark, sf), fixtures.patients_raw(spark, sf))


def offset_urine(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.offset_urine(fixtures.intake(spark, sf), fixtures.patients_raw(spark, sf))


def offset_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return settle(
        cohort.offset_hourly(offset_creatinine(spark, sf), offset_urine(spark, sf)), "offset-hourly"
    )


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    return series.training_rows(offset_hourly(spark, sf), "patientunitstayid")


def training_set(spark: SparkSession, sf: str) -> DataFrame:
    """The training projection with a single row key, written."""
    projected = series.training_projection(training_rows(spark, sf))
    key = F.concat_ws("|", F.col("patientunitstayid").cast("string"), F.date_format("hour_bucket", "yyyyMMddHH"))
    return settle(projected.withColumn("row_key", key), "training-set")


def training_people(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows with generalized demographics."""
    from tidewatch.operators.joins import demographics_left_join

    people = demographics_left_join(
        training_rows(spark, sf).drop("age", "gender"),
        fixtures.patients_raw(spark, sf),
        ["age", "gender", "ethnicity", "unittype"],
        distinct=True,
    )
    return privacy.generalize(people)


def scored_people(spark: SparkSession, sf: str) -> DataFrame:
    """Scores with demographics and a 0/1 prediction."""
    people = fixtures.patients_raw(spark, sf).select("patientunitstayid", "age", "gender", "unittype")
    scored = fixtures.scores(spark, sf).join(people, F.col("user_id") == F.col("patientunitstayid"), "left")
    return privacy.generalize(scored).withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


def live(spark: SparkSession, sf: str) -> DataFrame:
    """Live events as they arrive, copies included, with a parsed time."""
    return fixtures.live_events(spark, sf).withColumn("event_time", staging.ntz("charttime"))


def live_unique(spark: SparkSession, sf: str) -> DataFrame:
    return sketches.event_dedup(live(spark, sf))
