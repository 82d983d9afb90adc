"""The layered models: staging to silver to gold to mart."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import rules
from tidewatch.operators import hourly, joins, series, staging
from tidewatch.sources.layers import settle


def gold_features(stages: DataFrame, cohort: DataFrame) -> DataFrame:
    """Hourly stages with the worst stage so far and the hour boundaries since admission.

    `stages` is read twice and should be a written table.
    """
    joined = joins.cohort_left_join(series.running_max_rows(stages), cohort)
    return joined.select(
        "subject_id",
        "hadm_id",
        "stay_id",
        "charttime",
        "creatinine_mg_dl",
        "urine_ml",
        "kdigo_stage",
        "rolling_max_kdigo",
        series.hours_boundary("intime", "charttime").alias("hours_since_admit"),
    )


def features_for_training(stages: DataFrame, cohort: DataFrame) -> DataFrame:
    """The batch feature table: shared values at equal times, fractional hours, nulls as 0."""
    joined = joins.cohort_left_join(series.running_max_range(stages), cohort, ["intime", "los"])
    return staging.fill_defaults(
        joined.withColumn("hours_since_admit", series.hours_fraction("intime", "charttime")),
        {"creatinine_mg_dl": 0.0, "urine_ml": 0.0, "hours_since_admit": 0.0},
    )


def training_mart(features: DataFrame) -> DataFrame:
    """Hours with both measures, labelled by the worst stage so far."""
    return features.filter(F.col("creatinine_mg_dl").isNotNull() & F.col("urine_ml").isNotNull()).select(
        "subject_id", "hadm_id", "stay_id", "charttime", "creatinine_mg_dl", "urine_ml",
        "hours_since_admit", "kdigo_stage", "rolling_max_kdigo",
        rules.stage_label().alias("label_stage3_progression"),
    )


@dataclass(frozen=True)
class Warehouse:
    """All models over three raw tables. Models are lazy; only the hourly stages, which later
    models read more than once, are written."""

    labs_raw: DataFrame
    outputs_raw: DataFrame
    stays_raw: DataFrame

    @cached_property
    def labs(self) -> DataFrame:
        return staging.stage_labs(self.labs_raw)

    @cached_property
    def outputs(self) -> DataFrame:
        return staging.stage_outputs(self.outputs_raw)

    @cached_property
    def cohort(self) -> DataFrame:
        return staging.icu_cohort(staging.stage_stays(self.stays_raw))

    @cached_property
    def creatinine(self) -> DataFrame:
        return joins.window_join_labs(self.cohort, self.labs)

    @cached_property
    def urine(self) -> DataFrame:
        return joins.window_join_outputs(self.cohort, self.outputs)

    @cached_property
    def events(self) -> DataFrame:
        return joins.kdigo_events(self.creatinine, self.urine)

    @cached_property
    def stages(self) -> DataFrame:
        return hourly.hourly_stages(self.creatinine, self.urine)

    @cached_property
    def written_stages(self) -> DataFrame:
        return settle(self.stages, "gold-kdigo-hourly")

    @cached_property
    def features(self) -> DataFrame:
        return gold_features(self.written_stages, self.cohort)

    @cached_property
    def mart(self) -> DataFrame:
        return training_mart(self.features)
