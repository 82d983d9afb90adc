"""Severity rules, scores and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import config


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def kdigo_full(
    creatinine="creatinine",
    ratio="creatinine_ratio",
    delta_48h="creatinine_delta_48h",
    rate_6h="urine_ml_per_kg_hr_6h",
    rate_12h="urine_ml_per_kg_hr_12h",
    rate_24h="urine_ml_per_kg_hr_24h",
) -> Column:
    """Stage 0-3 from ratio, level, rise and urine rates. A null input never meets a rule."""
    ratio = _col(ratio)
    stage3 = (ratio >= 3.0) | (_col(creatinine) >= 4.0) | (_col(rate_24h) < 0.3)
    stage2 = (ratio >= 2.0) | (_col(rate_12h) < 0.5)
    stage1 = (_col(delta_48h) >= 0.3) | (ratio >= 1.5) | (_col(rate_6h) < 0.5)
    return F.when(stage3, 3).when(stage2, 2).when(stage1, 1).otherwise(0)


def kdigo_creatinine(creatinine="creatinine_mg_dl", baseline="baseline_creatinine") -> Column:
    """Stage from an hour's creatinine; without a usable baseline it is 0."""
    creatinine, baseline = _col(creatinine), _col(baseline)
    ratio = F.try_divide(creatinine, baseline)
    return (
        F.when(baseline.isNull() | (baseline == 0), 0)
        .when((ratio >= 3.0) | (creatinine >= 4.0), 3)
        .when(ratio >= 2.0, 2)
        .when(ratio >= 1.5, 1)
        .otherwise(0)
    )


def kdigo_urine(volume="urine_ml") -> Column:
    """Stage from an hour's urine volume."""
    return F.when(_col(volume) < 30, 2).when(_col(volume) < 60, 1).otherwise(0)


def kdigo_live(ratio="cr_ratio", rate="uo_ml_kg_hr_6h") -> Column:
    """Stage from the live state: the worse of the creatinine ratio and the urine rate."""
    ratio, rate = _col(ratio), _col(rate)
    by_ratio = F.when(ratio >= 3.0, 3).when(ratio >= 2.0, 2).when(ratio >= 1.5, 1).otherwise(0)
    by_rate = F.when(rate < 0.3, 3).when(rate < 0.5, 2).otherwise(0)
    return F.greatest(by_ratio, by_rate)


def anomaly_score(ratio="cr_ratio", delta="cr_delta_recent", rate="uo_ml_kg_hr_6h") -> Column:
    """A 0-100 score from ratio, recent rise and urine rate; missing parts add nothing."""
    ratio, delta, rate = _col(ratio), _col(delta), _col(rate)
    by_ratio = F.coalesce(F.least(ratio * 20, F.lit(50.0)), F.lit(0.0))
    by_rise = F.when(delta > 0.3, 15.0).when(delta > 0.1, 8.0).otherwise(0.0)
    by_rate = F.when(rate < 0.3, 30.0).when(rate < 0.5, 15.0).otherwise(0.0)
    return F.least(F.round(by_ratio + by_rise + by_rate, 1), F.lit(100.0))


def risk_band(score="anomaly_score") -> Column:
    return F.when(_col(score) >= 60, "high").when(_col(score) >= 30, "medium").otherwise("low")


def rrt_flag(text: str | Column | None, pattern: str = config.DIALYSIS_PATTERN) -> Column:
    """1 where the text names renal replacement therapy; pass None when there is no such column."""
    if text is None:
        return F.lit(0)
    return F.coalesce(_col(text).rlike(f"(?i){pattern}"), F.lit(False)).cast("int")


def age_band(age="age", edges=config.AGE_EDGES, labels=config.AGE_LABELS) -> Column:
    """Right-closed bins; outside the edges, and for a null age, the band is null."""
    age = _col(age)
    band = F.when(age <= edges[0], None)
    for upper, label in zip(edges[1:], labels):
        band = band.when(age <= upper, label)
    return band


def stage_label(stage="rolling_max_kdigo", dtype: str = "int") -> Column:
    return F.when(_col(stage) >= 3, 1).otherwise(0).cast(dtype)
