"""Joins of events to stays, hours, demographics and key sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.skew import DEFAULT_SALTS, salted_join
from tidewatch.sources.layers import settle


def interval_join(
    events: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    time: str = "charttime",
    start: str = "intime",
    end: str = "outtime",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Events inside a closed interval of the same key; touching intervals both match.

    A key has few intervals and any number of events, so the events are salted and the
    intervals replicated. The time test is a residual filter on the equi join.
    """
    inside = F.col(time).between(F.col(start), F.col(end))
    return salted_join(events, intervals, on, condition=inside, salts=salts)


def window_join_labs(cohort: DataFrame, labs: DataFrame, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Labs carry no stay: they match by subject, admission and time."""
    return interval_join(
        labs.select("subject_id", "hadm_id", "charttime", "creatinine_mg_dl"),
        cohort.select("subject_id", "hadm_id", "stay_id", "intime", "outtime"),
        ["subject_id", "hadm_id"],
        salts=salts,
    ).select("subject_id", "hadm_id", "stay_id", "charttime", "creatinine_mg_dl")


def window_join_outputs(cohort: DataFrame, outputs: DataFrame, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Outputs match by stay and time; subject and admission come from the stay."""
    return interval_join(
        outputs.select("stay_id", "charttime", "urine_ml"),
        cohort.select("subject_id", "hadm_id", "stay_id", "intime", "outtime"),
        ["stay_id"],
        salts=salts,
    ).select("subject_id", "hadm_id", "stay_id", "charttime", "urine_ml")


def kdigo_events(creatinine: DataFrame, urine: DataFrame) -> DataFrame:
    """Both event kinds in one table, each with the other's measure as a typed null."""
    keys = ["subject_id", "hadm_id", "stay_id", "charttime"]
    null = F.lit(None).cast("double")
    return creatinine.select(
        *keys, "creatinine_mg_dl", null.alias("urine_ml"), F.lit("creatinine").alias("event_type")
    ).unionByName(
        urine.select(*keys, null.alias("creatinine_mg_dl"), "urine_ml", F.lit("urine").alias("event_type"))
    )


def hourly_outer_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join on the hour keys; both sides hold one row per hour and group."""
    return left.join(right, list(on), "full_outer")


def cohort_left_join(hourly: DataFrame, cohort: DataFrame, columns: Sequence[str] = ("intime",)) -> DataFrame:
    return hourly.join(cohort.select("stay_id", *columns), "stay_id", "left")


def demographics_left_join(
    df: DataFrame, patients: DataFrame, columns: Sequence[str], key: str = "patientunitstayid",
    distinct: bool = False, salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Rows with patient columns. With `distinct`, a patient with two tuples yields two rows."""
    people = patients.select(key, *[c for c in columns if c != key])
    if distinct:
        people = people.dropDuplicates()
    return salted_join(df, people, [key], how="left", salts=salts)


def qualifying_groups(df: DataFrame, group: Sequence[str], at_least: int) -> DataFrame:
    """The groups of at least so many rows; groups with a null part never qualify."""
    return (
        df.dropna(subset=list(group))
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") >= at_least)
    )


def group_semi_join(df: DataFrame, group: Sequence[str], at_least: int) -> DataFrame:
    """Rows whose group qualifies. Sizes are counted before any row moves.

    The rows are read twice, so they are written first.
    """
    df = settle(df, "group-rows")
    groups = qualifying_groups(df, group, at_least).select(*group)
    return salted_join(df, groups, list(group), how="left_semi")


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many distinct keys of `a` are in `b`, out of how many."""
    left = a.select(key).dropna().distinct()
    right = b.select(key).dropna().distinct().withColumn("_hit", F.lit(1))
    return left.join(right, key, "left").agg(
        F.count("_hit").alias("matched"), F.count(F.lit(1)).alias("total")
    )


def key_intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).dropna().intersect(b.select(key).dropna())


def referential_check(facts: DataFrame, dictionary: DataFrame, key: str = "itemid") -> DataFrame:
    """Keys of the facts that the dictionary lacks, with their row counts."""
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dictionary.select(key).distinct(), key, "left_anti")


def join_diagnostics(
    events: DataFrame, intervals: DataFrame, on: Sequence[str], step: str,
    time: str = "charttime", start: str = "intime", end: str = "outtime",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Rows in, rows that match at least one interval, rows that match none."""
    numbered = events.select(*on, time).groupBy(*on, time).agg(F.count(F.lit(1)).alias("n"))
    inside = F.col(time).between(F.col(start), F.col(end))
    hit = salted_join(
        numbered, intervals.select(*on, start, end), on, condition=inside, how="left_semi", salts=salts
    )
    matched = F.coalesce(F.sum(F.when(F.col("side") == "hit", F.col("n"))), F.lit(0))
    rows = F.coalesce(F.sum(F.when(F.col("side") == "in", F.col("n"))), F.lit(0))
    sides = numbered.select("n", F.lit("in").alias("side")).unionByName(
        hit.select("n", F.lit("hit").alias("side"))
    )
    return sides.agg(rows.alias("rows_in"), matched.alias("matched")).select(
        F.lit(step).alias("step"), "rows_in", "matched", (F.col("rows_in") - F.col("matched")).alias("unmatched")
    )
