"""Quality gate: quarantine, checks, column tests, profiles and summaries.

Every report is one aggregate pass that combines before it shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch import config


def blank(column: str) -> Column:
    """A raw string that carries nothing."""
    return F.col(column).isNull() | (F.trim(F.col(column)) == "")


@dataclass(frozen=True)
class GateRules:
    """What one table must satisfy. Checks apply in order: keys, time order, ranges."""

    required: Sequence[str]
    required_if: Mapping[str, Column] = field(default_factory=dict)
    time_order: tuple[str, str] | None = None
    ranges: Sequence[tuple[str, Column]] = ()


def standard_rules() -> dict[str, GateRules]:
    """The gate's rules for the raw extracts; values and units matter on allowlisted rows only."""
    creatinine_row = F.col("itemid").isin([str(i) for i in config.CREATININE_ITEMS])
    urine_row = F.col("itemid").isin([str(i) for i in config.URINE_ITEMS])
    level = F.col("valuenum").try_cast("double")
    volume = F.col("value").try_cast("double")
    return {
        "patients": GateRules(config.REQUIRED_COLUMNS["patients"]),
        "admissions": GateRules(
            config.REQUIRED_COLUMNS["admissions"], time_order=("admittime", "dischtime")
        ),
        "icustays": GateRules(config.REQUIRED_COLUMNS["icustays"], time_order=("intime", "outtime")),
        "labevents": GateRules(
            config.REQUIRED_COLUMNS["labevents"],
            required_if={"valuenum": creatinine_row, "valueuom": creatinine_row},
            ranges=[
                (
                    "out_of_range:creatinine_mg/dL",
                    creatinine_row
                    & (F.col("valueuom") == config.CREATININE_UNIT)
                    & ~level.between(*config.CREATININE_BOUNDS),
                )
            ],
        ),
        "d_labitems": GateRules(config.REQUIRED_COLUMNS["d_labitems"]),
        "outputevents": GateRules(
            config.REQUIRED_COLUMNS["outputevents"],
            required_if={"value": urine_row, "valueuom": urine_row},
            ranges=[
                ("out_of_range:urine_negative", urine_row & (volume < config.URINE_BOUNDS[0])),
                ("out_of_range:urine_too_large", urine_row & (volume > config.URINE_BOUNDS[1])),
            ],
        ),
        "d_items": GateRules(config.REQUIRED_COLUMNS["d_items"]),
    }


def failure_reason(rules: GateRules) -> Column:
    """One reason per row, or null: the first rule it breaks, in rule order."""
    absent = [
        F.when(blank(c) & F.coalesce(rules.required_if.get(c, F.lit(True)), F.lit(False)), c)
        for c in rules.required
    ]
    missing = F.array_compact(F.array(*absent))
    reason = F.when(
        F.size(missing) > 0, F.concat(F.lit("missing_required:"), F.array_join(missing, ","))
    )
    if rules.time_order:
        start, end = rules.time_order
        late = F.col(start).try_cast("timestamp_ntz") >= F.col(end).try_cast("timestamp_ntz")
        reason = reason.when(late, f"bad_time_order:{start}>={end}")
    for name, broken in rules.ranges:
        reason = reason.when(broken, name)
    return reason


def tag_rows(raw: DataFrame, rules: GateRules) -> DataFrame:
    return raw.withColumn("failure_reason", failure_reason(rules))


def quarantine_split(raw: DataFrame, rules: GateRules) -> tuple[DataFrame, DataFrame]:
    """(passed rows, failed rows with their reason)."""
    tagged = tag_rows(raw, rules)
    passed = tagged.filter(F.col("failure_reason").isNull()).drop("failure_reason")
    return passed, tagged.filter(F.col("failure_reason").isNotNull())


def gate_report(raw: DataFrame, rules: GateRules, table: str) -> DataFrame:
    """Processed, passed and failed rows and the passed share, for the table and per reason."""
    reasons = tag_rows(raw, rules).groupBy("failure_reason").agg(F.count(F.lit(1)).alias("n"))
    # One row per reason from here on; a table has a handful of them.
    n = F.col("n")
    failed = F.col("failure_reason").isNotNull()
    return reasons.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("processed"),
        F.coalesce(F.sum(F.when(~failed, n)), F.lit(0)).alias("passed"),
        F.coalesce(F.sum(F.when(failed, n)), F.lit(0)).alias("failed"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.when(failed, F.struct("failure_reason", "n")))),
                lambda r: F.concat(r["failure_reason"], F.lit("="), r["n"].cast("string")),
            ),
            ";",
        ).alias("reasons"),
    ).select(
        F.lit(table).alias("table_name"),
        "processed",
        "passed",
        "failed",
        F.round(F.try_divide(F.col("passed") * 100.0, F.col("processed")), 2).alias("passed_pct"),
        "reasons",
    )


def gate_checks(df: DataFrame) -> dict[str, Column]:
    """Whether all rows pass, per check. A check is there only if its column is; a null fails a range."""
    checks: list[tuple[str, Column]] = []
    if "creatinine" in df.columns:
        checks.append(
            ("creatinine_range_valid", F.col("creatinine").between(*config.CLEAN_CREATININE_BOUNDS))
        )
    if "urine_output_ml" in df.columns:
        checks.append(("urine_non_negative", F.col("urine_output_ml") >= 0))
    id_column = "patientunitstayid" if "patientunitstayid" in df.columns else "subject_id"
    if id_column in df.columns:
        checks.append(("no_missing_patient_ids", F.col(id_column).isNotNull()))
    if "hour_bucket" in df.columns:
        time = F.col("hour_bucket")
        checks.append(("valid_timestamps", time.isNull() | time.try_cast("timestamp_ntz").isNotNull()))
    return {name: F.coalesce(F.bool_and(F.coalesce(ok, F.lit(False))), F.lit(True)).alias(name) for name, ok in checks}


def quality_gate_checks(df: DataFrame, dataset: str) -> DataFrame:
    """(dataset, check, passed), by an aggregate of its own."""
    checks = gate_checks(df)
    return df.agg(*checks.values()).unpivot([], list(checks), "check", "passed").select(
        F.lit(dataset).alias("dataset"), "check", "passed"
    )


def _verdicts(spark: SparkSession, dataset: str, passed: Mapping[str, bool]) -> DataFrame:
    rows = [(dataset, name, bool(ok)) for name, ok in passed.items()]
    return spark.createDataFrame(rows, "dataset string, check string, passed boolean")


def gated_write(df: DataFrame, dataset: str, path: str) -> DataFrame:
    """Write a table and judge it in the same pass: (dataset, check, passed) as `quality_gate_checks` has them.

    The checks are observed while the rows go to their files, so a gate costs no second scan. A task that runs
    again counts once. Without any column to check there are no verdicts.
    """
    checks = gate_checks(df)
    if not checks:
        df.write.mode("overwrite").parquet(path)
        return _verdicts(df.sparkSession, dataset, {})
    seen = Observation()
    df.observe(seen, *checks.values()).write.mode("overwrite").parquet(path)
    return _verdicts(df.sparkSession, dataset, seen.get)


GATE = "gate"


def observed_gate(stream: DataFrame) -> DataFrame:
    """A stream whose micro-batches report the checks in their progress, see `stream_verdicts`."""
    return stream.observe(GATE, *gate_checks(stream).values())


def stream_verdicts(query: StreamingQuery, dataset: str) -> DataFrame:
    """(dataset, check, passed) over the micro-batches that a query still remembers: passed if all of them did."""
    passed: dict[str, bool] = {}
    for progress in query.recentProgress:
        for name, ok in (progress.observedMetrics.get(GATE) or Row()).asDict().items():
            passed[name] = passed.get(name, True) and ok
    return _verdicts(SparkSession.active(), dataset, passed)


def validation_summary(df: DataFrame, dataset: str, id_column: str) -> DataFrame:
    """One row: sizes, ids, invalid values, duplicate (id, hour) rows and a column per stage."""
    def n(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    key = F.struct(id_column, "hour_bucket")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(id_column).alias("unique_ids"),
        n(F.col(id_column).isNull()).alias("missing_id_rows"),
        n(~F.coalesce(F.col("kdigo_stage").isin(0, 1, 2, 3), F.lit(False))).alias("invalid_kdigo_rows"),
        n(F.col("urine_output_ml") < 0).alias("negative_urine_rows"),
        n(F.col("creatinine") < config.CLEAN_CREATININE_BOUNDS[0]).alias("low_creatinine_rows"),
        (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_patient_hour_rows"),
        *[n(F.col("kdigo_stage") == s).alias(f"stage_{s}_rows") for s in range(4)],
    ).select(F.lit(dataset).alias("dataset"), "*")


def stage_distribution(df: DataFrame, stage: str = "kdigo_stage") -> DataFrame:
    return df.groupBy(stage).agg(F.count(F.lit(1)).alias("row_count"))


def plausibility_stats(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean per measure, in one pass."""
    stats = df.agg(
        *[
            F.struct(
                F.min(m).alias("min_value"), F.max(m).alias("max_value"), F.round(F.avg(m), 6).alias("avg_value")
            ).alias(m)
            for m in measures
        ]
    )
    return stats.unpivot([], list(measures), "measure", "s").select("measure", "s.*")


def readiness_profile(
    raw: DataFrame, items: Sequence[int], keys: Sequence[str], distinct_key: str, unit: str | None = None
) -> DataFrame:
    """Rows of allowlisted items, blanks per key column, units, distinct keys."""
    rows = raw.filter(F.col("itemid").isin([str(i) for i in items]))
    tidy_unit = F.trim(F.coalesce("valueuom", F.lit("")))
    if unit:
        rows = rows.filter(tidy_unit == unit)
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.coalesce(F.col(k) == "", F.lit(True))).alias(f"{k}_nulls") for k in keys],
        F.count_distinct(tidy_unit).alias("units"),
        F.count_distinct(F.when(F.col(distinct_key) != "", F.col(distinct_key))).alias("distinct_keys"),
    )


def dictionary_discovery(
    dictionary: DataFrame, word: str, columns: Sequence[str] = ("label",)
) -> DataFrame:
    """How many dictionary items name a word."""
    named = F.lit(False)
    for c in columns:
        named = named | F.coalesce(F.lower(c).contains(word.lower()), F.lit(False))
    return dictionary.filter(named).agg(F.count_distinct("itemid").alias("items")).select(
        F.lit(word).alias("word"), "items"
    )


def unit_distribution(df: DataFrame, item: str = "itemid", unit: str = "valueuom", value: str = "valuenum") -> DataFrame:
    return df.groupBy(item, unit).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(value).isNull()).alias("missing_values")
    )


def missing_ratio_gate(
    df: DataFrame, keys: Sequence[str], limit: float = config.MAX_MISSING_KEY_RATIO
) -> DataFrame:
    """Per key column, its share of nulls and whether that is within the limit."""
    shares = df.agg(*[F.avg(F.col(k).isNull().cast("double")).alias(k) for k in keys])
    return shares.unpivot([], list(keys), "key_column", "ratio").select(
        "key_column",
        F.round("ratio", 6).alias("missing_ratio"),
        (F.col("ratio") <= limit).alias("passed"),
    )


def not_null_test(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures").select(
        "column_name", F.lit("not_null").alias("test"), "failures"
    )


def unique_test(df: DataFrame, column: str) -> DataFrame:
    """How many values occur more than once."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return repeated.filter(F.col("n") > 1).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failures"
    )


def output_gate(
    df: DataFrame, keys: Sequence[str], time: str, score: str, stage: str, arrival: str
) -> DataFrame:
    """Violations per output rule: score range, keys, stage, and time running backwards per key.

    Backwards rows are found against the running latest time in arrival order, in two levels.
    """
    from tidewatch.operators.skew import running

    seen = running(
        df,
        [keys[0]],
        [arrival],
        F.floor(F.col(arrival) / 100000),
        {"_latest": ("max", time)},
    )
    def n(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    rules = {
        "score_in_range": n(~F.col(score).between(0, 1) | F.col(score).isNull()),
        "keys_not_null": n(any_null),
        "stage_valid": n(~F.coalesce(F.col(stage).isin(0, 1, 2, 3), F.lit(False))),
        "time_in_order": n(F.col(time) < F.col("_latest")),
    }
    return seen.agg(*[c.alias(k) for k, c in rules.items()]).unpivot([], list(rules), "rule", "violations")


def metric_rollup(log: DataFrame) -> DataFrame:
    return log.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("metric_value"), 2).alias("avg_value")
    )
