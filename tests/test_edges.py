"""Hand-written edge rows for rules, joins, gates, metrics and privacy."""

import math
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import config, schemas
from tidewatch.functions import rules
from tidewatch.operators import (
    evaluate, hourly, joins, live, ml, privacy, quality, series, similarity, sketches, skew, staging,
)
from tidewatch import session
from tidewatch.session import work_dir
from tidewatch.sources import files, layers
from tidewatch.streaming import operators, sinks, sources


def at(text):
    return datetime.fromisoformat(text)


def ntz(spark, rows, names, times):
    fields = []
    for n in names:
        kind = T.TimestampNTZType() if n in times else None
        sample = next((r[names.index(n)] for r in rows if r[names.index(n)] is not None), None)
        kind = kind or {str: T.StringType(), int: T.LongType(), float: T.DoubleType(), type(None): T.DoubleType()}[type(sample)]
        fields.append(T.StructField(n, kind))
    return spark.createDataFrame(rows, T.StructType(fields))


def test_interval_ends_are_closed_and_touching_stays_both_match(spark):
    stays = ntz(
        spark,
        [(1, 10, 100, at("2024-01-01 00:00:00"), at("2024-01-02 00:00:00")), (1, 10, 101, at("2024-01-02 00:00:00"), at("2024-01-03 00:00:00"))],
        ["subject_id", "hadm_id", "stay_id", "intime", "outtime"], {"intime", "outtime"},
    )
    labs = ntz(
        spark,
        [(1, 10, at(t), 1.0) for t in ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-03 00:00:01")],
        ["subject_id", "hadm_id", "charttime", "creatinine_mg_dl"], {"charttime"},
    )
    found = joins.window_join_labs(stays, labs)
    assert sorted((r["stay_id"], r["charttime"].day) for r in found.collect()) == [(100, 1), (100, 2), (101, 2), (101, 3)]
    report = joins.join_diagnostics(labs, stays, ["subject_id", "hadm_id"], "x").first()
    assert (report["rows_in"], report["matched"], report["unmatched"]) == (4, 3, 1)


def stage_of(spark, **values):
    names = ["creatinine", "creatinine_ratio", "creatinine_delta_48h", "urine_ml_per_kg_hr_6h", "urine_ml_per_kg_hr_12h", "urine_ml_per_kg_hr_24h"]
    df = spark.createDataFrame([[values.get(n) for n in names]], ", ".join(f"{n} double" for n in names))
    return df.select(rules.kdigo_full()).first()[0]


@pytest.mark.parametrize(
    "values, stage",
    [
        ({}, 0),
        ({"creatinine_ratio": 3.0}, 3),
        ({"creatinine": 4.0}, 3),
        ({"urine_ml_per_kg_hr_24h": 0.29}, 3),
        ({"urine_ml_per_kg_hr_24h": 0.3}, 0),
        ({"creatinine_ratio": 2.0}, 2),
        ({"urine_ml_per_kg_hr_12h": 0.49}, 2),
        ({"creatinine_delta_48h": 0.3}, 1),
        ({"creatinine_ratio": 1.5}, 1),
        ({"urine_ml_per_kg_hr_6h": 0.49}, 1),
    ],
)
def test_full_rules(spark, values, stage):
    assert stage_of(spark, **values) == stage


def test_zero_and_missing_baseline(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (5.0, 5.0)], "creatinine_mg_dl double, baseline_creatinine double")
    assert [r[0] for r in df.select(rules.kdigo_creatinine()).collect()] == [0, 0, 3]


def test_age_bands(spark):
    df = spark.createDataFrame([(a,) for a in (0, 1, 18, 19, 80, 81, 120, 121, None)], "age int")
    bands = [r[0] for r in df.select(rules.age_band()).collect()]
    assert bands == [None, "<18", "<18", "18-30", "70-80", "80+", "80+", None, None]


def test_hour_boundaries(spark):
    df = spark.createDataFrame([("2024-01-01 00:50:00", "2024-01-01 01:10:00")], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b")
    )
    row = df.select(series.hours_boundary("a", "b").alias("n"), series.hours_fraction("a", "b").alias("x")).first()
    assert row["n"] == 1 and row["x"] == pytest.approx(1 / 3)


def test_hourly_last_skips_nulls_and_null_keys(spark):
    t = at("2024-01-01 00:10:00")
    df = ntz(
        spark, [(1, t, 1, 1.0), (1, t, 2, 2.0), (1, at("2024-01-01 00:20:00"), 3, None), (None, t, 4, 9.0)],
        ["k", "event_time", "n", "v"], {"event_time"},
    )
    assert [(r["k"], r["v"]) for r in hourly.hourly_last(df, ["k"], "v", "n").collect()] == [(1, 2.0)]


def test_first_row_is_never_seen_by_the_trailing_target(spark):
    rows = [(1, at(f"2024-01-01 0{h}:00:00"), s) for h, s in enumerate([3, 0, 0, 0])]
    df = ntz(spark, rows, ["k", "hour_bucket", "kdigo_stage"], {"hour_bucket"})
    out = series.progression_target(layers.settle(df, "t"), "k").orderBy("hour_bucket").collect()
    assert [r[config.TARGET] for r in out] == [0, 0, 0, 0]
    late = ntz(spark, [(1, at(f"2024-01-01 0{h}:00:00"), s) for h, s in enumerate([0, 0, 3, 0])], ["k", "hour_bucket", "kdigo_stage"], {"hour_bucket"})
    trailing = series.progression_target(layers.settle(late, "t"), "k").orderBy("hour_bucket").collect()
    forward = series.progression_target_forward(late, "k").orderBy("hour_bucket").collect()
    assert [r[config.TARGET] for r in trailing] == [0, 1, 0, 1]
    assert [r[config.TARGET] for r in forward] == [1, 1, 0, 0]


def test_more_than_48_rows_in_small_chunks(spark):
    hours = spark.range(200).select(
        F.lit(1).alias("k"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("hour_bucket"),
        (1 + F.col("id") * 0.01).alias("creatinine"),
        F.col("id").cast("double").alias("urine_output_ml"),
    )
    hours = layers.settle(hours, "h")
    big = series.training_rows(hours, "k").orderBy("hour_bucket").collect()
    small = series.training_rows(hours, "k", size=100).orderBy("hour_bucket").collect()
    assert big == small
    assert big[47]["creatinine_delta_48h"] is None
    assert big[48]["creatinine_delta_48h"] == pytest.approx(0.48)


def test_ragged_csv_rows_are_kept(spark):
    path = work_dir(spark, "ragged")
    lines = [("a,b,c",), ('1,"x,y",3',), ("1,2",), ("1,2,3,4",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)
    rows = files.raw_csv_load(spark, path, schemas.strings("a", "b", "c")).collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [("1", "x,y", "3"), ("1", "2", None), ("1", "2", "3")]
    assert [r[files.CORRUPT] is not None for r in rows] == [False, True, True]


def test_missing_inputs_are_all_named(spark):
    with pytest.raises(FileNotFoundError, match="a: /nowhere/a; b: /nowhere/b"):
        files.required_inputs(spark, {"a": "/nowhere/a", "b": "/nowhere/b"})


def test_quarantine_reasons_and_totals(spark):
    labs = spark.createDataFrame(
        [
            ("1", "10", "50912", "2024-01-01", "1.0", "mg/dL"),
            ("1", None, "50912", "2024-01-01", None, "mg/dL"),
            ("1", " ", "50912", "2024-01-01", "1.0", "mg/dL"),
            ("1", "10", "50912", "2024-01-01", "25.0", "mg/dL"),
            ("1", "10", "50912", "2024-01-01", "25.0", "umol/L"),
            ("1", "10", "50971", "2024-01-01", None, None),
        ],
        "subject_id string, hadm_id string, itemid string, charttime string, valuenum string, valueuom string",
    )
    rule = quality.standard_rules()["labevents"]
    passed, failed = quality.quarantine_split(labs, rule)
    assert passed.count() + failed.count() == labs.count()
    assert sorted(r["failure_reason"] for r in failed.collect()) == [
        "missing_required:hadm_id", "missing_required:hadm_id,valuenum", "out_of_range:creatinine_mg/dL",
    ]
    report = quality.gate_report(labs, rule, "labs").first()
    assert (report["processed"], report["passed"], report["failed"], report["passed_pct"]) == (6, 3, 3, 50.0)


def test_metrics_on_edges(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.5), (1, 1.0), (0, 0.5)], "label int, prob double")
    m = evaluate.ranking_metrics(df, "label", "prob").first()
    assert m["auroc"] == 0.875 and m["auprc"] == pytest.approx(1 / 2 + 1 / 2 * 2 / 3, abs=1e-6)
    # 0 is in no bin; 0.5 twice with observed 0.5; 1.0 right.
    assert evaluate.ece(df, "label", "prob").first()["ece"] == 0.0
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, prob double")
    assert evaluate.ranking_metrics(one, "label", "prob").first()["auroc"] is None
    c = evaluate.classification_metrics(one, "label", evaluate.at_threshold("prob", 0.95)).first()
    assert (c["precision"], c["recall"], c["f1"], c["accuracy"]) == (0.0, 0.0, 0.0, 0.0)
    curve = evaluate.roc_curve(df, "label", "prob").orderBy(F.col("threshold").desc()).collect()
    assert math.isinf(curve[0]["threshold"]) and (curve[-1]["fpr"], curve[-1]["tpr"]) == (1.0, 1.0)


def test_auroc_is_unchanged_by_monotone_maps(spark):
    df = spark.range(500).select((F.col("id") * 37 % 11 % 2).cast("int").alias("label"), ((F.col("id") * 7919) % 101 / 101).alias("prob"))
    a = evaluate.ranking_metrics(df, "label", "prob").first()
    b = evaluate.ranking_metrics(df.withColumn("prob", F.exp("prob") / 10), "label", "prob").first()
    assert a == b


def test_k_anonymity_edges(spark):
    rows = [("a", "F", "U")] * 5 + [("b", "F", "U")] * 4 + [(None, "F", "U")] * 9
    df = spark.createDataFrame(rows, "age_group string, gender string, unittype string")
    kept = privacy.k_anonymize(df, 5)
    assert kept.count() == 5 and kept.filter("age_group is null").count() == 0
    report = privacy.suppression_report(df, 5).first()
    assert (report["total_rows"], report["kept_rows"], report["suppressed_rows"]) == (18, 5, 13)


def test_private_means(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", None), ("A", 3.0), (None, 9.0)], "unittype string, creatinine double")
    exact = privacy.dp_group_mean(df, epsilon=0, seed=1).collect()
    assert [(r["unittype"], r["patient_count"], r["dp_mean"]) for r in exact] == [("A", 3, 2.0)]
    noisy = privacy.dp_noise_report(df, epsilon=0.5, seed=1).first()
    assert noisy["noise_added"] == pytest.approx(noisy["dp_mean"] - noisy["actual_mean"], abs=2e-6)
    assert "actual_mean" not in privacy.dp_group_mean(df, seed=1).columns


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(500).select(F.col("id").cast("string").alias("key"))
    bloom = sketches.bloom_build(keys, "key", 1024, 3)
    assert sketches.bloom_membership(keys, bloom, "key", 1024, 3).filter("not maybe_seen").count() == 0
    assert bloom.count() <= 1024 // sketches.WORD_BITS + 1


def test_samples_merge(spark):
    from tidewatch.streaming.operators import merge_sample

    rows = spark.range(1000)
    whole = {r["id"] for r in sketches.reservoir_sample(rows, 50, "id").collect()}
    first = sketches.reservoir_sample(rows.filter("id < 400"), 50, "id")
    assert whole == {r["id"] for r in merge_sample(first, rows.filter("id >= 400"), 50, "id").collect()}


def test_hashed_twins_are_among_the_exact(spark):
    names = ["x", "y", "w"]
    df = spark.range(400).select(
        F.col("id").cast("string").alias("row"), *[((F.col("id") * p) % 401).cast("double").alias(n) for n, p in zip(names, (31, 57, 83))]
    )
    asked = df.filter(F.col("row").isin("3", "200"))
    exact = {(r["query_id"], r["row"]): r["distance"] for r in similarity.exact_similar(asked, df, "row", names, k=400).collect()}
    found = similarity.lsh_similar(asked, df, "row", names, k=5, n_tables=3, n_bits=4).collect()
    assert all(exact[(r["query_id"], r["row"])] == r["distance"] for r in found)
    assert {(r["query_id"], r["row"]) for r in found if r["rank"] == 1 and r["distance"] == 0.0} >= {("3", "3"), ("200", "200")}


def test_schema_coverage_and_columns(spark):
    df = spark.createDataFrame([(1, 2)], "subject_id int, hadm_id int")
    row = files.schema_coverage({"admissions": df}).first()
    assert row["missing_columns"] == "admittime,dischtime" and not row["complete"]
    assert staging.keep_existing(df, ["hadm_id", "nope"]).columns == ["hadm_id"]


def test_imputation_keeps_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (float("nan"), None)], "a double, b double")
    filled = ml.median_impute(df, ml.fit_medians(df, ["a", "b"]))
    assert sorted(r["a"] for r in filled.collect()) == [1.0, 2.0, 2.0, 3.0]
    assert filled.columns == ["a", "b"] and filled.filter("b is not null").count() == 0


def test_scoring_returns_every_row(spark, tmp_path):
    rows = [(i, float(i % 7) if i % 3 else None, float(i % 5), None, float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, label double")
    model = ml.fit_logistic(df, ["a", "b", "c"], "label")
    ml.model_save(model, str(tmp_path / "model"))
    scored = ml.score_batch(ml.model_load(str(tmp_path / "model")), df)
    assert scored.columns == [*df.columns, "prob"]
    assert scored.filter("prob between 0 and 1").count() == 60


def test_a_fitted_model_scores_after_metrics_were_observed(spark, tmp_path):
    rows = [(i, float(i % 7), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, label double")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "rows"))
    assert seen.get == {"n": 60}
    model = ml.fit_logistic(df, ["a"], "label")
    scored = {r["id"]: r["prob"] for r in ml.score_batch(model, df).collect()}
    stream = operators.stream_score(model, sources.table_stream_source(spark, str(tmp_path / "rows"), df.schema))
    assert {r["id"]: r["prob"] for r in sinks.drain(stream, "scored").collect()} == scored
    assert len(scored) == 60 and all(0 <= p <= 1 for p in scored.values())


def test_quoted_fields(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('a,b,c\n1,"say ""hi"", now",x\n2,"two\nlines",y\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    got = [tuple(r)[:3] for r in files.raw_csv_load(spark, str(path), schema, multi_line=True).orderBy("a").collect()]
    assert got == [("1", 'say "hi", now', "x"), ("2", "two\nlines", "y")]
    typed = files.typed_csv_load(spark, str(path), schema, multi_line=True).orderBy("a").collect()
    assert [tuple(r) for r in typed] == got


def test_null_keys_are_one_series_over_blocks(spark):
    rows = [(None, i, float(10 - i)) for i in range(10)] + [(1, i, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k long, t long, v double")
    seen = skew.running(df, ["k"], ["t"], F.floor(F.col("t") / 5), {"m": ("max", "v")})
    assert {r["m"] for r in seen.filter("k is null").collect()} == {10.0}


def test_null_live_values(spark):
    rows = [(1, "2024-01-01 00:00:00", "creatinine", None, 0), (1, "2024-01-01 01:00:00", "creatinine", 2.0, 1),
            (2, "2024-01-01 00:00:00", "urine", None, 2), (2, "2024-01-01 01:00:00", "urine", float("nan"), 3)]
    events = spark.createDataFrame(rows, "subject_id long, charttime string, event_type string, value double, arrival long")
    state = live.live_state(events.withColumn("event_time", F.col("charttime").cast("timestamp_ntz")))
    got = {r["arrival"]: (r["creatinine"], r["baseline"], r["cr_ratio"], r["uo_ml_kg_hr_6h"]) for r in state.collect()}
    assert got == {0: (0.0, 0.0, None, None), 1: (2.0, 1.0, 2.0, None), 2: (None, None, None, 0.0), 3: (None, None, None, 0.0)}


def test_working_folders_can_be_removed(spark):
    kept = session._made[:]
    session._made.clear()
    path = work_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.remove_work(spark) == 1 and session._made == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    session._made.extend(kept)


def test_cluster_needs_a_shared_folder(spark):
    class Fake:
        class conf:  # noqa: N801
            @staticmethod
            def get(*_):
                return None

        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Fake, "x")


def test_correlation_of_a_constant_column_is_not_a_number(spark):
    from tidewatch.operators import evaluate

    rows = [(1.0, 5.0, 2.0), (2.0, 5.0, 4.5), (3.0, 5.0, None)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    got = {(r["a"], r["b"]): r["corr"] for r in evaluate.correlation_matrix(df, ["x", "y", "z"]).collect()}
    assert math.isnan(got["x", "y"]) and got["x", "z"] == 1.0
    assert {r["corr"] for r in evaluate.correlation_matrix(df.filter("x > 9"), ["x", "y"]).collect()} == {None}


def test_numbers_are_shown_from_their_binary_value(spark):
    from tidewatch.functions.numeric import plain_number

    shown = {1.005: "1.00", 0.125: "0.12", 0.375: "0.38", 2.675: "2.67", -0.001: "-0.00", 12345.678: "12345.68", 1.0: "1.00"}
    df = spark.createDataFrame([(v,) for v in shown], "v double").select("v", plain_number(F.col("v")).alias("text"))
    assert {r["v"]: r["text"] for r in df.collect()} == shown == {v: "%.2f" % v for v in shown}


def test_exact_mean_does_not_follow_the_order_of_rows(spark):
    from tidewatch.functions.numeric import exact_mean

    # 99.833 / 80 is exactly between two millionths.
    values = [0.1] * 40 + [2.395825] * 40
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for order in (df, df.orderBy("v").repartition(7), df.orderBy(F.desc("v")).coalesce(1)):
        assert order.agg(exact_mean(F.col("v"))).first()[0] == 1.247913
    assert df.filter("v is null").agg(exact_mean(F.col("v"))).first()[0] is None
    assert spark.createDataFrame([(-1.5,), (-0.5,)], "v double").agg(exact_mean(F.col("v"), 0)).first()[0] == -1.0


def test_a_person_moves_the_mean_by_the_sensitivity_at_most(spark):
    rows = [("g", p, i, 5.0 if p == 0 else 0.5 + (p * 7 + i) % 10 * 0.1) for p in range(8) for i in range(40 if p == 0 else 4)]
    rows += [("g", 3, 100, None), (None, 1, 101, 2.0), ("g", None, 102, 2.0), ("tiny", 9, 103, 99.0)]
    df = spark.createDataFrame(rows, "unit string, person int, n int, value double")
    options = {"group": "unit", "value": "value", "person": "person", "row_key": ["person", "n"], "most": 3, "seed": "s"}

    def means(some):
        # So little noise that the mean itself is seen.
        return {r["unit"]: r for r in privacy.dp_person_mean(some, epsilon=1e9, **options).collect()}

    whole = means(df)
    assert whole["g"]["bounded_rows"] == 8 * 3 and whole["tiny"]["sensitivity"] == 4.5 and abs(whole["tiny"]["dp_mean"] - 5.0) < 1e-5
    for p in range(8):
        without = means(df.filter(F.coalesce(F.col("person") != p, F.lit(True))))
        assert abs(without["g"]["dp_mean"] - whole["g"]["dp_mean"]) <= whole["g"]["sensitivity"] + 1e-5
    with pytest.raises(ValueError):
        privacy.dp_person_mean(df, epsilon=0, **options)


def test_ledger_of_spent_budget(spark):
    ledger = work_dir(spark, "ledger")
    assert privacy.spent(spark, ledger).count() == 0
    assert privacy.spend(spark, ledger, "first", 0.5, 1.0) == 0.5
    assert privacy.spend(spark, ledger, "first", 0.5, 1.0) == 0.5
    with pytest.raises(ValueError):
        privacy.spend(spark, ledger, "first", 0.4, 1.0)
    with pytest.raises(privacy.BudgetSpent):
        privacy.spend(spark, ledger, "second", 0.6, 1.0)
    assert privacy.spend(spark, ledger, "third", 0.5, 1.0) == 0.0
    assert {r["release"]: r["epsilon"] for r in privacy.spent(spark, ledger).collect()} == {"first": 0.5, "third": 0.5}


def test_a_write_is_judged_in_one_pass(spark):
    rows = [(1.0, 5.0, 1, 1), (99.0, 5.0, 2, 2), (1.0, -5.0, 3, 3), (1.0, 5.0, None, 4)]
    df = layers.settle(spark.createDataFrame(rows, "creatinine double, urine_output_ml double, subject_id int, n int"), "judged")

    def verdicts(some):
        path = work_dir(spark, "gated")
        got = {r["check"]: r["passed"] for r in quality.gated_write(some, "t", path).collect()}
        assert got == {r["check"]: r["passed"] for r in quality.quality_gate_checks(some, "t").collect()}
        assert spark.read.parquet(path).count() == some.count()
        return got

    assert verdicts(df) == {"creatinine_range_valid": False, "urine_non_negative": False, "no_missing_patient_ids": False}
    assert all(verdicts(df.filter("n = 1")).values()) and all(verdicts(df.filter("n > 9")).values())
    assert quality.gated_write(df.select("n"), "t", work_dir(spark, "gated")).count() == 0


def test_a_stream_is_judged_over_its_micro_batches(spark):
    from tidewatch.streaming import sinks, sources

    path = work_dir(spark, "judged")
    schema = "creatinine double, subject_id int"
    for row in [(1.0, 1), (0.1, 2), (1.0, 3)]:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = quality.observed_gate(sources.table_stream_source(spark, f"{path}/in", spark.createDataFrame([], schema).schema, max_files=1))
    run = sinks.append_files(stream, f"{path}/out", f"{path}/checkpoint", available_now=True)
    run.awaitTermination()
    got = {r["check"]: r["passed"] for r in quality.stream_verdicts(run, "t").collect()}
    assert got == {"creatinine_range_valid": False, "no_missing_patient_ids": True}
    assert len(run.recentProgress) >= 3


def test_both_models_are_prepared_once(spark, monkeypatch):
    df = spark.range(400).select(
        (F.col("id") % 2).cast("double").alias("label"), ((F.col("id") * 7) % 13).cast("double").alias("a"),
        F.when(F.col("id") % 5 != 0, (F.col("id") * 3) % 11 + F.col("id") % 2 * 4).cast("double").alias("b"),
    )
    alone = ml.fit_logistic(df, ["a", "b"], "label"), ml.fit_gbt(df, ["a", "b"], "label")
    fitted, fit = [], ml.fit_medians
    monkeypatch.setattr(ml, "fit_medians", lambda *a: fitted.append(1) or fit(*a))
    both = ml.train_pipelines(df, ["a", "b"], "label")
    assert len(fitted) == 1
    assert both["LogisticRegression"].stages[-1].coefficients == alone[0].stages[-1].coefficients
    assert both["GBTClassifier"].stages[-1].toDebugString.split("\n")[1:] == alone[1].stages[-1].toDebugString.split("\n")[1:]
