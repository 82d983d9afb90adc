"""Splits, imputation, training, scoring, registry."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators import evaluate, ml, privacy
from tidewatch.plans import bindings as b
from tidewatch.plans import fixtures
from tidewatch.plans.catalog import aggregates, projections
from tidewatch.plans.catalog.inputs import layer_database
from tidewatch.plans.oracle import VIEWS, hash32
from tidewatch.plans.registry import query
from tidewatch.session import work_dir
from tidewatch.sources import layers
from tidewatch.sources.layers import settle

SCALED = ["creatinine_mg_dl", "urine_ml", "hours_since_admit"]

VIEWS["v_split"] = f"""
SELECT *, {config.TARGET}::DOUBLE AS label,
       row_number() OVER (PARTITION BY {config.TARGET} ORDER BY ('0x' || substr(md5('42:' || row_key), 1, 13))::BIGINT, row_key)
         <= round(count(*) OVER (PARTITION BY {config.TARGET}) * 0.2) AS is_test FROM v_training_set"""


def _split_training(spark, sf):
    """Training rows, nulls and all, split by label, written once."""
    rows = b.training_set(spark, sf).withColumn("label", F.col(config.TARGET).cast("double"))
    rows = settle(ml.stratified_split(rows, "row_key", "label"), "training")
    return rows.filter(~F.col("is_test")), rows.filter("is_test"), list(config.FEATURES)


@query(
    "median_impute",
    "SELECT row_key, "
    + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM v_split WHERE NOT is_test)) AS {c}" for c in config.FEATURES)
    + " FROM v_split",
)
def _(spark, sf):
    # Medians of the training rows, applied to all rows.
    train, test, columns = _split_training(spark, sf)
    return ml.median_impute(train.unionByName(test).select("row_key", *columns), ml.fit_medians(train, columns))


@query(
    "feature_medians",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, median({c}) AS median FROM v_training_set HAVING count({c}) > 0" for c in config.FEATURES
    ),
)
def _(spark, sf):
    return ml.exact_medians(b.training_set(spark, sf), config.FEATURES)


@query(
    "stratified_split",
    f"""SELECT row_key, target_progress_to_stage3_48h,
          row_number() OVER (PARTITION BY {config.TARGET} ORDER BY ('0x' || substr(md5('42:' || row_key), 1, 13))::BIGINT, row_key)
            <= round(count(*) OVER (PARTITION BY {config.TARGET}) * 0.2) AS is_test FROM v_training_set""",
)
def _(spark, sf):
    return ml.stratified_split(b.training_set(spark, sf).select("row_key", config.TARGET), "row_key", config.TARGET)


@query(
    "random_split",
    f"""SELECT row_key, ({hash32("'42:' || row_key")} + 0.5::DOUBLE) / 4294967296.0::DOUBLE < 0.2 AS is_test
        FROM v_training_set""",
)
def _(spark, sf):
    return ml.random_split(b.training_set(spark, sf).select("row_key"), "row_key")


VIEWS["v_scaled_base"] = "SELECT stay_id, charttime, creatinine_mg_dl, urine_ml, hours_since_admit FROM v_features"


@query(
    "assemble_scale",
    "SELECT stay_id, charttime, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS s{i}" for i, c in enumerate(SCALED))
    + " FROM v_mart",
)
def _(spark, sf):
    # The mart's hours have every feature.
    complete = b.warehouse(spark, sf).features.select("stay_id", "charttime", *SCALED).dropna(subset=SCALED)
    rows = settle(complete, "features")
    scaled = Pipeline(stages=ml.assemble_scale(SCALED)).fit(rows).transform(rows)
    v = vector_to_array("features")
    return scaled.select("stay_id", "charttime", *[F.round(v[i], 6).alias(f"s{i}") for i in range(len(SCALED))])


def _valid(scored):
    return scored.select("row_key", "label", F.coalesce(F.col("prob").between(0, 1), F.lit(False)).alias("valid"))


VALID = "SELECT row_key, label, true AS valid FROM v_split"


@query("train_logistic", VALID + " WHERE is_test")
def _(spark, sf):
    train, test, columns = _split_training(spark, sf)
    return _valid(ml.score_batch(ml.fit_logistic(train, columns, "label"), test))


@query("train_gbt", VALID + " WHERE is_test")
def _(spark, sf):
    train, test, columns = _split_training(spark, sf)
    return _valid(ml.score_batch(ml.fit_gbt(train, columns, "label"), test))


def _reports(spark, sf):
    """Scores of both models on the test rows, and every metric by model."""
    train, test, columns = _split_training(spark, sf)
    models = ml.train_pipelines(train, columns, "label")
    scored = [ml.score_batch(m, test).withColumn("model_name", F.lit(name)) for name, m in models.items()]
    scored = settle(scored[0].unionByName(scored[1]), "model-scores")
    return models, test, scored, evaluate.all_metrics(scored, "label", "prob", ["model_name"])


NAMES = "(SELECT unnest(['LogisticRegression', 'GBTClassifier']) AS model_name)"


@query("train_pipelines", f"SELECT model_name, count(*) AS n, true AS valid FROM v_split, {NAMES} WHERE is_test GROUP BY 1")
def _(spark, sf):
    # Metrics themselves have no SQL; they must be shares, and counted over all test rows.
    report = _reports(spark, sf)[3]
    shares = [F.coalesce(F.col(c), F.lit(0.0)).between(0, 1) for c in report.columns if c not in ("model_name", "n")]
    valid = shares[0]
    for share in shares[1:]:
        valid = valid & share
    return report.select("model_name", "n", valid.alias("valid"))


VIEWS["v_test_people"] = f"""
SELECT s.row_key, s.label, p.gender, p.unittype, {projections.AGE_BAND_SQL} AS age_group
FROM v_split s JOIN fx_patients_raw p ON s.patientunitstayid = p.patientunitstayid WHERE s.is_test"""


def _scored_people(spark, sf):
    """A trained model's scores of the test rows, with demographics and the 0/1 prediction."""
    train, test, columns = _split_training(spark, sf)
    scored = ml.score_batch(ml.fit_logistic(train, columns, "label"), test)
    people = privacy.generalize(
        fixtures.patients_raw(spark, sf).select("patientunitstayid", "age", "gender", "unittype")
    )
    scored = scored.select("row_key", "patientunitstayid", "label", "prob").join(people, "patientunitstayid")
    return settle(scored.withColumn("pred", evaluate.at_threshold("prob")), "model-people")


def _shares(report, keys):
    """The keys and counts of a report, and whether all its metrics are shares."""
    valid = F.lit(True)
    for c in report.columns:
        if c not in (*keys, "n", "count"):
            valid = valid & F.coalesce(F.col(c), F.lit(0.0)).between(0, 1)
    return report.select(*keys, *[c for c in report.columns if c in ("n", "count")], valid.alias("valid"))


@query(
    "model_fairness_report",
    """SELECT attribute, value, count(*) AS count, true AS valid
       FROM (SELECT 'gender' AS attribute, gender AS value FROM v_test_people
             UNION ALL SELECT 'age_group', age_group FROM v_test_people)
       WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 10""",
)
def _(spark, sf):
    report = evaluate.fairness_report(_scored_people(spark, sf), ["gender", "age_group"], "label", "pred")
    return _shares(report, ["attribute", "value"])


@query(
    "model_cross_site_report",
    """SELECT CASE WHEN unittype = 'BUILDING' THEN 'Hospital A (Source)' ELSE 'Hospital B (Target)' END AS site,
         count(*) AS n, true AS valid FROM v_test_people WHERE unittype IN ('BUILDING', 'MACHINERY') GROUP BY 1""",
)
def _(spark, sf):
    report = evaluate.cross_site_report(
        _scored_people(spark, sf), "unittype", "BUILDING", "MACHINERY", "label", "prob"
    )
    return _shares(report, ["site"])


@query("score_batch", VALID)
def _(spark, sf):
    # Raw rows of both parts go in, rows with nulls too, and each comes out.
    train, test, columns = _split_training(spark, sf)
    return _valid(ml.score_batch(ml.fit_logistic(train, columns, "label"), train.unionByName(test)))


@query("model_metrics_table", f"SELECT model_name, true AS same FROM {NAMES}")
def _(spark, sf):
    # Written to the mart; its AUROC is that of the ranking operator on the same scores.
    models, test, scored, _ = _reports(spark, sf)
    layer_database(spark, "mart")
    table = layers.materialize(ml.model_metrics_table(models, test, "label"), "mart", "model_metrics")
    ranked = evaluate.ranking_metrics(scored, "label", "prob", ["model_name"]).select("model_name", F.col("auroc").alias("r"))
    same = F.abs(F.coalesce("auroc", F.lit(-1.0)) - F.coalesce("r", F.lit(-1.0))) < 2e-6
    return table.join(ranked, "model_name").select("model_name", same.alias("same"))


VIEWS["v_test_rows"] = "SELECT row_key, label FROM v_split WHERE is_test"


def same_scores(first, second):
    """Rows scored twice, and whether both scores are the same probability."""
    other = second.select("row_key", F.col("prob").alias("_prob"))
    same = (F.col("prob") == F.col("_prob")) & F.col("prob").between(0, 1)
    return first.join(other, "row_key", "left").select("row_key", "label", F.coalesce(same, F.lit(False)).alias("same"))


@query("model_save_load", "SELECT row_key, label, true AS same FROM v_test_rows")
def _(spark, sf):
    train, test, columns = _split_training(spark, sf)
    path = work_dir(spark, "model")
    model = ml.fit_logistic(train, columns, "label")
    ml.model_save(model, path)
    return same_scores(ml.score_batch(ml.model_load(path), test), ml.score_batch(model, test))


VIEWS["v_train_version"] = f"""
SELECT row_count, substr(md5(row_count || '|' || hash_sum), 1, 8) AS version
FROM ({aggregates.fingerprint(["patientunitstayid", "kdigo_stage"], "(SELECT * FROM v_split WHERE NOT is_test)")})"""


@query(
    "run_registry",
    f"""SELECT 'run_' || version AS run_id, model_name, version AS data_version_hash, row_count AS training_rows,
          '10' AS max_iter, true AS best_is_highest FROM v_train_version, {NAMES}""",
)
def _(spark, sf):
    train, test, columns = _split_training(spark, sf)
    version = evaluate.dataset_fingerprint(train, ["patientunitstayid", "kdigo_stage"], columns).first()
    path = work_dir(spark, "registry")
    for name, model in ml.train_pipelines(train, columns, "label").items():
        metrics = evaluate.ranking_metrics(ml.score_batch(model, test), "label", "prob").first()
        ml.run_register(
            spark, path, name, version["version"], version["row_count"], {"max_iter": "10"},
            {"auroc": metrics["auroc"] or 0.0, "auprc": metrics["auprc"] or 0.0},
        )
    runs = ml.run_list(spark, path)
    highest = runs.agg(F.max("auroc")).scalar()
    return runs.select(
        "run_id", "model_name", "lineage.data_version_hash", "lineage.training_rows",
        F.col("parameters")["max_iter"].alias("max_iter"),
        (F.col("is_best") == (F.col("auroc") == highest)).alias("best_is_highest"),
    )


# The values behind the checks above. No SQL trains a model; tests recompute the metrics from the written scores.


@query("model_scores")
def _(spark, sf):
    """Probabilities of both models on the test rows."""
    return _reports(spark, sf)[2].select("model_name", "row_key", "label", "prob")


@query("model_report")
def _(spark, sf):
    """Every metric of both models on the test rows."""
    return _reports(spark, sf)[3]


@query("model_fairness_values")
def _(spark, sf):
    return evaluate.fairness_report(_scored_people(spark, sf), ["gender", "age_group"], "label", "pred")


@query("model_cross_site_values")
def _(spark, sf):
    return evaluate.cross_site_report(_scored_people(spark, sf), "unittype", "BUILDING", "MACHINERY", "label", "prob")
