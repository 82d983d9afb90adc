"""Metrics of trained models, recomputed in SQL from their written scores."""

import duckdb
import pytest

from tests.compare import rows_of
from tests.conftest import SMALL
from tidewatch.plans.catalog import evaluation, models
from tidewatch.plans.oracle import exact_mean
from tidewatch.session import work_dir


def test_metrics_follow_from_the_written_scores(spark, shared_layers):
    _, test, scored, report = models._reports(spark, SMALL)
    path = work_dir(spark, "scores")
    scored.select("model_name", "row_key", "label", "prob").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW s AS SELECT *, (prob >= 0.5)::INTEGER AS pred FROM '{path}/*.parquet'")
    squares = exact_mean("(prob - label) * (prob - label)")
    sql = f"""SELECT c.*, r.auroc, r.auprc, b.brier_score, e.ece FROM ({evaluation.classes("s", "model_name")}) c
        JOIN ({evaluation.ranking("s", "model_name")}) r USING (model_name) JOIN ({evaluation.calibration("s", "model_name")}) e USING (model_name)
        JOIN (SELECT model_name, {squares} AS brier_score FROM s GROUP BY 1) b USING (model_name)"""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    got = [tuple(r[c] for c in names) for r in report.collect()]
    assert rows_of(names, got) == rows_of(names, want) and len(got) == 2
    # The models do better than chance, and their scores differ between rows.
    for name, n, distinct, low, high in con.execute(
        "SELECT model_name, count(*), count(DISTINCT prob), min(prob), max(prob) FROM s GROUP BY 1"
    ).fetchall():
        assert n == test.count() and distinct > 5 and 0 <= low < high <= 1
    assert all(r[names.index("auroc")] > 0.6 for r in want)


def test_fairness_values_are_counted_from_the_predictions(spark, shared_layers):
    people = models._scored_people(spark, SMALL).toPandas()
    report = models.evaluate.fairness_report(
        spark.createDataFrame(people[["gender", "age_group", "label", "pred"]]), ["gender"], "label", "pred"
    ).collect()
    for r in report:
        own = people[people["gender"].astype(str) == str(r["value"])]
        hits = ((own["label"] == 1) & (own["pred"] == 1)).sum()
        if "precision" in r.asDict() and own["pred"].sum():
            assert r["precision"] == pytest.approx(hits / own["pred"].sum(), abs=1e-6)
        assert r["count"] == len(own)
