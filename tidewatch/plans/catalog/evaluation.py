"""Evaluation metrics and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import evaluate
from tidewatch.plans import bindings as b
from tidewatch.plans import fixtures
from tidewatch.plans.catalog import joining  # noqa: F401
from tidewatch.plans.oracle import VIEWS, exact_mean
from tidewatch.plans.registry import query


def ranking(source: str, by: str = "") -> str:
    """AUROC and average precision by the textbook: average ranks, and steps of recall."""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
SELECT {lead}CASE WHEN p > 0 AND n > 0 THEN round((pos_ranks - p * (p + 1) / 2) / (p * n), 6) END AS auroc,
       CASE WHEN p > 0 AND n > 0 THEN round(steps / p, 6) END AS auprc
FROM (SELECT {lead}sum(label)::DOUBLE AS p, (count(*) - sum(label))::DOUBLE AS n,
             sum(CASE WHEN label = 1 THEN avg_rank ELSE 0 END) AS pos_ranks,
             sum(CASE WHEN label = 1 THEN tp / total ELSE 0 END) AS steps
      FROM (SELECT *, rank() OVER ({part} ORDER BY prob)
                      + (count(*) OVER ({part + ', prob' if by else 'PARTITION BY prob'}) - 1) / 2.0::DOUBLE AS avg_rank,
                   sum(label) OVER ({part} ORDER BY prob DESC)::DOUBLE AS tp,
                   count(*) OVER ({part} ORDER BY prob DESC)::DOUBLE AS total FROM {source})
      {group})"""


def classes(source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""
SELECT {lead}n, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1,
       round((n - fp - fn) / n::DOUBLE, 6) AS accuracy
FROM (SELECT {lead}count(*) AS n, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
             count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn FROM {source} {"GROUP BY " + by if by else ""})"""


def calibration(source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    passed = " + ".join(f"(prob > {i * 0.1!r}::DOUBLE)::INTEGER" for i in range(10))
    return f"""
SELECT {lead}round(coalesce(sum(CASE WHEN bin > 0 THEN n * abs(confidence - observed) END), 0) / sum(n), 6) AS ece
FROM (SELECT {lead}{passed} AS bin, count(*) AS n,
             avg(label) AS observed, avg(prob) AS confidence FROM {source} GROUP BY {lead}bin)
{"GROUP BY " + by if by else ""}"""


def _scores(spark, sf):
    return fixtures.scores(spark, sf).withColumn("pred", evaluate.at_threshold("prob"))


VIEWS["v_scores"] = "SELECT *, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred FROM fx_scores"


@query("confusion_matrix", "SELECT label AS truth, pred AS prediction, count(*) AS n FROM v_scores GROUP BY 1, 2")
def _(spark, sf):
    return evaluate.confusion_matrix(_scores(spark, sf), "label", "pred")


@query("classification_metrics", classes("v_scores"))
def _(spark, sf):
    return evaluate.classification_metrics(_scores(spark, sf), "label", "pred")


@query("brier_score", f"SELECT {exact_mean('(prob - label) * (prob - label)')} AS brier_score FROM v_scores")
def _(spark, sf):
    return evaluate.brier_score(_scores(spark, sf), "label", "prob")


@query("ece", calibration("v_scores"))
def _(spark, sf):
    return evaluate.ece(_scores(spark, sf), "label", "prob")


VIEWS["v_ranking"] = ranking("v_scores")


@query("auroc", "SELECT auroc FROM v_ranking")
def _(spark, sf):
    return evaluate.ranking_metrics(_scores(spark, sf), "label", "prob").select("auroc")


@query("average_precision", "SELECT auprc FROM v_ranking")
def _(spark, sf):
    return evaluate.ranking_metrics(_scores(spark, sf), "label", "prob").select("auprc")


@query(
    "roc_curve",
    """SELECT prob AS threshold, round(fp / (sum(neg) OVER ())::DOUBLE, 6) AS fpr,
         round(tp / (sum(pos) OVER ())::DOUBLE, 6) AS tpr
       FROM (SELECT prob, pos, neg, sum(pos) OVER (ORDER BY prob DESC) AS tp, sum(neg) OVER (ORDER BY prob DESC) AS fp
             FROM (SELECT prob, sum(label) AS pos, sum(1 - label) AS neg FROM v_scores GROUP BY prob))
       UNION ALL SELECT 'infinity'::DOUBLE, 0.0, 0.0""",
)
def _(spark, sf):
    return evaluate.roc_curve(_scores(spark, sf), "label", "prob")


VIEWS["v_fair_long"] = """
SELECT 'gender' AS attribute, gender AS value, label, pred FROM v_scored_people WHERE gender IS NOT NULL
UNION ALL SELECT 'age_group', age_group, label, pred FROM v_scored_people WHERE age_group IS NOT NULL"""
VIEWS["v_fair"] = f"""
SELECT attribute, value, n AS count, precision, recall, f1
FROM ({classes("v_fair_long", "attribute, value")}) WHERE n >= 10"""


def _fair(spark, sf):
    return evaluate.fairness_report(b.scored_people(spark, sf), ["gender", "age_group"], "label", "pred")


@query("fairness_report", "SELECT * FROM v_fair")
def _(spark, sf):
    return _fair(spark, sf)


@query("report_sort", "SELECT * FROM v_fair ORDER BY attribute, f1")
def _(spark, sf):
    return evaluate.report_sort(_fair(spark, sf))


@query(
    "subgroup_calibration",
    calibration("(SELECT * FROM v_scored_people WHERE age_group IS NOT NULL)", "age_group"),
)
def _(spark, sf):
    return evaluate.subgroup_calibration(b.scored_people(spark, sf), "age_group", "label", "prob")


VIEWS["v_sites"] = """
SELECT *, CASE WHEN unittype = 'BUILDING' THEN 'Hospital A (Source)' ELSE 'Hospital B (Target)' END AS site
FROM v_scored_people WHERE unittype IN ('BUILDING', 'MACHINERY')"""
VIEWS["v_site_classes"] = classes("v_sites", "site")
VIEWS["v_site_ranking"] = ranking("v_sites", "site")
VIEWS["v_site_ece"] = calibration("v_sites", "site")
VIEWS["v_cross_site"] = f"""
SELECT c.*, r.auroc, r.auprc, b.brier_score, e.ece
FROM v_site_classes c JOIN v_site_ranking r ON c.site = r.site
JOIN (SELECT site, {exact_mean('(prob - label) * (prob - label)')} AS brier_score FROM v_sites GROUP BY site) b ON c.site = b.site
JOIN v_site_ece e ON c.site = e.site"""


def _cross(spark, sf):
    return evaluate.cross_site_report(
        b.scored_people(spark, sf), "unittype", "BUILDING", "MACHINERY", "label", "prob"
    )


@query("cross_site_report", "SELECT * FROM v_cross_site")
def _(spark, sf):
    return _cross(spark, sf)


@query(
    "calibration_decay",
    """SELECT round(max(CASE WHEN site = 'Hospital B (Target)' THEN ece END)
                  - max(CASE WHEN site = 'Hospital A (Source)' THEN ece END), 6) AS ece_difference,
         max(CASE WHEN site = 'Hospital B (Target)' THEN ece END)
           - max(CASE WHEN site = 'Hospital A (Source)' THEN ece END) > 0.05 AS warning FROM v_site_ece""",
)
def _(spark, sf):
    return evaluate.calibration_decay(_cross(spark, sf))


@query("metrics_by_unit", f"""SELECT c.*, r.auroc, r.auprc, b.brier_score, e.ece
FROM ({classes("(SELECT * FROM v_scored_people WHERE unittype IS NOT NULL)", "unittype")}) c
JOIN ({ranking("(SELECT * FROM v_scored_people WHERE unittype IS NOT NULL)", "unittype")}) r ON c.unittype = r.unittype
JOIN (SELECT unittype, {exact_mean('(prob - label) * (prob - label)')} AS brier_score FROM v_scored_people GROUP BY 1) b
  ON c.unittype = b.unittype
JOIN ({calibration("(SELECT * FROM v_scored_people WHERE unittype IS NOT NULL)", "unittype")}) e ON c.unittype = e.unittype""")
def _(spark, sf):
    people = b.scored_people(spark, sf).filter(F.col("unittype").isNotNull())
    return evaluate.all_metrics(people, "label", "prob", ["unittype"])
