"""Model evaluation as grouped aggregates: ranking, calibration, subgroups, sites, lineage.

Ranking metrics work on distinct scores. Those are counted first, so that any number of rows
with one score is one row, and then accumulated in blocks of score values: no task sorts all
scores. Every metric takes `by`, the grouping columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions.hashing import hash52
from tidewatch.functions.numeric import exact_mean
from tidewatch.operators.skew import running, salted_join, value_blocks
from tidewatch.sources.layers import settle

ALL = "_all"


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(by)) if by else (df.withColumn(ALL, F.lit(1)), [ALL])


def score_points(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group and distinct score, highest first: positives, negatives and both so far."""
    df, groups = _grouped(df, by)
    counted = df.groupBy(*groups, F.col(prob).alias("prob")).agg(
        F.sum(F.col(label)).cast("bigint").alias("pos"),
        F.sum(1 - F.col(label)).cast("bigint").alias("neg"),
    )
    points = settle(counted.withColumn("_down", -F.col("prob")), "score-points")
    return running(
        value_blocks(points, "_down"),
        groups,
        ["_down"],
        F.col("_part"),
        {"cum_pos": ("sum", "pos"), "cum_neg": ("sum", "neg")},
    ).drop("_down", "_part")


def ranking_metrics(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """AUROC (ties count half) and average precision (step sum); null for a single class."""
    points = score_points(df, label, prob, by)
    groups = list(by) or [ALL]
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    sums = points.groupBy(*groups).agg(
        F.sum(pos).alias("p"),
        F.sum(neg).alias("n"),
        F.sum(pos * F.col("cum_neg")).alias("beaten"),
        F.sum(pos * neg).alias("tied"),
        F.sum(pos * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("steps"),
    )
    both = (F.col("p") > 0) & (F.col("n") > 0)
    pairs = F.col("p") * F.col("n")
    return sums.select(
        *by,
        F.when(both, F.round((pairs - F.col("beaten") + F.col("tied") / 2) / pairs, 6)).alias("auroc"),
        F.when(both, F.round(F.col("steps") / F.col("p"), 6)).alias("auprc"),
    )


def roc_curve(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Every point of the curve; the first has an infinite threshold."""
    points = score_points(df, label, prob, by)
    groups = list(by) or [ALL]
    totals = points.groupBy(*groups).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    curve = points.select(*groups, F.col("prob").alias("threshold"), "cum_pos", "cum_neg")
    start = totals.select(
        *groups,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0).cast("bigint").alias("cum_pos"),
        F.lit(0).cast("bigint").alias("cum_neg"),
    )
    return salted_join(curve.unionByName(start), totals, groups).select(
        *by,
        "threshold",
        F.round(F.try_divide(F.col("cum_neg"), F.col("n")), 6).alias("fpr"),
        F.round(F.try_divide(F.col("cum_pos"), F.col("p")), 6).alias("tpr"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("truth"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def at_threshold(prob: str, threshold: float = 0.5) -> Column:
    return (F.col(prob) >= threshold).cast("int")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_metrics(
    df: DataFrame, label: str, prediction: str | Column, by: Sequence[str] = ()
) -> DataFrame:
    """Rows, precision, recall, F1 and accuracy; 0 where a denominator is 0."""
    guess = F.col(prediction) if isinstance(prediction, str) else prediction
    truth = F.col(label)
    df, groups = _grouped(df, by)
    counts = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(truth * guess).alias("tp"),
        F.sum((1 - truth) * guess).alias("fp"),
        F.sum(truth * (1 - guess)).alias("fn"),
    )
    tp, fp, fn, n = F.col("tp"), F.col("fp"), F.col("fn"), F.col("n")
    return counts.select(
        *by,
        n.cast("bigint").alias("n"),
        F.round(_ratio(tp, tp + fp), 6).alias("precision"),
        F.round(_ratio(tp, tp + fn), 6).alias("recall"),
        F.round(_ratio(2 * tp, 2 * tp + fp + fn), 6).alias("f1"),
        F.round(_ratio(n - fp - fn, n), 6).alias("accuracy"),
    )


def brier_score(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    df, groups = _grouped(df, by)
    gap = F.col(prob) - F.col(label)
    return df.groupBy(*groups).agg(exact_mean(gap * gap).alias("brier_score")).select(*by, "brier_score")


def calibration_bins(
    df: DataFrame, label: str, prob: str, bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Per bin (low, high]: rows, mean label, mean score. Bin 0 holds scores of exactly 0."""
    df, groups = _grouped(df, by)
    inner = F.array(*[F.lit(i * (1.0 / bins)) for i in range(bins)])
    number = F.size(F.filter(inner, lambda edge: edge < F.col(prob)))
    return df.groupBy(*groups, number.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("observed"), F.avg(prob).alias("confidence")
    )


def ece(df: DataFrame, label: str, prob: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Expected calibration error. Scores of 0 are in no bin but count as rows."""
    groups = list(by) or [ALL]
    gap = F.when(F.col("bin") > 0, F.col("n") * F.abs(F.col("confidence") - F.col("observed")))
    return (
        calibration_bins(df, label, prob, bins, by)
        .groupBy(*groups)
        .agg(F.round(F.coalesce(F.sum(gap), F.lit(0.0)) / F.sum("n"), 6).alias("ece"))
        .select(*by, "ece")
    )


def all_metrics(
    df: DataFrame, label: str, prob: str, by: Sequence[str], threshold: float = 0.5
) -> DataFrame:
    """One row per group with every metric; the parts hold one row per group each."""
    by = list(by)
    table = classification_metrics(df, label, at_threshold(prob, threshold), by)
    for part in (
        ranking_metrics(df, label, prob, by),
        brier_score(df, label, prob, by),
        ece(df, label, prob, by=by),
    ):
        table = table.join(part, by)
    return table


def fairness_report(
    df: DataFrame, attributes: Sequence[str], label: str, prediction: str,
    at_least: int = config.MIN_SUBGROUP,
) -> DataFrame:
    """Per attribute value: rows, precision, recall, F1. Small and null groups are left out."""
    pairs = F.array(
        *[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes]
    )
    long = df.select(label, prediction, F.explode(pairs).alias("pair")).select(
        label, prediction, "pair.attribute", "pair.value"
    )
    report = classification_metrics(
        long.filter(F.col("value").isNotNull()), label, prediction, ["attribute", "value"]
    )
    return report.filter(F.col("n") >= at_least).select(
        "attribute", "value", F.col("n").alias("count"), "precision", "recall", "f1"
    )


def report_sort(report: DataFrame) -> DataFrame:
    return report.orderBy("attribute", "f1", "value")


def subgroup_calibration(df: DataFrame, group: str, label: str, prob: str) -> DataFrame:
    return ece(df.filter(F.col(group).isNotNull()), label, prob, by=[group])


def cross_site_report(
    df: DataFrame, site: str, source: str, target: str, label: str, prob: str, names: Sequence[str] = config.SITE_NAMES
) -> DataFrame:
    """All metrics of two sites, called by `names`."""
    named = F.when(F.col(site) == source, names[0]).otherwise(names[1])
    two = df.filter(F.col(site).isin(source, target)).withColumn("site", named)
    return all_metrics(two, label, prob, ["site"])


def calibration_decay(
    report: DataFrame, limit: float = config.CALIBRATION_DECAY_LIMIT, names: Sequence[str] = config.SITE_NAMES
) -> DataFrame:
    """How much worse calibrated the target is than the source, and whether that is too much."""
    def one(site: str) -> Column:
        return F.max(F.when(F.col("site") == site, F.col("ece")))

    gap = report.agg((one(names[1]) - one(names[0])).alias("gap"))
    return gap.select(
        F.round("gap", 6).alias("ece_difference"), (F.col("gap") > limit).alias("warning")
    )


def _pairwise(df: DataFrame, columns: Sequence[str], fn, out: str, diagonal: bool) -> DataFrame:
    pairs = list(combinations(columns, 2)) + ([(c, c) for c in columns] if diagonal else [])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(fn(a, b), 6).alias(out))
            for a, b in pairs
        ]
    )
    return df.agg(cells.alias("cells")).select(F.inline("cells"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations, one pass for all pairs; not a number where a column is constant."""

    def corr(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        spread = [F.stddev_pop(F.when(both, F.col(c).cast("double"))) for c in (a, b)]
        found = F.try_divide(F.covar_pop(a, b), spread[0] * spread[1])
        return F.when(F.count_if(both) > 0, F.coalesce(found, F.lit(float("nan"))))

    return _pairwise(df, columns, corr, "corr", diagonal=False)


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete sample covariances, variances included."""
    return _pairwise(df, columns, F.covar_samp, "cov", diagonal=True)


def bucket_of(value: str, low: float, high: float, bins: int) -> Column:
    """0 below `low`, bins + 1 from `high` on, 1..bins between, as width_bucket counts."""
    x = F.col(value)
    inside = F.floor((x - F.lit(low)) * F.lit(float(bins)) / F.lit(high - low)) + 1
    return F.when(x < low, 0).when(x >= high, bins + 1).otherwise(inside).cast("int")


def feature_histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(bucket_of(value, low, high, bins).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(value).alias("feature"), "bucket", "n")
    )


def feature_histograms(df: DataFrame, bounds: Mapping[str, tuple[float, float]], bins: int) -> DataFrame:
    """The histograms of several features in one pass."""
    cells = [
        F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNotNull(), bucket_of(c, low, high, bins)).alias("bucket"))
        for c, (low, high) in bounds.items()
    ]
    counted = df.select(F.inline(F.array(*cells))).filter(F.col("bucket").isNotNull())
    return counted.groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("n"))


def distribution_compare(
    first: DataFrame, second: DataFrame, value: str, low: float, high: float, bins: int
) -> DataFrame:
    """Shares per bucket in two sources and each bucket's part of the population-stability index."""
    both = first.select(value, F.lit(1).alias("src")).unionByName(
        second.select(value, F.lit(2).alias("src"))
    )
    counts = (
        both.filter(F.col(value).isNotNull())
        .groupBy(bucket_of(value, low, high, bins).alias("bucket"))
        .agg(
            F.count_if(F.col("src") == 1).alias("n_first"),
            F.count_if(F.col("src") == 2).alias("n_second"),
        )
    )
    # At most bins + 2 rows from here on.
    sums = F.struct(F.sum("n_first").alias("first"), F.sum("n_second").alias("second"))
    total = counts.agg(sums).scalar()
    share_1 = F.col("n_first") / total.getField("first")
    share_2 = F.col("n_second") / total.getField("second")
    psi = F.when(
        (F.col("n_first") > 0) & (F.col("n_second") > 0), (share_2 - share_1) * F.log(share_2 / share_1)
    )
    return counts.select(
        "bucket",
        "n_first",
        "n_second",
        F.round(share_1, 6).alias("share_first"),
        F.round(share_2, 6).alias("share_second"),
        F.round(psi, 6).alias("psi_part"),
    )


def dataset_fingerprint(df: DataFrame, integers: Sequence[str], doubles: Sequence[str] = ()) -> DataFrame:
    """An order-free content hash: row count, and the sums of both halves of the rows' 52-bit hashes.

    Doubles enter as millionths, since engines print them differently.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in integers] + [
        F.coalesce(F.round(F.col(c) * 1000000).cast("bigint").cast("string"), F.lit("~")) for c in doubles
    ]
    row_hash = hash52(F.concat_ws("|", *parts))
    high, low = F.floor(row_hash / F.lit(1 << 26)), row_hash % F.lit(1 << 26)
    total = F.concat_ws(".", *[F.coalesce(F.sum(half), F.lit(0)).cast("string") for half in (high, low)])
    return df.agg(F.count(F.lit(1)).alias("row_count"), total.alias("hash_sum")).withColumn(
        "version", F.substring(F.md5(F.concat_ws("|", F.col("row_count").cast("string"), "hash_sum")), 1, 8)
    )
