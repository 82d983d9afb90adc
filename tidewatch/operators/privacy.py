"""k-anonymity by suppression, differentially private group means, and a ledger of what they spend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions import rules
from tidewatch.functions.hashing import hash52, unit_uniform
from tidewatch.functions.numeric import exact_mean
from tidewatch.operators.joins import group_semi_join
from tidewatch.operators.skew import salted_join
from tidewatch.sources.layers import settle

QUASI_IDENTIFIERS = ("age_group", "gender", "unittype")


def generalize(df: DataFrame, age: str = "age") -> DataFrame:
    return df.withColumn("age_group", rules.age_band(age))


def k_anonymize(df: DataFrame, k: int = 5, group: Sequence[str] = QUASI_IDENTIFIERS) -> DataFrame:
    """Rows whose quasi-identifiers are shared by at least k rows; null parts are suppressed."""
    return group_semi_join(df, group, k)


def group_sizes(df: DataFrame, group: Sequence[str] = QUASI_IDENTIFIERS) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("group_size"))


def group_size_tag(df: DataFrame, group: Sequence[str] = QUASI_IDENTIFIERS) -> DataFrame:
    """Every row with the size of its group, as a number and as a "k=n" tag. The rows are written first."""
    df = settle(df, "tagged-rows")
    sizes = group_sizes(df.dropna(subset=list(group)), group)
    tagged = salted_join(df, sizes, list(group), how="left")
    size = F.coalesce("group_size", F.lit(0)).cast("bigint")
    return tagged.withColumn("group_size", size).withColumn(
        "k_tag", F.concat(F.lit("k="), size.cast("string"))
    )


def suppression_report(df: DataFrame, k: int = 5, group: Sequence[str] = QUASI_IDENTIFIERS) -> DataFrame:
    """Total, kept and suppressed rows, from the group sizes alone."""
    complete = F.lit(True)
    for c in group:
        complete = complete & F.col(c).isNotNull()
    sizes = group_sizes(df, group)
    n = F.col("group_size")
    return sizes.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(complete & (n >= k), n)), F.lit(0)).alias("kept_rows"),
    ).select(
        F.lit(k).alias("k"),
        "total_rows",
        "kept_rows",
        (F.col("total_rows") - F.col("kept_rows")).alias("suppressed_rows"),
        F.round(
            F.try_divide(F.col("total_rows") - F.col("kept_rows"), F.col("total_rows").cast("double")), 6
        ).alias("suppressed_share"),
    )


def laplace_noise(group: Column, scale: Column, seed: int | str) -> Column:
    """Laplace noise by inverse CDF from a uniform that depends on the group and the seed."""
    u = unit_uniform(F.concat(group.cast("string"), F.lit(f"#{seed}"))) - 0.5
    return -scale * F.signum(u) * F.log(1 - 2 * F.abs(u))


def dp_group_mean(
    df: DataFrame,
    group: str = "unittype",
    value: str = "creatinine",
    epsilon: float = 1.0,
    *,
    seed: int | str,
    bounds: tuple[float, float] = config.DP_RANGE,
    clip: bool = True,
    audit: bool = False,
) -> DataFrame:
    """Rows and private mean per group; with `audit`, the true mean and the noise beside it.

    A null value counts as a row but not in the mean; a null group is left out; epsilon 0
    adds no noise. `clip` bounds each value first, which the sensitivity assumes. The noise follows
    from `seed`: draw it afresh for every release and keep it secret, or the noise can be taken off.
    """
    low, high = bounds
    x = F.col(value)
    x = F.greatest(F.least(x, F.lit(high)), F.lit(low)) if clip else x
    if clip:
        x = F.when(F.col(value).isNotNull(), x)
    means = (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("patient_count"), exact_mean(x).alias("_mean"))
    )
    noise = (
        F.lit(0.0)
        if epsilon == 0
        else laplace_noise(F.col(group), F.lit((high - low) / epsilon) / F.col("patient_count"), seed)
    )
    private = means.withColumn("_noise", noise)
    columns = [group, "patient_count", F.round(F.col("_mean") + F.col("_noise"), 6).alias("dp_mean")]
    if audit:
        columns += [
            F.round("_mean", 6).alias("actual_mean"),
            F.round("_noise", 6).alias("noise_added"),
        ]
    return private.select(*columns)


def dp_noise_report(df: DataFrame, **options) -> DataFrame:
    """Private minus actual mean per group: an audit view, not for release."""
    return dp_group_mean(df, audit=True, **options)


def bound_contributions(
    df: DataFrame, person: Sequence[str], row_key: Sequence[str], most: int, seed: int | str
) -> DataFrame:
    """At most `most` rows of each person, chosen by the hash of their key and a secret seed.

    `person` names the columns that tell a person, with the group where each group is released. Each task keeps
    `most` rows per person before the shuffle. Rows without a person are left out.
    """
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in row_key])
    ranked = Window.partitionBy(*person).orderBy(hash52(key), *row_key)
    known = F.lit(True)
    for c in person:
        known = known & F.col(c).isNotNull()
    return df.filter(known).withColumn("_turn", F.row_number().over(ranked)).filter(F.col("_turn") <= most).drop("_turn")


def dp_person_mean(
    df: DataFrame, group: str, value: str, person: str, row_key: Sequence[str], most: int = 5, epsilon: float = 1.0, *,
    seed: int | str, bounds: tuple[float, float] = config.DP_RANGE,
) -> DataFrame:
    """Rows, sensitivity and private mean per group, where the noise protects a person and not a row.

    A person adds at most `most` rows with a value to a group, each clipped to `bounds`. Taking one person out of n
    rows then moves the mean by at most (high - low) * most / (n - most), and never by more than high - low: the
    sensitivity, to which the noise is scaled. Row counts are released as they are. Draw the seed afresh for every
    release, keep it secret, and enter epsilon in a ledger (`spend`).
    """
    if not epsilon > 0 or most < 1:
        raise ValueError("epsilon and the rows of a person must be positive")
    low, high = bounds
    bounded = bound_contributions(df.filter(F.col(value).isNotNull()), [person, group], row_key, most, seed)
    means = bounded.groupBy(group).agg(
        F.count(F.lit(1)).alias("bounded_rows"), exact_mean(F.greatest(F.least(F.col(value), F.lit(high)), F.lit(low))).alias("_mean")
    )
    n = F.col("bounded_rows")
    share = F.when(n > 2 * most, F.lit(float(most)) / (n - most)).otherwise(F.lit(1.0))
    moved = F.lit(high - low) * share
    noise = laplace_noise(F.col(group), moved / F.lit(epsilon), seed)
    return means.select(
        group, "bounded_rows", F.round(moved, 9).alias("sensitivity"), F.round(F.col("_mean") + noise, 6).alias("dp_mean")
    )


class BudgetSpent(Exception):
    """A release would take more epsilon than is left."""


def spent(spark: SparkSession, ledger: str) -> DataFrame:
    """The releases in a ledger: release, epsilon."""
    try:
        return spark.read.schema("epsilon double, release string").parquet(ledger).select("release", "epsilon")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "release string, epsilon double")


def spend(spark: SparkSession, ledger: str, release: str, epsilon: float, budget: float) -> float:
    """Enter a release before it is made, and return the epsilon left; by sequential composition they add up.

    A release lies under its own name: entered again, with the same epsilon, it counts once, so a repeated job is
    no second release. Without enough budget nothing is entered and `BudgetSpent` is raised. One writer at a time.
    """
    if not epsilon > 0:
        raise ValueError("a release without noise has no epsilon")
    entered = {r["release"]: r["epsilon"] for r in spent(spark, ledger).collect()}
    if entered.get(release, epsilon) != epsilon:
        raise ValueError(f"{release} was entered with another epsilon")
    left = budget - sum(entered.values()) - (0 if release in entered else epsilon)
    if left < -1e-9:
        raise BudgetSpent(f"{release} needs {epsilon}; {left + epsilon:g} is left")
    if release not in entered:
        one = spark.createDataFrame([(epsilon, release)], "epsilon double, release string")
        one.coalesce(1).write.partitionBy("release").mode("append").parquet(ledger)
    return max(left, 0.0)
