"""Splits, imputation, Spark ML training and scoring, and the run registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.hashing import hash52, unit_uniform
from tidewatch.operators.skew import BLOCK_ROWS, running, salted_join, value_blocks
from tidewatch.session import work_dir
from tidewatch.sources.layers import settle

IMPUTED = "_imputed_"


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, median) for every column, exact.

    Values are counted per column, accumulated in blocks of values, and the middle ones picked
    by position; no task holds a column. A column without values has no row.
    """
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])
        ).alias("x")
    ).select("x.feature", "x.v")
    counted = settle(
        long.filter(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n")),
        "median-counts",
    )
    ranked = running(
        value_blocks(counted, "v"), ["feature"], ["v"], F.col("_part"), {"upto": ("sum", "n")}
    )
    totals = counted.groupBy("feature").agg(F.sum("n").alias("total"))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    after = F.col("upto") - F.col("n")
    return (
        salted_join(ranked, totals, ["feature"])
        .filter(((after < low) & (low <= F.col("upto"))) | ((after < high) & (high <= F.col("upto"))))
        .groupBy("feature")
        .agg(((F.min("v") + F.max("v")) / 2).alias("median"))
    )


def median_imputer(medians: Mapping[str, float | None]) -> SQLTransformer:
    """A pipeline stage that adds `IMPUTED` + column for each column: the value, or the given median.

    NaN counts as missing. The medians are literals of the stage, one number per feature, and are
    saved with it. A column whose median is None stays as it is.
    """
    known = {c: "CAST(NULL AS DOUBLE)" if m is None else f"CAST({m!r} AS DOUBLE)" for c, m in medians.items()}
    filled = [
        f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {value}) AS `{IMPUTED}{c}`"
        for c, value in known.items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of the training rows, None for a column without values."""
    found = {r["feature"]: r["median"] for r in exact_medians(train, columns).collect()}
    return {c: found.get(c) for c in columns}


def median_impute(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Nulls replaced by the fitted medians, in place; no row is dropped."""
    imputed = median_imputer(medians).transform(df)
    return imputed.select(*[F.col(IMPUTED + c).alias(c) if c in medians else F.col(c) for c in df.columns])


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """`is_test` marks the share of each label with the lowest hashes, counted exactly.

    Ranks inside a label are accumulated in blocks of hash values.
    """
    priced = settle(
        df.withColumn("_h", hash52(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))), "split"
    )
    # Hashes are even, so equal ranges of them hold about BLOCK_ROWS rows each.
    blocks = max(1, -(-priced.count() // BLOCK_ROWS))
    block = F.floor(F.col("_h") / F.lit(-(-(1 << 52) // blocks)))
    ranked = running(priced, [label], ["_h", key], block, {"_rank": ("count", F.lit(1))})
    sizes = priced.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    return salted_join(ranked, sizes, [label]).withColumn(
        "is_test", F.col("_rank") <= F.round(F.col("_size") * F.lit(test_share))
    ).select(*df.columns, "is_test")


def random_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """`is_test` by hash: the same rows on every run, whatever the partitioning."""
    draw = unit_uniform(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("is_test", draw < test_share)


def assemble_scale(columns: Sequence[str]) -> list:
    """Pipeline stages: a vector with zero mean and unit deviation. A null is an error, not a lost row."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features", handleInvalid="error"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]


def prepared(train: DataFrame, columns: Sequence[str]) -> list:
    """Stages from raw rows to scaled vectors: medians of the training rows first.

    A column without any training value is no feature.
    """
    medians = {c: m for c, m in fit_medians(train, columns).items() if m is not None}
    if not medians:
        raise ValueError("no feature has a value among the training rows")
    return [median_imputer(medians), *assemble_scale([IMPUTED + c for c in medians])]


def fit_logistic(train: DataFrame, columns: Sequence[str], label: str, max_iter: int = 10) -> PipelineModel:
    """Imputer, scaler and logistic regression fitted on the training rows."""
    return _logistic_on(Pipeline(stages=prepared(train, columns)).fit(train), train, label, max_iter)


def _logistic_on(ready: PipelineModel, train: DataFrame, label: str, max_iter: int = 10) -> PipelineModel:
    """`ready`, fitted by the stages of `prepared`, with a logistic regression on the rows it prepares."""
    last = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter).fit(ready.transform(train))
    return _without_summary(PipelineModel([*ready.stages, last]), train.sparkSession)


def _without_summary(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as saved and loaded again, its numbers the same.

    A fresh logistic model carries its training summary, and with that the session, into every task. A session that
    has observed metrics once does not serialize, so such a model would score no row.
    """
    path = work_dir(spark, "model")
    model_save(model, path)
    return model_load(path)


def fit_gbt(
    train: DataFrame, columns: Sequence[str], label: str, max_iter: int = 10, max_depth: int = 5, step: float = 0.1,
    seed: int = 42,
) -> PipelineModel:
    """Imputer, scaler and boosted trees fitted on the training rows."""
    return _gbt_on(Pipeline(stages=prepared(train, columns)).fit(train), train, label, max_iter, max_depth, step, seed)


def _gbt_on(
    ready: PipelineModel, train: DataFrame, label: str, max_iter: int = 10, max_depth: int = 5, step: float = 0.1, seed: int = 42
) -> PipelineModel:
    last = GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=seed
    )
    return PipelineModel([*ready.stages, last.fit(ready.transform(train))])


def train_pipelines(train: DataFrame, columns: Sequence[str], label: str) -> dict[str, PipelineModel]:
    """Both models on the same rows, with medians and scales that are fitted once."""
    ready = Pipeline(stages=prepared(train, columns)).fit(train)
    return {"LogisticRegression": _logistic_on(ready, train, label), "GBTClassifier": _gbt_on(ready, train, label)}


def score_batch(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every row, nulls or not, with `prob`, the probability of the positive class. Works on a stream as well."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias("prob"))


def model_metrics_table(models: dict[str, PipelineModel], test: DataFrame, label: str) -> DataFrame:
    """(model_name, auroc) per model, with ties counted exactly."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
    )
    rows = [(name, float(evaluator.evaluate(model.transform(test)))) for name, model in models.items()]
    return test.sparkSession.createDataFrame(rows, "model_name string, auroc double")


def model_save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def model_load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_register(
    spark: SparkSession, path: str, model_name: str, version: str, row_count: int,
    parameters: dict[str, str], metrics: dict[str, float],
) -> None:
    """Append one run to the registry table; its id comes from the data version."""
    row = spark.range(1).select(
        F.lit(f"run_{version[:8]}").alias("run_id"),
        F.lit(model_name).alias("model_name"),
        F.current_timestamp().alias("timestamp"),
        F.struct(
            F.lit(version).alias("data_version_hash"), F.lit(row_count).cast("bigint").alias("training_rows")
        ).alias("lineage"),
        F.create_map(*[F.lit(x) for kv in parameters.items() for x in kv]).alias("parameters"),
        F.create_map(*[F.lit(x) for k, v in metrics.items() for x in (k, float(v))]).alias("metrics"),
    )
    row.write.mode("append").parquet(path)


def run_list(spark: SparkSession, path: str) -> DataFrame:
    """Runs, newest first, with the best AUROC of all beside each."""
    runs = spark.read.parquet(path)
    auroc = F.col("metrics").getItem("auroc")
    best = runs.agg(F.max(auroc).alias("best")).scalar()
    return runs.select(
        "run_id", "model_name", "timestamp", "lineage", "parameters", auroc.alias("auroc"), (auroc == best).alias("is_best")
    ).orderBy(F.col("timestamp").desc(), "run_id")
