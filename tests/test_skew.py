"""The two-level and chunked forms equal plain windows, also when one key has most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import evaluate, hourly, ml, series, sketches, skew


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows of one key and 40 other keys with a few rows each; times tie, values have gaps."""
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id"))
    rest = spark.range(3000, 3400).select(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")).alias("k"), "id")
    df = hot.unionByName(rest)
    return df.select(
        "k",
        "id",
        F.timestamp_add("MINUTE", (F.col("id") * 7 / 3).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("t"),
        F.when(F.col("id") % 5 != 0, ((F.col("id") * 7919) % 1009).cast("double")).alias("v"),
    ).cache()


def same(a, b):
    columns = sorted(a.columns)
    key = lambda r: tuple(str(x) for x in r)
    left = sorted((tuple(r) for r in a.select(*columns).collect()), key=key)
    right = sorted((tuple(r) for r in b.select(*columns).collect()), key=key)
    assert left == right and left


@pytest.mark.parametrize("ties", [False, True])
def test_running_equals_window(skewed, ties):
    w = Window.partitionBy("k").orderBy("t") if ties else Window.partitionBy("k").orderBy("t", "id")
    plain = w.rangeBetween(Window.unboundedPreceding, 0) if ties else w.rowsBetween(Window.unboundedPreceding, 0)
    columns = {"hi": ("max", "v"), "lo": ("min", "v"), "s": ("sum", "v"), "n": ("count", F.lit(1))}
    order = ["t"] if ties else ["t", "id"]
    if not ties:
        columns["last"] = ("last", "v")
    actual = skew.running(skewed, ["k"], order, hourly.day("t"), columns, ties=ties)
    expected = skewed.withColumns(
        {
            o: (F.last("v", ignorenulls=True) if fn == "last" else getattr(F, fn)(c)).over(plain)
            for o, (fn, c) in columns.items()
        }
    )
    same(actual, expected)


def test_running_without_key(skewed):
    actual = skew.running(skewed, [], ["id"], F.floor(F.col("id") / 100), {"s": ("sum", "id")})
    same(actual, skewed.withColumn("s", F.sum("id").over(Window.orderBy("id"))))


@pytest.mark.parametrize("size", [50, 64, 1000])
def test_chunks_equal_window(skewed, size):
    rows = skew.chunks(skewed, ["k"], ["t", "id"], hourly.day("t"), back=48, ahead=2, size=size)
    w, plain = skew.chunk_window(["k"]), Window.partitionBy("k").orderBy("t", "id")
    def frames(x):
        return {
            "lag48": F.lag("v", 48).over(x),
            "lead2": F.lead("v", 2).over(x),
            "sum24": F.sum("v").over(x.rowsBetween(-23, 0)),
            "max": F.max("v").over(x.rowsBetween(-46, 1)),
        }
    same(skew.drop_halo(rows.withColumns(frames(w))), skewed.withColumns(frames(plain)))


def test_hot_key_is_cut(skewed):
    rows = skew.chunks(skewed, ["k"], ["t", "id"], hourly.day("t"), back=10, size=100)
    biggest = rows.groupBy("k", skew.CHUNK).count().agg(F.max("count")).first()[0]
    assert biggest <= 110
    own = rows.filter((F.col("k") == "hot") & ~F.col(skew.HALO))
    assert own.select(skew.CHUNK).distinct().count() == 30


def test_chunk_must_hold_the_frame(skewed):
    with pytest.raises(ValueError):
        skew.chunks(skewed, ["k"], ["t"], hourly.day("t"), back=48, size=10)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, skewed, how):
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("zz", 4)], "k string, w int")
    same(skew.salted_join(skewed, small, ["k"], how=how), skewed.join(small, "k", how))


def test_salted_join_spreads_the_hot_key(skewed):
    from tidewatch.functions.hashing import salt

    salts = skewed.filter("k = 'hot'").groupBy(salt(8, "k", "id", "t", "v").alias("s")).count().collect()
    assert len(salts) == 8
    assert max(r["count"] for r in salts) < 600


def test_trailing_count_equals_range_window(skewed):
    seconds = F.timestamp_diff("SECOND", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.col("t"))
    w = Window.orderBy(seconds).rangeBetween(-3600, 0)
    actual = sketches.trailing_event_count(skewed, time="t")
    same(actual, skewed.withColumn("events_1h", F.count(F.lit(1)).over(w)))


def test_forward_target_with_hot_key(skewed):
    labeled = skewed.select(
        "k", hourly.hour("t").alias("hour_bucket"), (F.col("id") % 97 % 4).cast("int").alias("kdigo_stage"), "id"
    )
    hours = F.timestamp_diff("HOUR", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.col("hour_bucket"))
    w = Window.partitionBy("k").orderBy(hours).rangeBetween(1, 48)
    actual = series.progression_target_forward(labeled, "k").select("id", "future_max_stage_48h")
    same(actual, labeled.select("id", F.max("kdigo_stage").over(w).alias("future_max_stage_48h")))


def test_exact_medians(spark, skewed):
    expected = skewed.agg(F.percentile("v", F.lit(0.5))).first()[0]
    even = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "v double")
    assert ml.exact_medians(skewed.select("v"), ["v"]).first()["median"] == expected
    assert ml.exact_medians(even, ["v"]).first()["median"] == 6.0


def test_one_score_for_a_third_of_the_rows(spark):
    df = spark.range(9000).select(
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") % 1000) / 1000.0).alias("prob"),
    )
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    check = BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="label", numBins=0)
    expected = check.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert evaluate.ranking_metrics(df, "label", "prob").first()["auroc"] == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("name", ["window_join_labs", "clean_labs_by_label", "group_semi_join", "lsh_similar", "roc_curve"])
def test_results_do_not_depend_on_broadcasts(spark, duck, shared_layers, name):
    """On large tables these joins shuffle both sides; switch broadcasts off to take that way here."""
    from __spark_entry__ import oracle_sql, queries
    from tests.compare import compare
    from tests.conftest import SMALL

    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(s, None) for s in settings]
    try:
        for s in settings:
            spark.conf.set(s, "-1")
        problem, _ = compare(queries()[name](spark, SMALL), oracle_sql()[name], duck)
    finally:
        for s, value in zip(settings, before):
            spark.conf.unset(s) if value is None else spark.conf.set(s, value)
    assert not problem


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_the_copies_count_in_the_size_check(spark, tmp_path, how):
    # The small side would pass for a broadcast, its eight copies do not.
    spark.range(20000).select((F.col("id") * 3).alias("k")).coalesce(1).write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    big = spark.range(30000).select((F.col("id") % 700).alias("k"), F.col("id").alias("row"))
    bytes_read = sum(f.stat().st_size for f in (tmp_path / "small").glob("*.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(bytes_read * 4))
    try:
        joined = skew.salted_join(big, small, ["k"], how=how)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        got = sorted(joined.select("k", "row").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = [(i % 700, i) for i in range(30000)]
    wanted = {"inner": lambda k: k % 3 == 0, "left_semi": lambda k: k % 3 == 0, "left_anti": lambda k: k % 3, "left": lambda k: True}[how]
    assert [tuple(r) for r in got] == sorted(r for r in rows if wanted(r[0]))


def test_compressed_files_are_not_broadcast_unmeasured(spark):
    from tidewatch.sources.layers import settle

    # A few megabytes of files, many more of rows: each of them is more than a tenth of the usual threshold.
    n = 500_000
    many = settle(spark.range(n).select("id", F.xxhash64("id").alias("x")), "many")
    others = settle(spark.range(n).select("id", F.xxhash64("id", F.lit(1)).alias("y")), "others")
    size = int(str(many._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert 1 << 20 < size < 10 << 20

    def large_broadcasts(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("BroadcastHashJoin")

    assert large_broadcasts(skew.salted_join(many, others, ["id"])) == 0
    block = F.floor(F.col("id") / 10)
    assert large_broadcasts(skew.running(many, ["x"], ["id"], block, {"n": ("count", F.lit(1))})) == 0
