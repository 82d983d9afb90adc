"""Streams against their batch twins: many files, late and repeated events, restarts, bad lines."""

import json

from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import live, sketches
from tidewatch.session import work_dir
from tidewatch.sources.layers import settle
from tidewatch.streaming import operators, sinks, sources, state

COLUMNS = "subject_id long, charttime string, event_type string, value double, arrival long, uom string"


def some_events(spark, n=400):
    return spark.range(n).select(
        (F.col("id") % 7).alias("subject_id"),
        F.date_format(F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss").alias("charttime"),
        F.when(F.col("id") % 3 == 0, "creatinine").otherwise("urine").alias("event_type"),
        (F.col("id") * 37 % 90 + 1).cast("double").alias("value"),
        F.col("id").alias("arrival"),
        F.lit("u").alias("uom"),
    )


def in_files(spark, df, slices):
    """One file per slice of arrivals, in arrival order."""
    path = work_dir(spark, "files")
    for i in range(slices):
        df.filter(F.floor(F.col("arrival") * slices / 400) == i).coalesce(1).write.mode("append").parquet(path)
    return path


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_state_over_many_batches_equals_batch(spark):
    events = some_events(spark)
    path = in_files(spark, events, 4)
    stream = sources.table_stream_source(spark, path, events.schema, max_files=1)
    streamed = sinks.drain(state.stream_patient_state(stream), "state")
    batch = live.scored(live.live_state(events.withColumn("event_time", F.col("charttime").cast("timestamp_ntz")), size=64))
    columns = ["arrival", "event_count", "kdigo_stage", "anomaly_score", "risk_band"]
    assert rows(streamed, *columns) == rows(batch, *columns)
    numbers = ["arrival", "creatinine", "baseline", "cr_ratio", "cr_delta_recent", "uo_ml_kg_hr_6h", "uo_ml_kg_hr_24h"]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in numbers]
    assert rows(streamed, *text) == rows(batch, *text)


def test_state_survives_a_restart(spark):
    events = some_events(spark)
    source, path = work_dir(spark, "restart-in"), work_dir(spark, "restart")
    def run():
        stream = sources.table_stream_source(spark, source, events.schema)
        sinks.append_files(
            state.stream_patient_state(stream), f"{path}/data", f"{path}/checkpoint", available_now=True
        ).awaitTermination()
    events.filter("arrival < 200").write.mode("append").parquet(source)
    run()
    events.filter("arrival >= 200").write.mode("append").parquet(source)
    run()
    counted = spark.read.parquet(f"{path}/data").groupBy("subject_id").agg(F.max("event_count").alias("n"))
    assert rows(counted, "subject_id", "n") == rows(events.groupBy("subject_id").agg(F.count("*").alias("n")), "subject_id", "n")


def test_dedup_drops_repeats_in_later_files(spark):
    events = some_events(spark)
    path = work_dir(spark, "repeats")
    # One file each: files in any other order would let the watermark pass early events by.
    events.coalesce(1).write.mode("append").parquet(path)
    events.filter("arrival % 5 = 0").coalesce(1).write.mode("append").parquet(path)
    stream = sources.with_event_time(sources.table_stream_source(spark, path, events.schema, max_files=1))
    unique = sinks.drain(operators.stream_dedup(stream, sketches.EVENT_KEY), "dedup")
    assert unique.count() == 400


def test_dedup_needs_its_columns(spark):
    stream = spark.readStream.format("rate").load()
    assert operators.stream_dedup(stream) is stream


def test_late_events_count_in_their_window(spark):
    events = some_events(spark)
    path = work_dir(spark, "late")
    events.filter("arrival >= 100").coalesce(1).write.mode("append").parquet(path)
    events.filter("arrival < 100").coalesce(1).write.mode("append").parquet(path)
    stream = sources.with_event_time(sources.table_stream_source(spark, path, events.schema, max_files=1))
    counted = sinks.drain_updates(operators.stream_sliding_counts(stream), ["window_start", "window_end"], "late-counts")
    batch = sketches.sliding_counts(sources.with_event_time(events), "event_time")
    assert rows(counted, "window_start", "events") == rows(batch, "window_start", "events")


def test_unparsable_lines_are_dropped(spark):
    path = work_dir(spark, "lines")
    good = {"subject_id": 1, "hadm_id": 2, "stay_id": 3, "charttime": "2024-01-01 00:00:00", "event_type": "urine", "value": 5.0, "uom": "mL"}
    lines = [json.dumps(good), "{broken", "", json.dumps({**good, "subject_id": 2})]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    parsed = sinks.drain(sources.jsonl_stream_source(spark, path), "parsed")
    assert rows(parsed, "subject_id") == [(1,), (2,)]
    assert parsed.columns == schemas.LIVE_EVENT.fieldNames()


def test_stream_sample_equals_batch_sample(spark):
    events = some_events(spark)
    stream = sources.table_stream_source(spark, in_files(spark, events, 4), events.schema, max_files=1)
    path = work_dir(spark, "sample")
    sinks.stream_sample(stream, f"{path}/data", f"{path}/checkpoint", 20, "arrival", True).awaitTermination()
    sampled = spark.read.parquet(sinks.latest_version(spark, f"{path}/data"))
    assert rows(sampled, "arrival") == rows(sketches.reservoir_sample(events, 20, "arrival"), "arrival")


def test_stats_count_repeats_of_earlier_batches_once(spark):
    events = some_events(spark, 40)
    path = work_dir(spark, "stats")
    for part in ("arrival < 20", "arrival between 10 and 29", "arrival >= 20"):
        events.filter(part).coalesce(1).write.mode("append").parquet(f"{path}/in")
        # Stopped and started again between the files.
        stream = sources.table_stream_source(spark, f"{path}/in", events.schema, max_files=1)
        sinks.stream_stats(stream, path, f"{path}/checkpoint", True, sample=25).awaitTermination()

    def log():
        return spark.read.parquet(f"{path}/log").orderBy("batch").collect()

    def metric(name):
        return [r["metric_value"] for r in log() if r["metric_name"] == name]

    assert metric("allowed_events") == [20, 10, 10] and metric("duplicate_events") == [0, 10, 10]
    assert metric("duplicate_rate") == [0, 0.5, 0.5] and metric("distinct_patients") == [7, 7, 7]
    # One event a minute: an hour's six slides hold all 40 and the 20 that came again.
    assert metric("sample_size") == [20, 25, 25] and metric("window_events") == [20, 40, 60]
    assert len(sinks.versions(spark, f"{path}/recent")) <= 2 and len(sinks.versions(spark, f"{path}/sample")) <= 2

    before = log()
    newest = max(r["batch"] for r in before)
    timed = sources.with_event_time(events)
    replayed = timed.filter("arrival >= 20").withColumn("first", F.lit(False)).unionByName(
        timed.filter("arrival >= 30").withColumn("first", F.lit(True))
    )
    sinks.write_stats(replayed, newest, path, 25, "7 HOURS")
    plain = lambda rows: [(r["batch"], r["metric_name"], r["metric_value"]) for r in rows]
    assert sorted(plain(log())) == sorted(plain(before))


def test_window_estimates_unite_sketches(spark):
    # 4,000 patients in every ten minutes, the same ones in two micro-batches.
    rows = spark.range(8000).select(
        (F.col("id") % 4000).alias("subject_id"), F.col("id").alias("arrival"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 3) * 600).alias("event_time"), F.lit(False).alias("first"),
    )
    path = work_dir(spark, "windows")
    sinks.write_stats(rows.filter("arrival < 4000"), 0, path, 10, "7 HOURS")
    sinks.write_stats(rows.filter("arrival >= 4000"), 1, path, 10, "7 HOURS")
    found = sinks.window_estimates(spark, path).collect()
    full = [r for r in found if r["events"] == 8000]
    assert full and all(abs(r["patients"] - 4000) <= 4000 * r["error"] and r["error"] < 0.05 for r in full)
    assert sum(r["events"] for r in found) == 8000 * 6


def test_state_takes_missing_values(spark):
    events = some_events(spark, 60).withColumn("value", F.when(F.col("arrival") % 4 != 0, F.col("value")))
    stream = sources.table_stream_source(spark, in_files(spark, events, 4), events.schema, max_files=1)
    streamed = sinks.drain(state.stream_patient_state(stream), "nulls")
    batch = live.scored(live.live_state(events.withColumn("event_time", F.col("charttime").cast("timestamp_ntz"))))
    columns = ["arrival", "event_count", "kdigo_stage", "anomaly_score", "risk_band"]
    assert rows(streamed, *columns) == rows(batch, *columns)


def test_reference_rate_is_the_mean(spark):
    events = some_events(spark, 30).withColumn("event_time", F.col("charttime").cast("timestamp_ntz"))
    by_sum = settle(live.live_state(events), "s").filter("uo_ml_kg_hr_6h is not null")
    by_mean = live.live_state(events, rate="reference").filter("uo_ml_kg_hr_6h is not null")
    assert by_sum.agg(F.avg("uo_ml_kg_hr_6h")).first()[0] > by_mean.agg(F.avg("uo_ml_kg_hr_6h")).first()[0]


def test_synthetic_events_are_plausible_and_repeatable(spark):
    from tidewatch.sources import synthetic

    ids = spark.range(4000)
    first = synthetic.synthetic_events(ids)
    assert rows(first, "id", "value", "charttime") == rows(synthetic.synthetic_events(ids.repartition(7)), "id", "value", "charttime")
    low = first.groupBy("event_type").agg(F.min("value").alias("low"), F.count("*").alias("n")).collect()
    assert all(r["low"] >= (0.2 if r["event_type"] == "creatinine" else 0.0) and 1700 < r["n"] < 2300 for r in low)
    sick = first.filter("event_type = 'creatinine'").groupBy((F.col("subject_id") % 5 == 0).alias("sick")).agg(F.avg("value").alias("v"))
    by = {r["sick"]: r["v"] for r in sick.collect()}
    assert by[True] > by[False] + 1.5
    steps = first.select(F.col("charttime").cast("timestamp").cast("long").alias("t"), "id").orderBy("id").collect()
    gaps = {(b["t"] - a["t"]) // 60 for a, b in zip(steps, steps[1:])}
    assert gaps == set(range(1, 16))


def test_synthetic_stream_has_the_event_fields(spark):
    from tidewatch.sources import synthetic

    stream = synthetic.synthetic_stream(spark)
    assert stream.isStreaming and set(schemas.LIVE_EVENT.fieldNames()) <= set(stream.columns)


def test_twin_search_reads_its_own_buckets_only(spark):
    from tidewatch import config
    from tidewatch.operators import similarity
    from tidewatch.streaming import twins

    history = spark.range(300).select(
        F.col("id").cast("string").alias("row_key"),
        *[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(config.FEATURES)],
        (F.col("id") % 2).alias(config.TARGET),
    )
    moments = similarity.feature_moments(history)
    path = work_dir(spark, "twin-index")
    index = similarity.write_index(
        similarity.lsh_index(twins.shown(history), "row_key", moments, n_tables=3, n_bits=4, keep=twins.SHOWN), path
    )
    events = spark.range(1).selectExpr(
        "id AS arrival", "3.0D AS creatinine", "1.0D AS baseline", "3.0D AS cr_ratio", "0.5D AS cr_delta_recent",
        "1.0D AS uo_ml_kg_hr_6h", "1.0D AS uo_ml_kg_hr_24h",
    )
    found = twins.twins_of(events, twins.TwinIndex(index, moments, "row_key", 3, 4))
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "twin-index" in line and "FileScan" in line]
    assert len(scan) == 1 and scan[0].count("bucket#") >= 3 and "PartitionFilters: [" in scan[0]
    assert "table_id" in scan[0].split("PartitionFilters: [")[1].split("]")[0]
    assert found.count() <= 3 and found.columns == ["arrival", "rank", "twin_id", "outcome", "distance", "cr", "uo"]
