"""The one live stream: repeats over restarts, replayed micro-batches, bounded shared state."""

import json

from pyspark.sql import functions as F

from tests.test_streaming import COLUMNS, some_events
from tidewatch import config, schemas
from tidewatch.operators import live, similarity, sketches
from tidewatch.session import work_dir
from tidewatch.sources.layers import settle
from tidewatch.streaming import live as stream_live
from tidewatch.streaming import sinks, sources, twins


def some_history(spark, n=300):
    return spark.range(n).select(
        F.col("id").cast("string").alias("row_key"),
        *[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(config.FEATURES)],
        (F.col("id") % 2).alias(config.TARGET),
    )


def test_traces_over_restarts_equal_the_batch(spark):
    events = some_events(spark).withColumn("hadm_id", F.lit(1).cast("long"))
    people = spark.range(5).select(F.col("id").alias("subject_id"), F.lit(3).cast("long").alias("group_size"))
    history = some_history(spark)
    path = work_dir(spark, "live")
    # Half of the events, their repeats with the other half, then repeats alone.
    deliveries = [events.filter("arrival < 200"), events.filter("arrival >= 200 or arrival % 9 = 0"), events.filter("arrival > 390")]
    for delivered in deliveries:
        delivered.coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = sources.table_stream_source(spark, f"{path}/in", events.schema)
        stream_live.live_stream(
            stream, people, history, f"{path}/out", f"{path}/checkpoint", n_bits=3, available_now=True
        ).awaitTermination()
    traces = spark.read.schema(schemas.TRACE).json(f"{path}/out/traces")
    got = {(r["patient_id"], r["timestamp"], r["record"]["type"]): r for r in traces.collect()}
    assert len(got) == traces.count() == 400
    batch = settle(live.scored(live.live_state(events.withColumn("event_time", F.col("charttime").cast("timestamp_ntz")))), "b")
    index = twins.index_of(history, work_dir(spark, "index"), n_bits=3)
    for r in twins.with_twins(batch.withColumn("vector", live.live_feature_vector()), index).collect():
        t = got[str(r["subject_id"]), r["charttime"], r["event_type"]]
        assert t["vector"] == r["vector"] and t["kdigo_stage"] == r["kdigo_stage"] and t["anomaly_score"] == r["anomaly_score"]
        assert [tuple(x) for x in t["twins"]] == [tuple(x) for x in r["twins"]] and len(r["twins"]) <= 3
        assert t["algorithms"]["k_anonymity"] == ("k=3" if r["subject_id"] < 5 else "k=0")
    assert len({r["batch_id"] for r in got.values()}) == 2
    # One event a minute: 61 in an hour with both ends.
    assert got["2", "2024-01-01 02:01:00", "urine"]["algorithms"]["dgim_events_1h"] == 61
    assert len(sinks.versions(spark, f"{path}/out/staged")) <= 2 and len(sinks.versions(spark, f"{path}/out/shared")) <= 2


def test_a_replayed_batch_writes_the_same(spark):
    events = some_events(spark, 60)
    states = live.scored(live.live_state(events.withColumn("event_time", F.col("charttime").cast("timestamp_ntz")))).drop("event_time")
    rows = states.withColumn("accepted", F.lit(True)).unionByName(
        events.select("subject_id", "charttime", "arrival").withColumn("accepted", F.lit(False)), allowMissingColumns=True
    )
    people = spark.createDataFrame([], "subject_id long, group_size long")
    index = twins.index_of(some_history(spark), work_dir(spark, "index"), n_bits=3)
    path = work_dir(spark, "replay")

    def written(i):
        lines = [json.loads(r["value"]) for r in spark.read.text(f"{path}/traces/batch={i}").collect()]
        return sorted(lines, key=lambda t: (t["patient_id"], t["timestamp"]))

    first, second = rows.filter("arrival < 30"), rows.filter("arrival >= 30")
    stream_live.trace_batch(first, 0, path, people, index)
    stream_live.trace_batch(second, 1, path, people, index)
    once = written(1)
    stream_live.trace_batch(second, 1, path, people, index)
    assert written(1) == once and len(once) == 30


def test_shared_counts_stay_bounded(spark):
    arrived = some_events(spark).select(*[c.split()[0] for c in COLUMNS.split(", ")])
    shared = spark.createDataFrame([], stream_live.SHARED)
    for i in range(4):
        part = arrived.filter(F.floor(F.col("arrival") / 100) == i)
        shared = settle(stream_live.merge_shared(shared, part, keep=600), "shared")
    seconds = shared.filter("kind = 'second'").count()
    assert 100 < seconds <= 100 + 10
    zeros = {r["k"]: r["n"] for r in shared.filter("kind = 'zeros'").collect()}
    exact = arrived.select(sketches.trailing_zeros(F.col("subject_id")).alias("z"), "arrival").groupBy("z").agg(F.min("arrival").alias("n"))
    assert zeros == {r["z"]: r["n"] for r in exact.collect()}


def test_a_micro_batch_is_planned_with_measured_sizes(spark):
    events = some_events(spark, 60).withColumn("hadm_id", F.lit(1).cast("long"))
    people = spark.createDataFrame([], "subject_id long, group_size long")
    index = twins.index_of(some_history(spark), work_dir(spark, "index"), n_bits=3)
    path, adaptive = work_dir(spark, "adaptive"), []
    events.coalesce(1).write.parquet(f"{path}/in")
    rows = stream_live.arrivals_and_states(sources.table_stream_source(spark, f"{path}/in", events.schema))

    def write(lines, folder):
        adaptive.append((lines.sparkSession.conf.get("spark.sql.adaptive.enabled"), lines.count()))

    sinks.each_batch(
        rows, lambda batch, i: stream_live.trace_batch(batch, i, f"{path}/out", people, index, write=write), f"{path}/checkpoint", True
    ).awaitTermination()
    assert [a for a in adaptive if a[1]] == [("true", 60)]


def test_a_micro_batch_joins_its_events_once(spark, monkeypatch):
    # Twins are searched for events that were written with what was joined to them; the search reads them more than once.
    events = some_events(spark, 60)
    states = live.scored(live.live_state(events.withColumn("event_time", F.col("charttime").cast("timestamp_ntz")))).drop("event_time")
    rows = states.withColumn("accepted", F.lit(True)).unionByName(
        events.select("subject_id", "charttime", "arrival").withColumn("accepted", F.lit(False)), allowMissingColumns=True
    )
    people = spark.range(5).select(F.col("id").alias("subject_id"), F.lit(3).cast("long").alias("group_size"))
    index = twins.index_of(some_history(spark), work_dir(spark, "index"), n_bits=3)
    path, plans, with_twins = work_dir(spark, "joined"), [], twins.with_twins

    def watched(events, *args):
        plans.append(events._jdf.queryExecution().executedPlan().toString())
        return with_twins(events, *args)

    monkeypatch.setattr(twins, "with_twins", watched)
    for i in range(3):
        stream_live.trace_batch(rows, i, path, people, index)
    assert len(plans) == 3 and not any("Join" in plan for plan in plans)
    assert len(spark.read.text(f"{path}/traces/batch=2").collect()) == 60
    assert len(sinks.versions(spark, f"{path}/tagged")) <= 2


def test_twins_of_many_events_come_in_rounds(spark, monkeypatch):
    # Events that share a key, without a key and without history; with many pairs no pair is a row.
    states = live.scored(live.live_state(some_events(spark, 90).withColumn("event_time", F.col("charttime").cast("timestamp_ntz"))))
    key = F.when(F.col("arrival") % 7 != 0, F.col("arrival") - F.col("arrival") % 2)
    events = settle(states.withColumn("arrival", key), "shared-keys")
    found = []
    for few in (similarity.FEW_PAIRS, 0):
        monkeypatch.setattr(similarity, "FEW_PAIRS", few)
        for n in (300, 0):
            index = twins.index_of(some_history(spark, n), work_dir(spark, "index"), n_bits=3)
            rows = twins.with_twins(events, index)
            if n and not few:
                assert rows._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 3
            found.append(sorted(str(r) for r in rows.collect()))
            found.append(sorted(str(r) for r in twins.twins_of(events, index).collect()))
    assert found[:4] == found[4:] and len(found[0]) == len(found[2]) == 90 and len(found[1]) > 90 and not found[3]
    assert "rank=3" in str(found[1])
