"""Rows held back and sketches in keyed state, against their plain forms."""

import random
from bisect import bisect_left

from pyspark.sql import functions as F

from tests.test_streaming import some_events
from tidewatch.session import work_dir
from tidewatch.streaming import buffers, sinks, sketches, sources


def delivered(spark, parts, schema):
    """A stream of one micro-batch per part."""
    path = work_dir(spark, "delivered")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return sources.table_stream_source(spark, path, spark.createDataFrame([], schema).schema, max_files=1)


TIMED = "key string, time timestamp, note string, n int"


def test_reorder_restores_the_order_of_shuffled_files(spark):
    rng = random.Random(4)
    base = 1704067200
    rows = [(f"k{i % 3}" if i % 10 else None, base + i * 60, None if i % 7 == 0 else f"é{i}", i) for i in range(300)]
    # A row comes up to 60 places late; the last one sets the rest free.
    late = sorted(rows, key=lambda r: r[3] + rng.randint(0, 60))
    parts = [late[i : i + 50] for i in range(0, 300, 50)] + [[("end", base + 1_000_000, None, -1)]]
    text = "key string, s long, note string, n int"
    stream = delivered(spark, parts, text).select("key", F.timestamp_seconds("s").alias("time"), "note", "n")
    out = sinks.drain(buffers.reorder(stream, "key", "time", "70 minutes"), "reordered").filter("n >= 0").collect()
    assert sorted((r["key"] or "", r["note"] or "", r["n"]) for r in out) == sorted((k or "", note or "", n) for k, _, note, n in rows)
    for key in {r["key"] for r in out}:
        own = sorted((r for r in out if r["key"] == key), key=lambda r: r["position"])
        assert [r["n"] for r in own] == sorted(r["n"] for r in own) and [r["position"] for r in own] == list(range(1, len(own) + 1))
    # Over micro-batches too: each releases only what is newer than all released before.
    waves = {}
    for r in out:
        waves.setdefault(r["released_at"], []).append(r["n"])
    in_turn = [waves[w] for w in sorted(waves)]
    assert len(in_turn) > 3 and all(max(a) < min(b) for a, b in zip(in_turn, in_turn[1:]))


def test_reorder_drops_what_is_too_late(spark):
    base = 1704067200
    parts = [[("a", base + 7200, "x", 1)], [("a", base + 7300, "x", 2)], [("a", base, "late", 3)], [("a", base + 99_999, "end", 4)]]
    stream = delivered(spark, parts, "key string, s long, note string, n int")
    stream = stream.select("key", F.timestamp_seconds("s").alias("time"), "note", "n")
    out = sinks.drain(buffers.reorder(stream, "key", "time", "10 minutes"), "late").orderBy("position").collect()
    assert [r["n"] for r in out] == [1, 2]


def test_groups_are_flushed_by_count_and_by_time(spark):
    events = some_events(spark, 400).select("subject_id", "arrival", "value")
    path = work_dir(spark, "groups")
    events.filter("subject_id < 3").write.parquet(path)
    stream = sources.table_stream_source(spark, path, events.schema)
    expected = events.filter("subject_id < 3").count()
    out = sinks.drain_timed(buffers.flush_groups(stream, "subject_id", "arrival", most=10, after_ms=500), expected, "flushed")
    groups = {}
    for r in out.collect():
        groups.setdefault((r["subject_id"], r["group_no"], r["cause"]), []).append(r["arrival"])
    assert sum(map(len, groups.values())) == expected
    assert all(len(g) == 10 for (_, _, cause), g in groups.items() if cause == "count")
    assert all(len(g) < 10 for (_, _, cause), g in groups.items() if cause == "time")
    assert {cause for _, _, cause in groups} == {"count", "time"}
    for key in range(3):
        own = [g for k, g in sorted(groups.items()) if k[0] == key]
        assert [a for g in own for a in sorted(g)] == sorted(a for g in own for a in g)


def test_a_group_waits_for_its_time_over_restarts(spark):
    events = spark.createDataFrame([(1, i) for i in range(4)], "key int, n long")
    path = work_dir(spark, "wait")
    def run():
        stream = sources.table_stream_source(spark, f"{path}/in", events.schema)
        flushed = buffers.flush_groups(stream, "key", "n", most=6, after_ms=3_600_000)
        # A run over the present input would wait for the timer, so the stream is stopped instead.
        query = sinks.append_files(flushed, f"{path}/out", f"{path}/checkpoint", every="1 second")
        for _ in range(40):
            if query.awaitTermination(1) or sum(p["numInputRows"] for p in query.recentProgress) >= 4:
                break
        query.awaitTermination(2)
        query.stop()
        return spark.read.schema(flushed.schema).parquet(f"{path}/out")
    events.write.mode("append").parquet(f"{path}/in")
    assert run().count() == 0
    events.withColumn("n", F.col("n") + 4).write.mode("append").parquet(f"{path}/in")
    got = run().collect()
    assert sorted(r["n"] for r in got) == list(range(6)) and {(r["group_no"], r["cause"]) for r in got} == {(1, "count")}


def test_histogram_stays_within_its_error():
    rng = random.Random(9)
    for error in (0.5, 0.1, 0.02):
        counts, times, now, most = sketches.Histogram(600, error), [], 0, 0
        for _ in range(20_000):
            now += rng.choice((0, 0, 0, 1, 1, 2, 30 if rng.random() < 0.01 else 0))
            times.append(now)
            exact = len(times) - bisect_left(times, now - 600)
            assert abs(counts.add(now) - exact) <= error * exact
            most = max(most, len(counts.buckets))
        assert most <= (1 / error + 2) * 12


def test_trailing_count_over_micro_batches(spark):
    events = [(i % 2, i, 1704067200 + i * 20) for i in range(900)]
    parts = [events[i : i + 300] for i in range(0, 900, 300)] + [[(5, 9999, None)]]
    stream = delivered(spark, parts, "key int, arrival long, s long").withColumn("event_time", F.timestamp_seconds("s"))
    got = sinks.drain(sketches.stream_trailing_count(stream, "key", error=0.05), "counted").collect()
    assert len(got) == 900
    for r in got:
        exact = sum(1 for k, _, t in events if k == r["arrival"] % 2 and r["second"] - 3600 <= t <= r["second"])
        assert abs(r["estimate"] - exact) <= 0.05 * exact


def test_slice_error_and_no_misses():
    import numpy as np

    rng = np.random.default_rng(1)
    keys, others = rng.integers(0, 1 << 63, (2, 4000), np.int64).view(np.uint64), rng.integers(0, 1 << 63, (2, 50_000), np.int64).view(np.uint64)
    one = sketches.Slice(4000, 0.01)
    one.add(*keys)
    again = sketches.Slice(4000, 0.01, one.bits.tobytes(), one.n)
    assert again.holds(*keys).all() and again.holds(*others).mean() < 0.015


def test_membership_within_the_horizon(spark):
    hour = 3600
    base = 1704067200 // hour * hour

    def rows(ids, at):
        return [(i, f"c{i}", "t", float(i), at * 100_000 + i, base + at * hour) for i in ids]

    # Keys of hour 0 come again in hour 2 (inside the horizon of three hours) and in hour 9 (outside it).
    parts = [rows(range(600), 0), rows(range(300, 900), 2), rows(range(100), 9) + rows(range(100), 9)]
    stream = delivered(spark, parts, "subject_id long, charttime string, event_type string, value double, arrival long, s long")
    stream = stream.withColumn("event_time", F.timestamp_seconds("s"))
    answers = sketches.stream_membership(stream, horizon_seconds=3 * hour, error=0.01, capacity=16, shards=4)
    seen = {}
    for r in sinks.drain(answers, "member").collect():
        seen.setdefault(r["arrival"], []).append(r["maybe_seen"])
    assert all(seen[200_000 + i] == [True] for i in range(300, 600))
    assert all(sorted(seen[900_000 + i])[1] for i in range(100))
    fresh = [seen[i][0] for i in range(600)] + [seen[200_000 + i][0] for i in range(600, 900)]
    assert sum(fresh) <= 0.02 * len(fresh)
    # Beyond the horizon a filter is gone: what it held counts as new.
    assert sum(min(seen[900_000 + i]) for i in range(100)) <= 5


def test_keys_of_a_shard_are_reordered_apart(spark):
    base = 1704067200
    rows = [(None if k == 0 else f"k{k}", base + i * 60, f"{i:03d}", i) for i in range(40) for k in range(5)]
    late = sorted(rows, key=lambda r: (r[3] // 10 + r[3] % 2, r[3] * 7 % 10))
    parts = [late[i : i + 50] for i in range(0, 200, 50)] + [[("end", base + 1_000_000, None, -1)]]
    stream = delivered(spark, parts, "key string, s long, note string, n int")
    stream = stream.select("key", F.timestamp_seconds("s").alias("time"), "note", "n")
    out = sinks.drain(buffers.reorder(stream, "key", "time", "30 minutes", shards=2), "one-shard").filter("n >= 0").collect()
    for key in (None, "k1", "k2", "k3", "k4"):
        own = sorted((r["position"], r["n"]) for r in out if r["key"] == key)
        assert own == [(i + 1, i) for i in range(40)]


def test_keys_of_a_shard_are_flushed_apart(spark):
    rows = [(k or None, k * 100 + i) for k in range(6) for i in range(7 + k)]
    path = work_dir(spark, "one-shard")
    spark.createDataFrame(rows, "key long, n long").repartition(3).write.parquet(path)
    stream = sources.table_stream_source(spark, path, spark.createDataFrame([], "key long, n long").schema)
    out = sinks.drain_timed(buffers.flush_groups(stream, "key", "n", most=5, after_ms=500, shards=1), len(rows), "apart").collect()
    for k in range(6):
        own = sorted((r["group_no"], r["n"], r["cause"]) for r in out if r["key"] == (k or None))
        full = (7 + k) // 5 * 5
        assert own == [(1 + i // 5, k * 100 + i, "count" if i < full else "time") for i in range(7 + k)]


def test_patients_share_calls_and_state_values(spark):
    from tidewatch.streaming import state

    calls = []

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, value):
            calls.append(1)
            self.held = value

    processor = state.PatientState()
    processor.state = Value()
    # 500 patients, one of them without a key, in two micro-batches: one state request each.
    for batch in range(2):
        import pandas as pd

        frame = pd.DataFrame(
            {
                "known": [p > 0 for p in range(500) for _ in range(30)], "subject": [p for p in range(500) for _ in range(30)],
                "charttime": [f"{batch}{i:02d}" for _ in range(500) for i in range(30)], "event_type": ["creatinine", "urine", "other"] * 5000,
                "value": [float(100 * batch + i) for _ in range(500) for i in range(30)], "unnumbered": False,
                "arrival": range(15000), "uom": None,
            }
        )
        (out,) = processor.handleInputRows((0,), iter([frame.sample(frac=1, random_state=1)[:7000], frame.sample(frac=1, random_state=1)[7000:]]), None)
    assert len(calls) == 2 and len(out) == 15000
    last = out.groupby("subject").tail(1)
    assert (last["event_count"] == 60).all()
    assert all(list(h) == [float(i) for i in range(0, 30, 3)] + [100.0 + i for i in range(0, 30, 3)] for h in last["creatinine_history"])
    assert all(list(h) == [float(i) for i in range(1, 30, 3)] + [100.0 + i for i in range(1, 30, 3)] for h in last["urine_history"])
