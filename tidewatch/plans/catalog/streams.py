"""Streaming queries, run over the present input to their end; most equal their batch twins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch import config, schemas
from tidewatch.operators import live, ml, similarity, sketches
from tidewatch.plans import bindings as b
from tidewatch.plans import cohort, fixtures
from tidewatch.plans import live as live_plan
from tidewatch.plans.catalog import live as live_catalog
from tidewatch.plans.catalog import models, quality, windows  # noqa: F401
from tidewatch.plans.catalog import similarity as similar_catalog
from tidewatch.plans.oracle import VIEWS, hash32
from tidewatch.plans.registry import query
from tidewatch.session import work_dir
from tidewatch.sources.layers import settle
from tidewatch.streaming import live as stream_live
from tidewatch.streaming import buffers, operators, sinks, sources, state, twins
from tidewatch.streaming import sketches as stream_sketches

MAX_FILES = 64
EVENT = "subject_id, hadm_id, stay_id, charttime, event_type, value, uom"


def _stream(spark, sf, max_files=MAX_FILES):
    """Live events from the events file, read as a stream."""
    schema = fixtures.table(spark, sf, "events").schema
    source = sources.table_stream_source(spark, sf, schema, "events.parquet", max_files)
    return sources.with_event_time(fixtures.as_live(source))


def _payloads(spark, sf, broken=None):
    """The live events as JSON lines in a folder; some cut short on demand."""
    path = work_dir(spark, "payloads")
    text = F.to_json(F.struct(*schemas.LIVE_EVENT.fieldNames()))
    if broken is not None:
        text = F.when(broken, F.substring(text, 1, 25)).otherwise(text)
    fixtures.live_events(spark, sf).select(text.alias("value")).write.text(path)
    return path


@query("jsonl_stream_source", f"SELECT {EVENT} FROM fx_live")
def _(spark, sf):
    return sinks.drain(sources.jsonl_stream_source(spark, _payloads(spark, sf)), "jsonl")


@query("kafka_source", f"SELECT {EVENT} FROM fx_live WHERE arrival % 50 <> 0")
def _(spark, sf):
    # The same payloads and parser as a topic's, read from files: one message in fifty is cut.
    path = _payloads(spark, sf, F.col("arrival") % 50 == 0)
    return sinks.drain(sources.parse_payload(spark.readStream.text(path)), "topic")


@query("stream_dedup", f"SELECT {EVENT} FROM v_unique")
def _(spark, sf):
    unique = operators.stream_dedup(_stream(spark, sf), sketches.EVENT_KEY)
    return sinks.drain(unique, "dedup").select(*schemas.LIVE_EVENT.fieldNames())


@query("stream_sliding_counts", live_catalog.SLIDING.format("fx_live"))
def _(spark, sf):
    counts = operators.stream_sliding_counts(_stream(spark, sf))
    return sinks.drain_updates(counts, ["window_start", "window_end"], "sliding")


@query(
    "stream_distinct_patients",
    live_catalog.SLIDING.format("fx_live").replace("count(*) AS events", "true AS close").replace(
        "SELECT epoch_us", "SELECT subject_id, epoch_us"
    ),
)
def _(spark, sf):
    # The estimate of every window beside the exact count: it must be within a fifth of it.
    estimates = operators.stream_distinct_patients(_stream(spark, sf))
    streamed = sinks.drain_updates(estimates, ["window_start", "window_end"], "distinct")
    exact = (
        b.live(spark, sf)
        .groupBy(F.window("event_time", "1 hour", "10 minutes").alias("w"))
        .agg(F.count_distinct("subject_id").alias("exact"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "exact")
    )
    off = F.abs(F.col("patients") - F.col("exact"))
    return streamed.join(exact, "window_start").select(
        "window_start", "window_end", (off <= F.col("exact") * 0.2).alias("close")
    )


# Three files by time, and second deliveries in the file after; estimates know what came up to an event's own file.
DAY = 86400
VIEWS["v_delivered"] = f"""
SELECT *, (epoch_us(event_time) // 1000000 - 1704067200) AS sec,
       least((epoch_us(event_time) // 1000000 - 1704067200) // {DAY}, 2) + CASE WHEN arrival >= 1000000000 THEN 1 ELSE 0 END AS file
FROM (SELECT *, charttime::TIMESTAMP AS event_time FROM fx_live)"""
VIEWS["v_firsts"] = """
SELECT *, row_number() OVER (PARTITION BY subject_id, charttime, event_type, value ORDER BY arrival) = 1 AS first FROM v_delivered"""
VIEWS["v_file_seconds"] = """
SELECT f.file, d.sec, count(*) AS n FROM v_delivered d JOIN (SELECT unnest(range(4)) AS file) f ON d.file <= f.file GROUP BY 1, 2"""
VIEWS["v_file_trailing"] = """
SELECT e.arrival, w.events_1h FROM v_delivered e JOIN (
  SELECT file, sec, sum(n) OVER (PARTITION BY file ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)::BIGINT AS events_1h
  FROM v_file_seconds) w ON e.file = w.file AND e.sec = w.sec"""
VIEWS["v_file_zeros"] = f"""
SELECT f.file, z, min(arrival) AS since
FROM (SELECT arrival, file, CASE WHEN h <> 0 THEN bit_count((h & -h) - 1) END AS z
      FROM (SELECT arrival, file, {hash32("subject_id::VARCHAR")} AS h FROM v_delivered)) d
JOIN (SELECT unnest(range(4)) AS file) f ON d.file <= f.file GROUP BY 1, 2"""
VIEWS["v_file_distinct"] = """
SELECT e.arrival, (2 ** coalesce(max(z.z), 0))::BIGINT AS distinct_estimate
FROM v_delivered e LEFT JOIN v_file_zeros z ON z.file = e.file AND z.since <= e.arrival GROUP BY e.arrival"""


def deliveries(spark, sf):
    """Live events with the number of the file that brings them."""
    sec = F.unix_timestamp(F.col("charttime").cast("timestamp")) - F.lit(1704067200)
    file = F.least(F.floor(sec / DAY), F.lit(2)) + F.when(F.col("arrival") >= 1000000000, 1).otherwise(0)
    return fixtures.live_events(spark, sf).withColumn("file", file.cast("int"))


def _stats(spark, sf):
    """The statistics of four deliveries in time order; second copies come a delivery later than the first."""
    path = work_dir(spark, "stats")
    sources.write_turns(settle(deliveries(spark, sf), "deliveries"), f"{path}/in", "file", 4)
    schema = fixtures.live_events(spark, sf).schema
    events = sources.table_stream_source(spark, f"{path}/in", schema, max_files=1)
    sinks.stream_stats(events, path, f"{path}/checkpoint", True).awaitTermination()
    return path


@query(
    "stream_stats",
    """SELECT file, metric_name, metric_value FROM (
         SELECT file, unnest(['allowed_events', 'duplicate_events', 'duplicate_rate', 'distinct_patients', 'sample_size',
                              'window_events']) AS metric_name,
                unnest([allowed, arrivals - allowed, (arrivals - allowed) / arrivals, patients, least(100, so_far), hour]::DOUBLE[]) AS metric_value
         FROM (SELECT file, count(*) AS arrivals, count(*) FILTER (first) AS allowed, count(DISTINCT subject_id) AS patients,
                      sum(count(*)) OVER (ORDER BY file) AS so_far FROM v_firsts GROUP BY file)
         JOIN (SELECT f.file, count(*) AS hour FROM v_firsts d JOIN (SELECT file, max(max(sec) // 600) OVER (ORDER BY file) AS top
                 FROM v_firsts GROUP BY file) f ON d.file <= f.file AND d.sec // 600 > f.top - 6 GROUP BY 1) USING (file))""",
)
def _(spark, sf):
    # All six metrics of every micro-batch. So few patients are counted exactly by the sketch.
    path = _stats(spark, sf)
    log = spark.read.schema(f"{schemas.METRIC_LOG.simpleString()[7:-1].replace(':', ' ')}, batch long").parquet(f"{path}/log")
    order = log.select("batch").distinct().withColumn("file", (F.row_number().over(Window.orderBy("batch")) - 1).cast("bigint"))
    return log.join(order, "batch").select("file", "metric_name", "metric_value")


@query(
    "stream_window_estimates",
    f"""SELECT TIMESTAMP '2024-01-01 00:00:00' + to_seconds(s) AS window_start,
          TIMESTAMP '2024-01-01 00:00:00' + to_seconds(s + 3600) AS window_end, count(*) AS events,
          count(DISTINCT subject_id) AS patients, {sinks.SKETCH_ERROR!r}::DOUBLE AS error
        FROM (SELECT subject_id, (sec // 600 - k) * 600 AS s FROM v_delivered, (SELECT unnest(range(6)) AS k)) GROUP BY s""",
)
def _(spark, sf):
    return sinks.window_estimates(spark, _stats(spark, sf))


@query(
    "stream_reservoir",
    """SELECT arrival, subject_id, event_type, value FROM fx_live
       ORDER BY ('0x' || substr(md5('42:' || arrival), 1, 13))::BIGINT, arrival LIMIT 100""",
)
def _(spark, sf):
    path = work_dir(spark, "sample")
    events = _stream(spark, sf).select("arrival", "subject_id", "event_type", "value")
    sinks.stream_sample(events, f"{path}/data", f"{path}/checkpoint", 100, "arrival", True).awaitTermination()
    return spark.read.parquet(sinks.latest_version(spark, f"{path}/data"))


@query(
    "stream_patient_state",
    """SELECT subject_id, charttime, event_type, value, arrival, uom, event_count, creatinine, baseline, cr_ratio,
         cr_delta_recent, uo_ml_kg_hr_6h, uo_ml_kg_hr_24h, kdigo_stage, anomaly_score, risk_band
       FROM v_scored_state""",
)
def _(spark, sf):
    unique = operators.stream_dedup(_stream(spark, sf), sketches.EVENT_KEY)
    events = unique.select("subject_id", "charttime", "event_type", "value", "arrival", "uom")
    return sinks.drain(state.stream_patient_state(events), "patient-state")


@query("stream_score", "SELECT row_key, label, true AS same FROM v_test_rows")
def _(spark, sf):
    train, test, columns = models._split_training(spark, sf)
    model = ml.fit_logistic(train, columns, "label")
    path = work_dir(spark, "to-score")
    test.write.parquet(path)
    rows = sources.table_stream_source(spark, path, test.schema, max_files=MAX_FILES)
    streamed = sinks.drain(operators.stream_score(model, rows), "scored")
    return models.same_scores(streamed, ml.score_batch(model, test))


_live_features = ["creatinine", "baseline", "cr_ratio", "cr_delta_recent", "NULL", "NULL", "uo_ml_kg_hr_6h", "NULL", "uo_ml_kg_hr_24h"]
VIEWS["v_event_z"] = f"""
SELECT arrival, [{", ".join(f"(coalesce({c}, 0)::DOUBLE - m{i}) / s{i}" for i, c in enumerate(_live_features))}] AS z
FROM v_scored_state, v_moments"""
VIEWS["v_event_hash"] = " UNION ALL ".join(
    f"SELECT arrival, {t} AS table_id, ({similar_catalog._bucket(m)})::BIGINT AS bucket FROM v_event_z"
    for t, m in enumerate(similarity.projections(similar_catalog.TABLES, similar_catalog.BITS, similar_catalog.D))
)


VIEWS["v_event_twins"] = f"""
SELECT t.arrival, t.rank, t.row_key AS twin_id, t.distance,
       CASE WHEN h.{config.TARGET} = 1 THEN 'Stage 3 AKI' ELSE 'Stable' END AS outcome,
       floor(h.creatinine * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS cr,
       floor(h.urine_output_ml * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS uo
FROM (SELECT *, row_number() OVER (PARTITION BY arrival ORDER BY distance, row_key)::INTEGER AS rank
      FROM (SELECT p.arrival, p.row_key, {similar_catalog._rounded} AS distance
            FROM (SELECT DISTINCT n.arrival, h.row_key FROM v_event_hash n
                  JOIN v_hash h ON n.table_id = h.table_id AND n.bucket = h.bucket) p
            JOIN v_z a ON p.row_key = a.row_key JOIN v_event_z q ON p.arrival = q.arrival)) t
JOIN v_training_set h ON t.row_key = h.row_key WHERE t.rank <= 3"""
SHAPE = {"n_tables": similar_catalog.TABLES, "n_bits": similar_catalog.BITS}


@query("stream_twins", "SELECT * FROM v_event_twins")
def _(spark, sf):
    history = b.training_set(spark, sf)
    # The state after every event, searched against the whole history.
    path = work_dir(spark, "twins")
    states = live.scored(live.live_state(b.live_unique(spark, sf)))
    states.write.parquet(f"{path}/events")
    stream = sources.table_stream_source(spark, f"{path}/events", states.schema, max_files=MAX_FILES)
    twins.stream_twins(
        stream, history, f"{path}/found", f"{path}/checkpoint", available_now=True, **SHAPE
    ).awaitTermination()
    return spark.read.parquet(f"{path}/found").drop("batch")


VIEWS["v_k_tags"] = f"""
SELECT patientunitstayid, CASE WHEN age_group IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY age_group, gender, unittype) END AS n
FROM (SELECT *, {windows.projections.AGE_BAND_SQL} AS age_group FROM fx_patients_raw)"""


def _traces(estimate: str, trailing: str) -> str:
    """Traces, one row per trace and twin; `estimate` and `trailing` have the shared counts of each arrival."""
    half_up = live_catalog._half_up
    return f"""
SELECT s.subject_id::VARCHAR AS patient_id, s.charttime AS "timestamp", s.event_type AS "type", {half_up("s.value", 3)} AS "value",
       s.uom, d.distinct_estimate AS fm_distinct_patients, t.events_1h AS dgim_events_1h, 'k=' || coalesce(g.n, 0) AS k_anonymity,
       s.v0 AS creatinine, s.v1 AS baseline_cr, s.v2 AS cr_ratio, s.v3 AS cr_delta_recent, s.v5 AS uo_ml_kg_hr_6h,
       s.v6 AS uo_ml_kg_hr_24h, {", ".join(f"s.v{i}" for i in range(10))}, s.kdigo_stage, s.anomaly_score,
       w.rank::INTEGER AS rank, w.twin_id, w.outcome, w.distance AS dist, w.cr, w.uo
FROM (SELECT *, {live_catalog._vector("v")} FROM v_scored_state) s
JOIN {estimate} d ON s.arrival = d.arrival JOIN {trailing} t ON s.arrival = t.arrival
LEFT JOIN v_k_tags g ON s.subject_id = g.patientunitstayid LEFT JOIN v_event_twins w ON s.arrival = w.arrival"""


def _flat(back):
    """Traces as read back from their JSON, one row per trace and twin."""
    rows = back.select("*", F.posexplode_outer("twins").alias("at", "twin"))
    return rows.select(
        "patient_id", "timestamp", "record.*", "algorithms.fm_distinct_patients", "algorithms.dgim_events_1h",
        "algorithms.k_anonymity", "features.*", *[F.col("vector")[i].alias(f"v{i}") for i in range(10)], "kdigo_stage",
        "anomaly_score", (F.col("at") + 1).alias("rank"), F.col("twin.id").alias("twin_id"), "twin.outcome", "twin.dist",
        "twin.cr", "twin.uo",
    )


@query("trace_rows", _traces("v_running_distinct", "v_trailing"))
def _(spark, sf):
    traces = live_plan.traced(b.live(spark, sf), fixtures.patients_raw(spark, sf), b.training_set(spark, sf), **SHAPE)
    # Out as JSON text and back in, as a consumer of the sink reads it.
    return _flat(live.trace_json(traces).select(F.from_json("value", traces.schema).alias("t")).select("t.*"))


@query("trace_sink", _traces("v_file_distinct", "v_file_trailing"))
def _(spark, sf):
    # The stream is stopped after every delivery and started again over the same checkpoint.
    path = work_dir(spark, "live")
    delivered = settle(deliveries(spark, sf), "deliveries")
    people = live_plan.sizes_of(fixtures.patients_raw(spark, sf))
    history = b.training_set(spark, sf)
    for file in range(4):
        delivered.filter(F.col("file") == file).drop("file").write.mode("append").parquet(f"{path}/in")
        events = sources.table_stream_source(spark, f"{path}/in", delivered.drop("file").schema)
        stream_live.live_stream(
            events, people, history, f"{path}/out", f"{path}/checkpoint", available_now=True, **SHAPE
        ).awaitTermination()
    return _flat(spark.read.schema(schemas.TRACE).json(f"{path}/out/traces"))


@query(
    "micro_batch_trigger",
    """SELECT subject_id, cause, count(*) AS groups, sum(size)::BIGINT AS events, max(size) AS largest FROM (
         SELECT subject_id, (n - 1) // 10 AS g, count(*) AS size, CASE WHEN count(*) = 10 THEN 'count' ELSE 'time' END AS cause
         FROM (SELECT subject_id, row_number() OVER (PARTITION BY subject_id ORDER BY arrival) AS n FROM fx_live) GROUP BY ALL)
       GROUP BY subject_id, cause""",
)
def _(spark, sf):
    # All events are there at once: full groups are flushed by their count, what is left of a patient by the time.
    live_rows = fixtures.live_events(spark, sf).drop("hadm_id", "stay_id")
    path = work_dir(spark, "trigger")
    live_rows.write.parquet(path)
    stream = sources.table_stream_source(spark, path, live_rows.schema)
    flushed = sinks.drain_timed(buffers.flush_groups(stream, "subject_id", "arrival"), live_rows.count(), "flushed")
    groups = flushed.groupBy("subject_id", "cause", "group_no").agg(F.count(F.lit(1)).alias("size"))
    return groups.groupBy("subject_id", "cause").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("size").alias("events"), F.max("size").alias("largest")
    )


@query("processing_time_trigger", f"SELECT {EVENT} FROM fx_live")
def _(spark, sf):
    # A micro-batch every second, eight files each, until all events are out.
    stream = sources.jsonl_stream_source(spark, _payloads(spark, sf), max_files=8)
    return sinks.drain_timed(stream, fixtures.live_events(spark, sf).count(), "every-second")


TURNS, DELAY = 6, "1 DAY"


@query("timeline_replay", """SELECT *, true AS in_order, true AS after_earlier_batches FROM v_timeline""")
def _(spark, sf):
    # Half-day slices; half of each comes a turn late, in files of any order inside.
    timeline = settle(cohort.hospital_timeline(b.hospital_creatinine(spark, sf), b.hospital_urine(spark, sf)), "timeline")
    closed = sources.with_closing_row(timeline, "subject_id", "event_time", DELAY)
    half_days = F.floor(F.timestamp_diff("SECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("event_time")) / 43200)
    late = F.pmod(F.xxhash64(*timeline.columns), F.lit(2))
    turn = F.when(F.col("closing"), TURNS + 1).otherwise(F.least(F.greatest(half_days, F.lit(0)), F.lit(TURNS - 1)) + late)
    path = work_dir(spark, "timeline")
    sources.write_turns(closed.withColumn("turn", turn), path, "turn", TURNS + 2, files=2)
    replayed = sinks.drain(
        sources.timeline_replay(spark, path, closed.schema, "subject_id", "event_time", DELAY, files_per_batch=2), "replayed"
    )
    own = Window.partitionBy("subject_id").orderBy("position")
    before = F.lag("event_time").over(own)
    earlier = F.max("released_at").over(own.rangeBetween(Window.unboundedPreceding, -1))
    late_rows = (F.col("released_at") > earlier) & (F.unix_millis(F.col("event_time").cast("timestamp")) <= earlier)
    return replayed.withColumns(
        {
            "in_order": F.coalesce(before <= F.col("event_time"), F.lit(True)),
            "after_earlier_batches": ~F.coalesce(late_rows, F.lit(False)),
        }
    ).select(*timeline.columns, "in_order", "after_earlier_batches")


def _delivered(spark, sf):
    """The four deliveries as a stream, one micro-batch each."""
    path = work_dir(spark, "delivered")
    sources.write_turns(settle(deliveries(spark, sf), "deliveries"), path, "file", 4)
    schema = fixtures.live_events(spark, sf).schema
    return sources.with_event_time(sources.table_stream_source(spark, path, schema, max_files=1))


@query(
    "stream_trailing_count",
    """SELECT arrival, count(*) OVER (PARTITION BY event_type ORDER BY event_time
           RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS exact, true AS within_bound
       FROM v_delivered WHERE arrival < 1000000000""",
)
def _(spark, sf):
    # First deliveries only: they come in time order. Events of one second see those that came before them.
    events = _delivered(spark, sf).filter("arrival < 1000000000")
    counted = sinks.drain(stream_sketches.stream_trailing_count(events, "event_type", error=0.1), "histogram")
    plain = b.live(spark, sf).filter("arrival < 1000000000").select("arrival", "event_type", "event_time")
    exact = sketches.trailing_event_count(settle(plain, "exact"), key=["event_type"], out="exact")
    # Within a second the estimate grows event by event, up to the exact count of its end.
    both = exact.join(counted, "arrival")
    at_end = F.max("estimate").over(Window.partitionBy("event_type", "second"))
    return both.select("arrival", "exact", (F.abs(at_end - F.col("exact")) <= F.col("exact") * 0.1).alias("within_bound"))


@query(
    "stream_membership",
    """SELECT count(*) AS events, count(*) FILTER (NOT first) AS repeats, 0::BIGINT AS missed_repeats, true AS within_rate FROM v_firsts""",
)
def _(spark, sf):
    # Copies come up to two days later; the filters look back three.
    answered = sinks.drain(stream_sketches.stream_membership(_delivered(spark, sf), horizon_seconds=3 * DAY, error=0.01), "member")
    key = Window.partitionBy(sketches.event_key()).orderBy("arrival")
    truth = fixtures.live_events(spark, sf).withColumn("repeat", F.row_number().over(key) > 1).select("arrival", "repeat")
    judged = answered.join(truth, "arrival")
    wrong = F.count_if(F.col("maybe_seen") & ~F.col("repeat"))
    return judged.agg(
        F.count(F.lit(1)).alias("events"), F.count_if("repeat").alias("repeats"),
        F.count_if(~F.col("maybe_seen") & F.col("repeat")).alias("missed_repeats"),
        (wrong <= F.lit(0.01) * F.count_if(~F.col("repeat"))).alias("within_rate"),
    )
