"""The live path: state, vectors, traces, boards, sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import live, sketches
from tidewatch.plans import bindings as b
from tidewatch.plans import fixtures
from tidewatch.plans.catalog import windows  # noqa: F401
from tidewatch.plans.oracle import VIEWS
from tidewatch.plans.registry import query


def _half_up(x: str, digits: int) -> str:
    scale = f"{float(10**digits)!r}::DOUBLE"
    return f"(floor(({x}) * {scale} + 0.5::DOUBLE) / {scale})"


def _rate(hours: int, reference: bool) -> str:
    total = f"list_sum(h[-{hours}:])"
    if reference:
        total = _half_up(f"{total} / len(h[-{hours}:])", 2)
    return _half_up(f"{total} / (70.0::DOUBLE * {hours})", 3)


VIEWS["v_history"] = """
SELECT *, list(value) OVER (PARTITION BY subject_id, measure ORDER BY event_time, arrival
                            ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS h
FROM (SELECT * REPLACE (coalesce(value, 0.0) AS value),
             CASE WHEN event_type = 'creatinine' THEN 'creatinine'
                     WHEN event_type IN ('urine', 'urine_output') THEN 'urine' ELSE 'other' END AS measure
      FROM v_unique)"""
VIEWS["v_history_state"] = f"""
SELECT *, CASE WHEN measure = 'creatinine' THEN h[-1] END AS c_now,
       CASE WHEN measure = 'creatinine' THEN list_aggregate(h[1:3], 'median') END AS c_base,
       CASE WHEN measure = 'creatinine' THEN CASE WHEN len(h) >= 2 THEN {_half_up("h[-1] - h[-2]", 3)} ELSE 0.0 END END AS c_delta,
       CASE WHEN measure = 'urine' THEN {_rate(6, False)} END AS u6,
       CASE WHEN measure = 'urine' THEN {_rate(24, False)} END AS u24,
       CASE WHEN measure = 'urine' THEN {_rate(6, True)} END AS r6,
       CASE WHEN measure = 'urine' THEN {_rate(24, True)} END AS r24
FROM v_history"""


def _state(u6: str, u24: str) -> str:
    w = "OVER (PARTITION BY subject_id ORDER BY event_time, arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
SELECT subject_id, charttime, event_type, value, arrival, hadm_id, stay_id, uom, event_time, event_count,
       creatinine, baseline, CASE WHEN baseline <> 0 THEN {_half_up("creatinine / baseline", 3)} END AS cr_ratio,
       coalesce(cr_delta_recent, 0.0)::DOUBLE AS cr_delta_recent, uo_ml_kg_hr_6h, uo_ml_kg_hr_24h
FROM (SELECT *, count(*) {w} AS event_count, last_value(c_now IGNORE NULLS) {w} AS creatinine,
             last_value(c_base IGNORE NULLS) {w} AS baseline, last_value(c_delta IGNORE NULLS) {w} AS cr_delta_recent,
             last_value({u6} IGNORE NULLS) {w} AS uo_ml_kg_hr_6h, last_value({u24} IGNORE NULLS) {w} AS uo_ml_kg_hr_24h
      FROM v_history_state)"""


VIEWS["v_state"] = _state("u6", "u24")
VIEWS["v_state_reference"] = _state("r6", "r24")
VIEWS["v_scored_state"] = """
SELECT *, CASE WHEN anomaly_score >= 60 THEN 'high' WHEN anomaly_score >= 30 THEN 'medium' ELSE 'low' END AS risk_band
FROM (SELECT *, greatest(CASE WHEN cr_ratio >= 3 THEN 3 WHEN cr_ratio >= 2 THEN 2 WHEN cr_ratio >= 1.5 THEN 1 ELSE 0 END,
        CASE WHEN uo_ml_kg_hr_6h < 0.3 THEN 3 WHEN uo_ml_kg_hr_6h < 0.5 THEN 2 ELSE 0 END) AS kdigo_stage,
        least(round(coalesce(least(cr_ratio * 20, 50.0), 0)
   + CASE WHEN cr_delta_recent > 0.3 THEN 15.0 WHEN cr_delta_recent > 0.1 THEN 8.0 ELSE 0.0 END
   + CASE WHEN uo_ml_kg_hr_6h < 0.3 THEN 30.0 WHEN uo_ml_kg_hr_6h < 0.5 THEN 15.0 ELSE 0.0 END, 1), 100.0)::DOUBLE
     AS anomaly_score FROM v_state)"""


@query("live_state", "SELECT * FROM v_state")
def _(spark, sf):
    return live.live_state(b.live_unique(spark, sf))


@query("live_state_reference_rate", "SELECT * FROM v_state_reference")
def _(spark, sf):
    return live.live_state(b.live_unique(spark, sf), rate="reference")


@query("live_scored", "SELECT * FROM v_scored_state")
def _(spark, sf):
    return live.scored(live.live_state(b.live_unique(spark, sf)))


def _vector(prefix: str) -> str:
    parts = [
        _half_up("coalesce(nullif(creatinine, 0), 0.0)", 3),
        _half_up("coalesce(nullif(baseline, 0), 1.0)", 3),
        _half_up("coalesce(nullif(cr_ratio, 0), 1.0)", 3),
        _half_up("cr_delta_recent", 3),
        _half_up("cr_delta_recent * 0.5", 3),
        _half_up("coalesce(nullif(uo_ml_kg_hr_6h, 0), 0.0)", 3),
        _half_up("coalesce(nullif(uo_ml_kg_hr_24h, 0), 0.0)", 3),
        "65.0::DOUBLE", "1.0::DOUBLE", "0.0::DOUBLE",
    ]
    return ", ".join(f"{p} AS {prefix}{i}" for i, p in enumerate(parts))


@query("live_feature_vector", f"SELECT arrival, {_vector('v')} FROM v_state")
def _(spark, sf):
    state = live.live_state(b.live_unique(spark, sf))
    vector = state.select("arrival", live.live_feature_vector().alias("v"))
    return vector.select("arrival", *[F.col("v")[i].alias(f"v{i}") for i in range(10)])


@query(
    "patient_board",
    """SELECT subject_id, n AS events, kdigo_stage, anomaly_score, event_type AS last_type, value AS last_value
       FROM (SELECT *, count(*) OVER (PARTITION BY subject_id) AS n,
                    row_number() OVER (PARTITION BY subject_id ORDER BY event_time DESC, arrival DESC) AS r
             FROM v_scored_state) WHERE r = 1 ORDER BY anomaly_score DESC, subject_id""",
)
def _(spark, sf):
    return live.patient_board(live.scored(live.live_state(b.live_unique(spark, sf))))


@query(
    "latest_per_key",
    """SELECT subject_id, arrival, charttime, event_type, value FROM fx_live
       QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY charttime DESC, arrival DESC) = 1""",
)
def _(spark, sf):
    rows = fixtures.live_events(spark, sf).select("subject_id", "arrival", "charttime", "event_type", "value")
    return sketches.latest_per_key(rows, "subject_id", ["charttime", "arrival"])


@query(
    "last_n_per_key",
    """SELECT subject_id, arrival, charttime, event_type, value,
         row_number() OVER (PARTITION BY subject_id ORDER BY charttime DESC, arrival DESC)::INTEGER AS recency
       FROM fx_live QUALIFY recency <= 10""",
)
def _(spark, sf):
    rows = fixtures.live_events(spark, sf).select("subject_id", "arrival", "charttime", "event_type", "value")
    return sketches.last_n_per_key(rows, "subject_id", ["charttime", "arrival"], 10)


@query("latest_n", "SELECT event_id, ts, value FROM events WHERE event_type = 'view' ORDER BY ts DESC, event_id DESC LIMIT 100")
def _(spark, sf):
    rows = fixtures.table(spark, sf, "events").filter(F.col("event_type") == "view").select("event_id", "ts", "value")
    return sketches.latest_n(rows, 100, "ts", "event_id")


SLIDING = """
SELECT TIMESTAMP '2024-01-01 00:00:00' + to_seconds(s) AS window_start,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(s + 3600) AS window_end, count(*) AS events
FROM (SELECT (sec // 600 - k) * 600 AS s FROM
       (SELECT epoch_us(charttime::TIMESTAMP) // 1000000 - 1704067200 AS sec FROM {0}), (SELECT unnest(range(6)) AS k))
GROUP BY s"""


@query("sliding_counts", SLIDING.format("fx_live"))
def _(spark, sf):
    return sketches.sliding_counts(b.live(spark, sf), "event_time")


ERROR_RATE = 0.01
PER_KEY, HASHES = sketches.bloom_shape(ERROR_RATE)
_bits = f"(SELECT greatest(1, count(*)) * {PER_KEY} FROM v_seen_keys)"
_spots = " UNION ALL ".join(
    f"SELECT key, ('0x' || substr(md5({repr(str(i) + ':')} || key), 1, 13))::BIGINT % {_bits} AS p FROM {{0}}"
    for i in range(HASHES)
)
_key = "concat_ws('|', subject_id::VARCHAR, charttime, event_type, coalesce(round(value * 1000)::BIGINT::VARCHAR, '~'))"
VIEWS["v_seen_keys"] = f"SELECT DISTINCT {_key} AS key FROM fx_live WHERE event_type = 'creatinine'"
VIEWS["v_probe_keys"] = f"SELECT DISTINCT {_key} AS key FROM fx_live"


VIEWS["v_answers"] = f"""
SELECT key, bool_and(p IN (SELECT p FROM ({_spots.format("v_seen_keys")}))) AS maybe_seen
FROM ({_spots.format("v_probe_keys")}) GROUP BY key"""


@query("bloom_membership", "SELECT * FROM v_answers")
def _(spark, sf):
    keyed = fixtures.live_events(spark, sf).select("event_type", sketches.event_key().alias("key"))
    seen = keyed.filter(F.col("event_type") == "creatinine").select("key").distinct()
    bits = sketches.bloom_bits(seen.count(), ERROR_RATE)
    return sketches.bloom_membership(keyed, sketches.bloom_build(seen, "key", bits, HASHES), "key", bits, HASHES)


@query(
    "bloom_error_rate",
    """SELECT count(*) AS probes, count(*) FILTER (WHERE maybe_seen AND key NOT IN (SELECT key FROM v_seen_keys)) AS false_positives,
         count(*) FILTER (WHERE NOT maybe_seen AND key IN (SELECT key FROM v_seen_keys)) AS false_negatives FROM v_answers""",
)
def _(spark, sf):
    keyed = fixtures.live_events(spark, sf).select("event_type", sketches.event_key().alias("key"))
    seen = keyed.filter(F.col("event_type") == "creatinine").select("key").distinct()
    bits = sketches.bloom_bits(seen.count(), ERROR_RATE)
    answers = sketches.bloom_membership(keyed, sketches.bloom_build(seen, "key", bits, HASHES), "key", bits, HASHES)
    judged = answers.join(seen.withColumn("truth", F.lit(True)), "key", "left")
    truth = F.coalesce("truth", F.lit(False))
    return judged.agg(
        F.count(F.lit(1)).alias("probes"),
        F.count_if(F.col("maybe_seen") & ~truth).alias("false_positives"),
        F.count_if(~F.col("maybe_seen") & truth).alias("false_negatives"),
    )
