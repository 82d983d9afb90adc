"""Similar-patient search over the training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators import similarity
from tidewatch.plans import bindings as b
from tidewatch.plans.catalog import windows  # noqa: F401
from tidewatch.plans.oracle import VIEWS
from tidewatch.plans.registry import query
from tidewatch.sources.layers import settle

TABLES, BITS, EXAMPLES, K = 3, 6, 1, 5
D = len(config.FEATURES)

_filled = ", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in config.FEATURES)
_moments = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) + 1e-9::DOUBLE AS s{i}" for i, c in enumerate(config.FEATURES))
_z = ", ".join(f"({c} - m{i}) / s{i}" for i, c in enumerate(config.FEATURES))

VIEWS["v_filled"] = f"SELECT row_key, {_filled} FROM v_training_set"
VIEWS["v_moments"] = f"SELECT {_moments} FROM v_filled"
VIEWS["v_z"] = f"SELECT row_key, [{_z}] AS z FROM v_filled, v_moments"


def _bucket(matrix) -> str:
    bits = []
    for i, row in enumerate(matrix):
        terms = " + ".join(f"z[{j + 1}] * ({float(w)!r})::DOUBLE" for j, w in enumerate(row))
        bits.append(f"CASE WHEN {terms} >= 0 THEN {1 << i} ELSE 0 END")
    return " + ".join(bits)


VIEWS["v_hash"] = " UNION ALL ".join(
    f"SELECT row_key, z, {t} AS table_id, ({_bucket(m)})::BIGINT AS bucket FROM v_z"
    for t, m in enumerate(similarity.projections(TABLES, BITS, D))
)
VIEWS["v_examples"] = f"""
SELECT row_key AS query_id FROM v_training_set ORDER BY {config.TARGET} DESC, row_key LIMIT {EXAMPLES}"""
VIEWS["v_probe"] = "SELECT h.row_key AS query_id, h.z AS q_z, h.table_id, h.bucket FROM v_hash h JOIN v_examples e ON h.row_key = e.query_id"
VIEWS["v_pairs"] = """
SELECT DISTINCT p.query_id, h.row_key FROM v_probe p JOIN v_hash h ON p.table_id = h.table_id AND p.bucket = h.bucket"""
_distance = " + ".join(f"(a.z[{i}] - q.z[{i}]) * (a.z[{i}] - q.z[{i}])" for i in range(1, D + 1))
_rounded = f"floor(sqrt({_distance}) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE"


def nearest(pairs: str) -> str:
    return f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, row_key)::INTEGER AS rank
  FROM (SELECT p.query_id, p.row_key, {_rounded} AS distance
        FROM {pairs} p JOIN v_z a ON p.row_key = a.row_key JOIN v_z q ON p.query_id = q.row_key))
WHERE rank <= {K}"""


VIEWS["v_twins"] = nearest("v_pairs")


def _shape():
    return {"n_tables": TABLES, "n_bits": BITS}


def _examples(rows):
    return similarity.progression_examples(rows, "row_key", n=EXAMPLES)


@query(
    "standardize_features",
    "SELECT row_key, " + ", ".join(f"round(z[{i + 1}], 6) AS z{i}" for i in range(D)) + " FROM v_z",
)
def _(spark, sf):
    z = similarity.standardize_features(b.training_set(spark, sf))
    return z.select("row_key", *[F.round(F.col("z")[i], 6).alias(f"z{i}") for i in range(D)])


@query("lsh_hash", "SELECT row_key, table_id, bucket FROM v_hash")
def _(spark, sf):
    z = similarity.standardize_features(b.training_set(spark, sf))
    return similarity.lsh_hash(z, **_shape()).select("row_key", "table_id", "bucket")


@query("lsh_bucket_join", "SELECT * FROM v_pairs")
def _(spark, sf):
    rows = b.training_set(spark, sf)
    index = similarity.lsh_hash(similarity.standardize_features(rows), **_shape())
    moments = similarity.feature_moments(rows)
    probes = similarity.lsh_hash(
        similarity.standardize_features(_examples(rows), moments=moments), out="q_buckets", **_shape()
    ).select(F.col("row_key").alias("query_id"), "q_buckets", "table_id", "bucket")
    return similarity.lsh_bucket_join(
        probes, index.select("row_key", "buckets", "table_id", "bucket"), "row_key"
    ).select("query_id", "row_key")


def _twins(rows):
    return similarity.lsh_similar(_examples(rows), rows, "row_key", k=K, **_shape())


@query("lsh_similar", "SELECT * FROM v_twins")
def _(spark, sf):
    return _twins(b.training_set(spark, sf))


@query(
    "exact_similar",
    nearest("(SELECT e.query_id, z.row_key FROM v_examples e, v_z z)"),
)
def _(spark, sf):
    rows = b.training_set(spark, sf)
    return similarity.exact_similar(_examples(rows), rows, "row_key", k=K)


@query("progression_examples", "SELECT * FROM v_training_set WHERE row_key IN (SELECT query_id FROM v_examples)")
def _(spark, sf):
    return _examples(b.training_set(spark, sf))


@query(
    "topk_similar",
    f"""SELECT event_type, event_id, value, rank FROM (
          SELECT event_type, event_id, value,
                 row_number() OVER (PARTITION BY event_type ORDER BY value, event_id)::INTEGER AS rank FROM events)
        WHERE rank <= {K}""",
)
def _(spark, sf):
    from tidewatch.plans import fixtures

    rows = fixtures.table(spark, sf, "events").select("event_type", "event_id", "value")
    return similarity.topk_similar(rows, "event_type", "event_id", K, distance="value")


def _shown(x: str) -> str:
    return f"coalesce(printf('%.2f', {x}::DOUBLE), 'nan')"


_summary = " || ', ' || ".join(
    f"'{c}: ' || {_shown('t.' + c)} || ' (vs query ' || {_shown('q.' + c)} || ')'"
    for c in ("creatinine", "urine_output_ml", "kdigo_stage")
)


@query(
    "twin_explanation",
    f"""SELECT w.query_id, w.row_key AS twin_id, w.rank, {_summary} AS summary,
          CASE WHEN t.{config.TARGET} = 1 THEN 'AKI Stage 3' ELSE 'No Progress' END AS outcome
        FROM v_twins w JOIN v_training_set t ON w.row_key = t.row_key JOIN v_training_set q ON w.query_id = q.row_key""",
)
def _(spark, sf):
    rows = b.training_set(spark, sf)
    return similarity.twin_explanation(_twins(rows), _examples(rows), rows, "row_key")


def recall_sample(rows, n=100):
    """So many rows to ask for, by the hash of their key."""
    return rows.orderBy(F.md5("row_key"), "row_key").limit(n)


@query("multi_probe_recall")
def _(spark, sf):
    # What the multi-probe search finds of the exact results of 100 rows, and how many rows it looked at.
    rows = b.training_set(spark, sf)
    asked = settle(recall_sample(rows), "asked")
    found = settle(similarity.multi_probe_similar(asked, rows, "row_key", k=K), "found")
    exact = similarity.exact_similar(asked, rows, "row_key", k=K)
    looked = found.agg(F.round(F.avg("candidates"), 1)).scalar()
    return similarity.recall_against(found, exact).withColumn("candidates", looked)
