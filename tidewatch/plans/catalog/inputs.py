"""Loads, checks, layers and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.plans import bindings as b
from tidewatch.plans import fixtures
from tidewatch.plans.catalog import projections  # noqa: F401
from tidewatch.plans.oracle import VIEWS, hash32
from tidewatch.plans.registry import query
from tidewatch.session import work_dir
from tidewatch.sources import files, layers, metrics, synthetic

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("raw_csv_load", "SELECT *, NULL::VARCHAR AS _corrupt_record FROM fx_labs_raw")
def _(spark, sf):
    labs = fixtures.labs_raw(spark, sf)
    wide = labs.select(
        *[
            (F.col(c) if c in labs.columns else F.lit(None).cast("string")).alias(c)
            for c in schemas.RAW_LABEVENTS.fieldNames()
        ]
    )
    path = work_dir(spark, "raw-labs")
    layers.file_sink(wide, path)
    return files.raw_csv_load(spark, path, schemas.RAW_LABEVENTS).select(*labs.columns, files.CORRUPT)


@query("typed_csv_load", "SELECT patientunitstayid, labname, labresultoffset, labresult FROM fx_lab")
def _(spark, sf):
    path = work_dir(spark, "typed-labs")
    lab = fixtures.lab(spark, sf).select(*schemas.LAB.fieldNames())
    lab.write.option("header", True).option("compression", "gzip").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.typed_csv_load(spark, path, schemas.LAB, partitions=spark.sparkContext.defaultParallelism)


@query("csv_sink", "SELECT patientunitstayid, gender, admissionweight, age FROM fx_patients_raw")
def _(spark, sf):
    path = work_dir(spark, "patients")
    layers.file_sink(fixtures.patients_raw(spark, sf), path)
    people = files.typed_csv_load(spark, path, schemas.PATIENT)
    return people.select("patientunitstayid", "gender", "admissionweight", "age")


@query(
    "required_inputs",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
)
def _(spark, sf):
    files.required_inputs(spark, {t: f"{sf}/{t}.parquet" for t in TABLES})
    return layers.layer_row_counts({t: fixtures.table(spark, sf, t) for t in TABLES})


@query(
    "schema_coverage",
    """SELECT 'labevents' AS table_name, 6 AS required_columns, '' AS missing_columns, true AS complete, count(*) AS row_count FROM fx_labs_raw
       UNION ALL SELECT 'outputevents', 7, '', true, count(*) FROM fx_outputs_raw
       UNION ALL SELECT 'admissions', 4, 'dischtime', false, count(*) FROM fx_admissions_raw""",
)
def _(spark, sf):
    tables = {
        "labevents": fixtures.labs_raw(spark, sf),
        "outputevents": fixtures.outputs_raw(spark, sf),
        "admissions": fixtures.admissions_raw(spark, sf).drop("dischtime"),
    }
    return files.schema_coverage(tables).join(layers.layer_row_counts(tables), "table_name")


@query("bronze_ingest", "SELECT event_id, 'events.parquet' AS source_file, 'batch-1' AS batch_id, true AS stamped FROM events")
def _(spark, sf):
    rows = files.bronze_ingest(fixtures.table(spark, sf, "events"), "batch-1")
    return rows.select(
        "event_id",
        F.regexp_extract("source_file", "([^/]+)$", 1).alias("source_file"),
        "batch_id",
        F.col("ingest_ts").isNotNull().alias("stamped"),
    )


def layer_database(spark, layer):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{work_dir(spark, layer)}'")


@query("layer_write", "SELECT * FROM v_creat")
def _(spark, sf):
    layer_database(spark, "silver")
    layers.layer_write(b.warehouse(spark, sf).creatinine, "silver", "creatinine_events")
    return layers.layer_read(spark, "silver", "creatinine_events")


@query("layer_read", "SELECT * FROM v_urine")
def _(spark, sf):
    layer_database(spark, "silver")
    layers.layer_write(b.warehouse(spark, sf).urine, "silver", "urine_output_events")
    return layers.layer_read(spark, "silver", "urine_output_events")


@query("materialize", "SELECT stay_id, charttime, kdigo_stage FROM v_hourly")
def _(spark, sf):
    layer_database(spark, "gold")
    w = b.warehouse(spark, sf)
    layers.materialize(w.labs, "staging", "stg_labevents_creatinine")
    return layers.materialize(w.stages.select("stay_id", "charttime", "kdigo_stage"), "gold", "gold_kdigo_hourly")


VIEWS["v_draws"] = f"""
SELECT event_id AS id, u_kind > 0.5 AS is_cr, 9000000 + p % 100 AS subject_id,
       sqrt(-2 * ln(g1)) * cos(2 * pi() * g2) AS z, shift,
       sum(1 + st % 15) OVER (ORDER BY event_id) - (1 + st % 15) AS minutes
FROM (SELECT event_id, {", ".join(
    f"({hash32(repr(f'42:{n}:') + ' || event_id')} + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS {a}"
    for n, a in (("kind", "u_kind"), ("g1", "g1"), ("g2", "g2"), ("shift", "shift")))},
    {hash32("'42:p:' || event_id")} AS p, {hash32("'42:step:' || event_id")} AS st FROM events)"""


@query(
    "synthetic_events",
    """SELECT id, subject_id, subject_id * 10 AS hadm_id, subject_id * 100 AS stay_id,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(minutes::BIGINT), '%Y-%m-%d %H:%M:%S') AS charttime,
         CASE WHEN is_cr THEN 'creatinine' ELSE 'urine' END AS event_type,
         CASE WHEN is_cr THEN greatest(0.2::DOUBLE, floor((1.2::DOUBLE + 0.4::DOUBLE * z
                + CASE WHEN subject_id % 5 = 0 THEN 1.0::DOUBLE + 2.5::DOUBLE * shift ELSE 0 END) * 100.0 + 0.5) / 100.0::DOUBLE)
              ELSE greatest(0.0::DOUBLE, floor((60.0::DOUBLE + 25.0::DOUBLE * z
                - CASE WHEN subject_id % 5 = 0 THEN 10.0::DOUBLE + 20.0::DOUBLE * shift ELSE 0 END) * 100.0 + 0.5) / 100.0::DOUBLE)
         END AS value,
         CASE WHEN is_cr THEN 'mg/dL' ELSE 'mL' END AS uom FROM v_draws""",
)
def _(spark, sf):
    # As many events as the events table has, one per id.
    ids = fixtures.table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return synthetic.synthetic_events(ids)


@query(
    "metric_log_sink",
    """SELECT metric_name, count(*) AS n, round(avg(metric_value), 2) AS avg_value FROM (
         SELECT unnest(['events', 'mean_value']) AS metric_name, unnest([n, m]) AS metric_value
         FROM (SELECT user_id, count(*)::DOUBLE AS n, avg(value) AS m FROM events GROUP BY user_id)) GROUP BY 1""",
)
def _(spark, sf):
    from tidewatch.operators.quality import metric_rollup

    path = work_dir(spark, "metrics")
    stats = fixtures.table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("m")
    )
    extra = F.to_json(F.struct("user_id"))
    metrics.append_metrics(
        metrics.metric_rows(stats, {"events": F.col("n"), "mean_value": F.col("m")}, extra), path
    )
    return metric_rollup(spark.read.schema(schemas.METRIC_LOG).parquet(path))


@query(
    "offset_hourly",
    "SELECT * FROM v_offset_hourly",
)
def _(spark, sf):
    return b.offset_hourly(spark, sf)

