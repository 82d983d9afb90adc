"""Columns named like the operators' own, and the pipeline's stages on nulls, repeats, clashes and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tidewatch.llm import decontam, lines, simhash
from tidewatch.sources.layers import settle

CLASHING = ["_n_lines", "_n_removed", "_own_key", "_kept_key", "_found_key", "_text", "_others", "_block", "key", "decoded", "score", "place"]


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    odd = own.limit(1).withColumn("doc_id", F.lit(900_000).cast("long"))
    rows = own.unionByName(own.limit(5)).unionByName(odd.withColumn("text", F.lit(None).cast("string")))
    rows = rows.unionByName(odd.withColumn("text", F.lit("")).withColumn("doc_id", F.lit(None).cast("long")))
    return settle(rows.withColumns({c: F.lit("x") for c in CLASHING}), "clashing")


def test_stages_keep_clashing_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = settle(stage(spark, docs, SMALL), name)
        assert done.columns == docs.columns, name
        assert {r[c] for r in done.select(*CLASHING).distinct().collect() for c in CLASHING} <= {"x"}, name
        assert 0 < done.count() <= docs.count(), name
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert encoded.count() == docs.count() and encoded.filter("n_tokens = 0").count() == 2


def test_stages_of_an_empty_table(spark, docs):
    empty = settle(docs.filter("doc_id = -1"), "empty")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0, name


def test_operators_beside_clashing_columns(spark, docs):
    done = lines.dedup_lines(docs)
    assert done.columns == [*docs.columns, "_n_lines_", "_n_removed_"]
    assert lines.digest(done).columns == ["doc_id", "n_lines", "n_removed", "kept_sha256"]
    assert lines.digest(done).filter("doc_id = 900000").first()["n_lines"] == 0
    assert simhash.deduplicate(docs).columns == docs.columns
    items = spark.createDataFrame([(1, "nothing of that kind")], "item_id long, text string")
    assert decontam.clean(docs, items).count() == docs.count()
