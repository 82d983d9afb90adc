"""Each pipeline stage on what the one before kept, against brute force."""

import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import brute
from tidewatch.llm import classifier
from tidewatch.llm.features import document_features
from tidewatch.sources.layers import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    rows = {r["doc_id"]: r for r in df.collect()}
    assert df.count() == len(rows)
    return rows


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and what comes out."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        out = settle(stage(spark, docs, SMALL), name)
        found[name] = (docs, out)
        docs = out
    return found


def texts(df):
    return {i: r["text"] or "" for i, r in rows_of(df).items()}


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe",
    ]


def test_quality(spark, stages):
    before, after = stages["quality_classifier"]
    assert after.columns == COLUMNS
    model = classifier.fit(before, spark.read.parquet(f"{SMALL}/labels.parquet"))

    def score(text):
        buckets, counts = document_features(text.encode().split(), model.bits, False)
        return float(model.scores((model.projection[buckets] * counts).sum(), counts.sum()))

    scores = {i: score(t) for i, t in texts(before).items()}
    assert not any(abs(s - 0.7) < 1e-4 for s in scores.values())
    assert set(texts(after)) == {i for i, s in scores.items() if s >= 0.7}


def test_lines(stages):
    before, after = stages["line_dedup"]
    assert after.columns == COLUMNS
    got = rows_of(after)
    want = brute.lines(texts(before))
    assert {i: r["text"] for i, r in got.items()} == {i: kept for i, (_, _, kept) in want.items()}
    assert all(got[i]["n_chars"] == len(kept) for i, (_, gone, kept) in want.items() if gone)


def test_near_dedup(stages):
    before, after = stages["simhash_near_dedup"]
    assert after.columns == COLUMNS
    own = texts(before)
    assert set(texts(after)) == set(brute.components(own).values())


def test_decontamination(spark, stages):
    before, after = stages["benchmark_decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = brute.contamination(texts(before), items)
    assert after.columns == COLUMNS
    assert set(texts(after)) == {i for i, w in want.items() if not w[1]}


def test_encoding(stages):
    before, after = stages["byte_bpe"]
    own = texts(before)
    want = brute.encoded(own)
    assert {i: r["ids"] for i, r in rows_of(after).items()} == want
    assert {i: r["decoded_sha256"] for i, r in rows_of(after).items()} == {i: brute.sha(t.encode()) for i, t in own.items()}


def test_run_equals_the_stages(spark, stages):
    got = rows_of(corpus_pipeline.run(spark, SMALL))
    assert {i: r["ids_sha256"] for i, r in got.items()} == {
        i: r["ids_sha256"] for i, r in rows_of(stages["byte_bpe"][1]).items()
    }
