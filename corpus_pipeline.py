"""The corpus pipeline: documents in, token ids of the clean ones out.

Every stage reads what the one before wrote. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, classifier, decontam, lines, simhash
from tidewatch.sources.layers import settle


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, accepts; all columns unchanged.

    Null and empty texts are scored like any other without words; repeated rows stay or go together; an empty table
    stays empty, and without labels of both kinds every score is 0.5.
    """
    return classifier.score(docs, classifier.fit(docs, _table(spark, sf_dir, "labels")), keep=True)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that stand, or nearly stand, earlier; n_chars follows the text.

    A null text stays null; repeated rows stay, and lose the same lines; an empty table stays empty.
    """
    done = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col(done.columns[-1]) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles are linked at four bits or fewer.

    That of the smallest id stays, all columns unchanged, see `simhash.deduplicate`.
    """
    return simhash.deduplicate(docs, shingle=4, budget=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item, see `decontam.clean`."""
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digests of the ids and of what they decode to; null texts have no ids."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip_digests(bpe.encode(docs, vocabulary), vocabulary, keep_ids=True)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", encoding),
]

#: No SQL states a trained classifier or a byte-pair encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
