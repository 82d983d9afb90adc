"""Registered queries of this package: thin calls of its operators on the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import align, bpe, classifier, decontam, exact, grammar, hard_negatives, lines, rules, secrets, simhash, substrings, token_count
from tidewatch.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


@query("op1_token_counts")
def _(spark, sf):
    return token_count.token_counts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_bpe_round_trip")
def _(spark, sf):
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip_digests(bpe.encode(table(spark, sf, "documents"), vocabulary), vocabulary)


@query("op3_substring_dedup")
def _(spark, sf):
    return substrings.digest(substrings.dedup_substrings(table(spark, sf, "documents")))


@query("op4_line_dedup")
def _(spark, sf):
    return lines.digest(lines.dedup_lines(table(spark, sf, "documents")))


@query("op5_simhash")
def _(spark, sf):
    grouped = simhash.near_duplicates(table(spark, sf, "documents"), shingle=4, budget=4)
    return grouped.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


@query("op6_token_shards")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return grammar.digest(grammar.round_trip(docs, public_tokenizers.path("word_bpe_49k.json")))


@query("op7_quality_classifier")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return classifier.score(docs, classifier.fit(docs, table(spark, sf, "labels")))


@query("op8_quality_rules")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return rules.apply(docs, rules.fit(docs, table(spark, sf, "labels")))


@query("op9_decontamination")
def _(spark, sf):
    return decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op10_secret_scan")
def _(spark, sf):
    return secrets.digest(secrets.scan(table(spark, sf, "documents")))


@query("op11_token_alignment")
def _(spark, sf):
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align(table(spark, sf, "documents"), *files)


@query("op12_hard_negatives")
def _(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings").withColumn("label", moved))


@query("op13_exact_dedup")
def _(spark, sf):
    return exact.groups(table(spark, sf, "documents"), keep="largest")
