"""Quality classifier: supervised subword embeddings in the manner of public text classifiers.

A document is the average of learned vectors, one per hashed word and character n-gram; a softmax
layer turns the average into class probabilities. Vectors and layer are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled rows, whose features are
extracted on the executors. Because the layer is linear in the average, scoring needs one number
per bucket: its vector's projection on the difference of the two classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import texts
from tidewatch.llm.features import REPEAT_WEIGHT, WordTable, document_features, near_repeats

#: The documented bound of the training sample, per class.
SAMPLE_PER_CLASS = 1500
BITS = 16
DIM = 16
EPOCHS = 12
BATCH = 32
RATE = 8.0
SEED = 17
THRESHOLD = 0.7
FOLDS = 4
HELD_OUT = 2


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % FOLDS).cast("int")


def training_rows(
    docs: DataFrame, labels: DataFrame, folds: tuple[int, ...], pairs: bool, label_col: str = "quality",
    per_class: int = SAMPLE_PER_CLASS, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(fold, label, buckets, counts) of a sample of at most `per_class` labelled rows per class and fold set.

    The sample takes the smallest id hashes, so it is repeatable and independent of partitions. Rows
    without id, label or document are no examples. Whole texts are used; the driver gets their
    distinct buckets only.
    """
    chosen = None
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & fold(F.col("doc_id")).isin(*folds)).dropDuplicates()
    for label in (0, 1):
        some = known.filter(F.col("label") == label).orderBy(F.xxhash64(F.col("doc_id"), F.lit(SEED)), "doc_id")
        chosen = some.limit(per_class) if chosen is None else chosen.unionByName(some.limit(per_class))
    rows = (
        texts(docs, id_col, text_col)
        .join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class rows
        .select("doc_id", "label", F.col("text").cast("binary").alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_features(t.split(), bits, pairs) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([f[0].tobytes() for f in found], pa.binary()),
                 pa.array([f[1].tobytes() for f in found], pa.binary())],
                names=["doc_id", "label", "buckets", "counts"],
            )

    out = rows.mapInArrow(run, "doc_id long, label int, buckets binary, counts binary")
    got = out.withColumn("fold", fold(F.col("doc_id"))).collect()
    got.sort(key=lambda r: (r["doc_id"], r["label"], r["buckets"]))
    return [
        (r["fold"], r["label"], np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.float32))
        for r in got
    ]


@dataclass
class SubwordModel:
    """`projection` has one number per bucket; the class-1 logit is its average plus `bias`."""

    projection: np.ndarray
    bias: float
    bits: int = BITS

    def scores(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = np.clip(sums / np.maximum(counts, 1) + self.bias, -60, 60)
        return 1 / (1 + np.exp(-z))


def train(rows: list, bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE) -> SubwordModel:
    """Minibatch gradient descent on vectors and softmax layer, classes weighted equally.

    One class alone, or no row at all, gives a model that scores every text 0.5.
    """
    labels = np.array([r[1] for r in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        return SubwordModel(np.zeros(1 << bits), 0.0, bits)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1, 1, (1 << bits, dim)).astype(np.float32) / dim
    layer = np.zeros((dim, 2), np.float32)
    bias = np.zeros(2, np.float32)
    weight = (len(labels) / (2 * np.bincount(labels, minlength=2))).astype(np.float32)
    shares = [r[3] / r[3].sum() for r in rows]
    steps, step = epochs * -(-len(rows) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            lr = rate * (1 - step / steps)
            step += 1
            ids = np.concatenate([rows[i][2] for i in part])
            share = np.concatenate([shares[i] for i in part])
            of = np.repeat(np.arange(len(part)), [len(rows[i][2]) for i in part])
            starts = np.concatenate([[0], np.cumsum([len(rows[i][2]) for i in part])[:-1]])
            hidden = np.add.reduceat(vectors[ids] * share[:, None], starts)
            z = hidden @ layer + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), labels[part]] -= 1
            p *= weight[labels[part]][:, None] / len(part)
            back = p @ layer.T
            layer -= lr * hidden.T @ p
            bias -= lr * 0.1 * p.sum(0)
            np.add.at(vectors, ids, -lr * share[:, None] * back[of])
    return SubwordModel((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]), bits)


def _score_texts(model, table: WordTable, listed: list[bytes], pair_weights: np.ndarray | None = None) -> tuple:
    """Sums of bucket weights and feature counts of each text."""
    from tidewatch.llm.features import pair_buckets

    sums, counts = np.zeros(len(listed)), np.zeros(len(listed))
    for i, text in enumerate(listed):
        words = text.split()
        if not words:
            sums[i], counts[i] = table.weights[0], 1
            continue
        a = table.numbers(words)
        sums[i], counts[i] = table.sums[a].sum(), table.counts[a].sum()
        repeated = int(near_repeats(a).sum())
        sums[i] += REPEAT_WEIGHT * repeated * table.weights[1]
        counts[i] += REPEAT_WEIGHT * repeated
        if pair_weights is not None and len(a) > 1:
            sums[i] += pair_weights[pair_buckets(table.hashes[a], table.bits)].sum()
            counts[i] += len(a) - 1
    return sums, counts


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> SubwordModel:
    """Train on labelled rows outside the held-out fold."""
    folds = tuple(f for f in range(FOLDS) if f != HELD_OUT)
    return train(training_rows(docs, labels, folds, False, label_col, per_class, id_col, text_col))


def score(
    docs: DataFrame, model: SubwordModel, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
    keep: bool = False,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; one row out per row in, without a shuffle.

    Only the text enters a score. Empty and null texts get the learned score of the empty marker;
    a null id is never held out; repeated rows score alike; an empty table gives no rows. With
    `keep` the input's columns come back instead, and only rows with predicted 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    if keep:
        texts(docs, id_col, text_col)  # sets the batch size

        @F.pandas_udf("double")
        def score_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = shared.value
            table = WordTable(own.projection, own.bits)
            for part in parts:
                yield pd.Series(own.scores(*_score_texts(own, table, [bytes(t) for t in part])))

        text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
        return docs.filter(score_of(text) >= threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = WordTable(own.projection, own.bits)
        for batch in batches:
            scores = own.scores(*_score_texts(own, table, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
