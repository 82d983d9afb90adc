"""Quality rules: exact text counts, and a calibrated linear model against fixed thresholds.

The model is a logistic regression on hashed word, word-pair and character n-gram features, each
divided by the document's feature count. Its output is calibrated on labelled rows that the
regression did not see, so that the fixed threshold means a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.classifier import HELD_OUT, SAMPLE_PER_CLASS, _score_texts, training_rows
from tidewatch.llm.common import texts
from tidewatch.llm.features import WordTable

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30

BITS = 16
KEEP_AT = 0.5
TRAIN_FOLDS, CALIBRATION_FOLDS = (0, 1), (3,)
EPOCHS, BATCH, RATE, DECAY = 12, 32, 0.5, 1e-7


@dataclass
class RulesModel:
    """P(quality 1) = 1 / (1 + exp(-(slope * logit + offset))), logit the mean weight times `scale` plus bias."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    bits: int = BITS

    def probability(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = self.slope * (sums / np.maximum(counts, 1) + self.bias) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _rows_logits(rows: list, weights: np.ndarray, bias: float) -> np.ndarray:
    return np.array([(weights[r[2]] * r[3]).sum() / r[3].sum() + bias for r in rows])


def _platt(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps on smoothed targets."""
    pos, neg = int(labels.sum()), int((1 - labels).sum())
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([logits, np.ones(len(logits))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        gradient = x.T @ (p - target) + 1e-3 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        change = np.linalg.solve(hessian, gradient)
        w -= np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(rows: list, bits: int = BITS, epochs: int = EPOCHS) -> RulesModel:
    """Logistic regression by adaptive gradient steps, then calibration on the other folds.

    Without both classes among the rows the model gives 0.5 to every text.
    """
    own = [r for r in rows if r[0] in TRAIN_FOLDS]
    labels = np.array([r[1] for r in own], np.float64)
    weights, squares, bias = np.zeros(1 << bits), np.full(1 << bits, 1e-12), 0.0
    if len(set(labels.tolist())) < 2:
        return RulesModel(weights, 0.0, 1.0, 0.0, bits)
    share = np.where(labels == 1, len(labels) / (2 * labels.sum()), len(labels) / (2 * (1 - labels).sum()))
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        order = rng.permutation(len(own))
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            ids = np.concatenate([own[i][2] for i in part])
            x = np.concatenate([own[i][3] / own[i][3].sum() for i in part])
            sizes = [len(own[i][2]) for i in part]
            of = np.repeat(np.arange(len(part)), sizes)
            z = np.bincount(of, weights[ids] * x, len(part)) + bias
            error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[part]) * share[part] / len(part)
            found, inverse = np.unique(ids, return_inverse=True)
            gradient = np.bincount(inverse, x * error[of]) + DECAY * weights[found]
            squares[found] += gradient**2
            weights[found] -= RATE * gradient / np.sqrt(squares[found])
            bias -= 0.01 * error.sum()
    held = [r for r in rows if r[0] in CALIBRATION_FOLDS] or own
    slope, offset = _platt(_rows_logits(held, weights, bias), np.array([r[1] for r in held]))
    return RulesModel(weights, bias, slope, offset, bits)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> RulesModel:
    """Train and calibrate on a bounded sample of labelled rows; the held-out fold is never used."""
    assert HELD_OUT not in TRAIN_FOLDS + CALIBRATION_FOLDS
    return train(
        training_rows(docs, labels, TRAIN_FOLDS + CALIBRATION_FOLDS, True, label_col, per_class, id_col, text_col, BITS)
    )


def repeated_window_words(words: list, size: int = WINDOW) -> int:
    """Words inside windows of `size` words that occur twice or more, the first occurrence included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    width = 1
    while width < size:
        step = min(width, size - width)
        first, second = codes[: len(codes) - step], codes[step:]
        kinds, codes = np.unique(first * (int(codes.max()) + 1) + second, return_inverse=True)
        width += step
        if len(kinds) == len(codes):
            return 0
    twice = np.bincount(codes)[codes] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    lines = text.split(b"\n")
    kept = [line for line in lines if line.strip(b" \t\n\r\x0b\x0c")]
    return (
        len(words),
        chars,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(kept) - len(set(kept)),
        repeated_window_words(words),
    )


def apply(
    docs: DataFrame, model: RulesModel, keep_at: float = KEEP_AT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, the counts, base_failed, probability and kept of every row, without a shuffle.

    Null and empty texts have no words and fail the base rules; a null id stays null; repeated rows
    are judged each; other columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = WordTable(own.weights, own.bits)
        for batch in batches:
            listed = batch.column("text").to_pylist()
            counts = [base_counts(t) for t in listed]
            p = own.probability(*_score_texts(own, table, listed, own.weights))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(p)], names=["doc_id", *names, "probability"]
            )

    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", probability double"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (
        rows.mapInArrow(run, schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= keep_at))
    )
