"""Quality classifier: naive Bayes support vectors over n-gram indicators.

The n-grams of a text are its words and word pairs, its word shapes (``Abc``,
``ABC!!``, ``abc***``; runs of letters count once) alone, in pairs and triples,
and runs of one word repeated. Each distinct n-gram of a whole text is one
indicator, hashed to ``1 << BITS`` columns. Indicators are scaled by the log
ratio of their counts in the two classes; a linear hinge-loss model is then fit
by dual coordinate descent, and its margins become probabilities by a logistic
curve fit on margins of held-back folds.

Learned only from labels of documents that are not held out, on at most
``TRAIN_DOCS`` of them (those with the least hash of the id). Scoring reads every
text whole.

Defined results: a null or empty text has no n-grams and gets the score of the
intercept; null labels are not learned from; a document labelled several times
counts as good if any label says so; without labels of both classes all scores
are the share of good labels (no label: 0.5); repeated rows are scored each for
itself; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import held_out
from starmart.llm.hashing import distinct, mix, shingles, word_hashes

#: Most labelled documents the model learns from.
TRAIN_DOCS = 4000
#: Indicators are hashed to 2**BITS columns.
BITS = 20
THRESHOLD = 0.5
EPOCHS = 12
FOLDS = 3

_KINDS = mix(np.arange(1, 12, dtype=np.uint64))


def indicators(words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """The columns of a text's n-grams, each once."""
    grams = [words ^ _KINDS[0], shingles(words, 2) ^ _KINDS[1] if len(words) > 1 else words[:0]]
    grams += [shingles(shapes, n) ^ _KINDS[1 + n] for n in (1, 2, 3) if len(shapes) >= n]
    same = words[1:] == words[:-1]
    grams += [_KINDS[5 + n : 6 + n] for n in (1, 2, 3, 5) if _run(same, n)]
    return distinct((mix(np.concatenate(grams)) >> np.uint64(64 - BITS)).astype(np.int32))


def _run(same: np.ndarray, n: int) -> bool:
    """Whether ``n`` in a row are true."""
    if len(same) < n or not same.any():
        return False
    out = same[: len(same) - n + 1].copy()
    for i in range(1, n):
        out &= same[i : len(same) - n + 1 + i]
    return bool(out.any())


def hinge(
    rows: list[np.ndarray], scale: np.ndarray, signs: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Linear model of squared hinge loss by dual coordinate descent (Hsieh et al.,
    2008). Row i has ``scale`` at its columns, and 1 for the intercept."""
    w, b = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    values = [scale[r] for r in rows]
    diagonal = 0.5 / cost
    q = np.array([v @ v + 1 for v in values]) + diagonal
    order = np.random.RandomState(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            y, r, v = signs[i], rows[i], values[i]
            gradient = y * (w[r] @ v + b) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - gradient / q[i], 0.0)
            if step := (new - alpha[i]) * y:
                alpha[i] = new
                w[r] += step * v
                b += step
    return w, b


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, columns: np.ndarray) -> float:
        margin = float(self.weights[columns].sum(dtype=np.float64)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -35, 35))))


def _bayes(rows: list[np.ndarray], good: np.ndarray, columns: int) -> np.ndarray:
    """Log ratio of each column's smoothed share among good and among bad rows."""
    p, q = np.ones(columns), np.ones(columns)
    for r, g in zip(rows, good, strict=True):
        (p if g else q)[r] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def _logistic(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins (Platt's targets)."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (beta - [1, 0]))
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def train(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """Fit the model to indicator rows and their labels."""
    if len(rows) == 0 or good.all() or not good.any():
        share = min(max(good.mean() if len(rows) else 0.5, 1e-3), 1 - 1e-3)
        return Model(np.zeros(1 << BITS, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    known, flat = np.unique(np.concatenate(rows), return_inverse=True)
    local = np.split(flat, np.cumsum([len(r) for r in rows])[:-1])
    # Both classes weigh the same in sum, within a factor of ten.
    cost = np.where(good, min(1.0, 10 * (~good).mean() / good.mean()), min(1.0, 10 * good.mean() / (~good).mean()))

    def fit(some: np.ndarray) -> tuple[np.ndarray, float]:
        chosen = [local[i] for i in some]
        # Rows are brought to unit length on average, so that one cost fits any text length.
        ratio = _bayes(chosen, good[some], len(known))
        ratio = ratio / np.sqrt(np.mean([(ratio[r] ** 2).sum() for r in chosen]) + 1e-9)
        w, b = hinge(chosen, ratio, np.where(good[some], 1.0, -1.0), cost[some])
        return w * ratio, b

    fold = np.arange(len(rows)) % FOLDS
    margin = np.zeros(len(rows))
    for k in range(FOLDS):
        w, b = fit(np.flatnonzero(fold != k)) if len(set(good[fold != k])) == 2 else (np.zeros(len(known)), 0.0)
        for i in np.flatnonzero(fold == k):
            margin[i] = w[local[i]].sum() + b
    slope, shift = _logistic(margin, good)
    w, b = fit(np.arange(len(rows)))
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[known] = w
    return Model(weights, b, slope, shift)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, good) of at most ``most`` labelled documents that are not held out:
    those with the least hash of the id (bounded, so it may be broadcast)."""
    chosen = (
        labels.select(F.col("doc_id"), F.col(label).alias("good"))
        .where(F.col("good").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("good").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select("doc_id", F.col("text").alias("text"))
    # A document id may stand on several rows, so the bound is put on the result as well.
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(most)


def _bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes | None]:
    for value in column.cast(pa.binary()):
        yield value.as_py()


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_DOCS) -> Model:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [indicators(w, s).tobytes() for w, s in word_hashes(_bytes(batch.column("text")), True, True)]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("good"), pa.array(columns, pa.binary())], ["doc_id", "good", "columns"]
            )

    kinds = dict(docs.dtypes)
    sample = training_rows(docs, labels, label, most)
    found = sample.mapInArrow(rows, f"doc_id {kinds['doc_id']}, good {dict(sample.dtypes)['good']}, columns binary").collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["columns"])))
    good = np.array([r["good"] > 0 for r in found], dtype=bool)
    return train([np.frombuffer(r["columns"], dtype=np.int32) for r in found], good)


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 4 * 2**BITS bytes

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.score(indicators(w, s)) for w, s in word_hashes(_bytes(batch.column("text")), True, True)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64())], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id"), held_out("doc_id").alias("held_out"), F.col("text"))
    scored = rows.mapInArrow(scores, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on ``labels`` and score all ``docs``."""
    return score_quality(docs, fit_quality(docs, labels))
