"""Quality classifier: ordinal regression with cumulative links on graded ratings.

P(grade > k) = 1 / (1 + exp(threshold_k - w.x)): one weight per hashed text feature, shared by all grades, and
ordered thresholds. It is fitted on at most ``most_labelled`` labelled rows (:data:`MOST_LABELLED`; those with
the smallest hash of the id), which is all that reaches the driver; every document is scored on its whole text
in Arrow batches, without a shuffle. Each row gets its tail probabilities and its expected grade.

Grades: 0 for quality 0, 1 for quality 1 with toxic 1, 2 for quality 1 without. By default a document is
rejected where P(grade >= 1) is below one half.

Defined results: a NULL text counts as empty and is scored by the thresholds alone; repeated rows each get the
same answer; labels of one id count by the lowest grade, rows of one id by the smallest text; rows without
quality are not used; without two different grades nothing can be fitted, probabilities are NULL and all
documents stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

MOST_LABELLED = 4096
WIDTH = 1 << 18
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.5, 1e-5
LEAST_ROWS, LEAST_STEPS = 5, 2000
REMEMBERED = 400_000
GRADES = 3
SCORES = "doc_id long, expected_grade double, " + ", ".join(f"p_ge_{k} double" for k in range(1, GRADES))


def _place(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) % WIDTH


def shape(word: str) -> str:
    """Letters as a, digits as 0, other signs as they are, runs as one sign."""
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", "0", word)))


class _Places(dict):
    """Places of a word's two features, packed in one number; forgotten all at once beyond a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = packed = _place("word " + word.lower().strip(".,;:!?")) * WIDTH + _place("shape " + shape(word))
        return packed


_AGAIN = [_place(f"again {tenths}") for tenths in range(11)]
_KNOWN = _Places()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the text's features: words and shapes of words with logarithmic counts at unit
    length, and the share of words that repeat the one before, in tenths."""
    words = text.split()
    packed = np.fromiter(map(_KNOWN.__getitem__, words), np.int64, len(words))
    found, counts = np.unique(np.concatenate([packed // WIDTH, packed % WIDTH]), return_counts=True)
    values = np.log1p(counts)
    again = 10 * int((packed[1:] == packed[:-1]).sum()) // max(1, len(words) - 1)
    return np.append(found, _AGAIN[again]), np.append(values / max(np.sqrt((values**2).sum()), 1e-12), 1.0)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: str) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        places, values = features(text)
        return 1 / (1 + np.exp(np.clip(self.thresholds - float(self.weights[places] @ values), -500, 500)))


def fit(texts: list[str], grades: list[int]) -> Model | None:
    """Weights and thresholds by Adagrad over shuffled batches with a fixed seed; a feature that fewer than
    :data:`LEAST_ROWS` rows have gets no weight."""
    if len(set(grades)) < 2:
        return None
    rows = [features(text) for text in texts]
    spread = np.bincount(np.concatenate([places for places, _ in rows]), minlength=WIDTH) >= LEAST_ROWS
    rows = [(places[spread[places]], values[spread[places]]) for places, values in rows]
    above = np.array(grades)[:, None] > np.arange(GRADES - 1)
    weights, seen = np.zeros(WIDTH), np.full(WIDTH, 1e-8)
    share = np.clip(above.mean(0), 1e-3, 1 - 1e-3)
    thresholds, moved = np.log((1 - share) / share), np.full(GRADES - 1, 1e-8)
    order = np.random.default_rng(0)
    epochs = max(EPOCHS, LEAST_STEPS * BATCH // len(rows))
    for _ in range(epochs):
        for batch in np.array_split(order.permutation(len(rows)), -(-len(rows) // BATCH)):
            slope, shift = np.zeros(WIDTH), np.zeros(GRADES - 1)
            for row in batch:
                places, values = rows[row]
                error = 1 / (1 + np.exp(thresholds - weights[places] @ values)) - above[row]
                slope[places] += error.sum() * values
                shift -= error
            slope = slope / len(batch) + DECAY * weights
            seen += slope**2
            weights -= RATE * slope / np.sqrt(seen)
            moved += (shift / len(batch)) ** 2
            thresholds = np.sort(thresholds - RATE * shift / len(batch) / np.sqrt(moved))
    return Model(weights.astype(np.float32), thresholds)


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade from quality and toxic."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, most_labelled: int = MOST_LABELLED) -> Model | None:
    """Model from ``docs`` (doc_id, text) and ``ratings`` (doc_id, grade): at most ``most_labelled`` rows."""
    rated = docs.select("doc_id").join(ratings.select("doc_id", "grade"), "doc_id").distinct()
    chosen = rated.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(most_labelled)
    sample = docs.select("doc_id", whole(F.col("text")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = sample.groupBy("doc_id", "grade").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda row: row["doc_id"])
    return fit([row["text"] for row in rows], [row["grade"] for row in rows])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, expected_grade and p_ge_1 to p_ge_n of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = batch.column("doc_id").cast(pa.int64())
            if model is None:
                columns = [pa.nulls(len(texts), pa.float64())] * GRADES
            else:
                tails = np.array([model.tails(text) for text in texts]).reshape(len(texts), GRADES - 1)
                columns = [pa.array(column) for column in (tails.sum(1), *tails.T)]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "expected_grade", *(f"p_ge_{k}" for k in range(1, GRADES))])

    return docs.select("doc_id", whole(F.col("text")).alias("text")).mapInArrow(run, SCORES)


def classify(docs: DataFrame, model: Model | None, least_grade: int = 1, least_probability: float = 0.5) -> DataFrame:
    """:func:`score` and ``kept``: whether the grade is ``least_grade`` or better with the least probability."""
    return score(docs, model).withColumn("kept", F.coalesce(F.col(f"p_ge_{least_grade}") >= least_probability, F.lit(True)))


def keep_good(docs: DataFrame, model: Model | None, least_grade: int = 1, least_probability: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, all columns as they were, in one pass."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield batch.filter(pa.array([model.tails(text or "")[least_grade - 1] >= least_probability for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
