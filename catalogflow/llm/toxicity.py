"""Toxicity by cumulative-link ordinal regression on sparse word features.

P(severity <= k) = sigmoid(threshold_k - w . x): one weight per word, shared by all thresholds, and x marks the distinct
words of a text. Weights are fitted by proximal gradient steps with an L1 penalty, so words without clear evidence weigh
nothing. A text's score is its expected severity; it is rejected when severity 1 or more is the likelier side.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.shingles import ALNUM, Words, sliced, text_buffer

BUCKETS = 1 << 20  # word features
SAMPLE_ROWS = 8000  # labelled documents fitted on, half of them toxic where there are as many
STEPS = 150
RIDGE = 0.0001  # damping of the weights that are fitted
DEVIATIONS = 2.0  # of chance, that a word must exceed
_U = np.uint64


@dataclass
class Model:
    buckets: np.ndarray  # sorted numbers of the words with a weight
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(severity = k) for each score."""
        below = _sigmoid(self.thresholds[None, :] - score[:, None])
        edges = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(edges, axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _buckets(words: Words) -> np.ndarray:
    return (words.hash & _U(BUCKETS - 1)).astype(np.int32)


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word numbers of each text of the second column."""
    for batch in sliced(batches):
        words = Words(*text_buffer(batch.column(1)), ALNUM)
        numbers, first = _buckets(words), words.first
        sets = [np.unique(numbers[first[i]:first[i + 1]]) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, type=pa.list_(pa.int32())), batch.column(2)],
            names=["doc_id", "words", "severity"])


def severities(labels: DataFrame) -> DataFrame:
    """Grades: 0 not toxic, 1 toxic in a text of quality, 2 toxic in one without. Unlabelled rows go."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 1, 1).otherwise(2)
    return labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(grade).alias("severity"))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Model:
    return fit(training_rows(docs, labels, sample))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> list:
    """At most ``sample`` labelled texts as word numbers and grade, those of smallest id hash of each side."""
    graded = severities(labels).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = graded.where(F.col("severity") > 0).orderBy(*order).limit(sample // 2)
    clean = graded.where(F.col("severity") == 0).orderBy(*order).limit(sample // 2)
    chosen = toxic.unionByName(clean)
    # At most ``sample`` rows of two numbers are broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "severity")
    rows = rows.mapInArrow(_features, "doc_id long, words array<int>, severity int").groupBy("doc_id").agg(
        F.first("words").alias("words"), F.first("severity").alias("severity")).toArrow().to_pylist()
    return sorted(rows, key=lambda r: r["doc_id"])


def fit(rows: list, steps: int = STEPS) -> Model:
    """Fit weights and thresholds to ``rows`` of word numbers and grades."""
    grades = np.array([r["severity"] for r in rows], dtype=np.int64)
    levels = max(2, int(grades.max(initial=0)) + 1)
    n = len(rows)
    start = np.linspace(1.0, levels - 1.0, levels - 1)
    if not n or not grades.any() or grades.all():
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), start + 40)
    doc = np.repeat(np.arange(n), [len(r["words"]) for r in rows])
    word = np.concatenate([np.asarray(r["words"], dtype=np.int64) for r in rows])
    used, column = np.unique(word, return_inverse=True)
    seen = np.bincount(column)
    keep = (seen >= 2) & (seen <= max(2, 0.5 * n))
    used, mask = used[keep], keep[column]
    doc, column = doc[mask], (np.cumsum(keep) - 1)[column[mask]]
    # Both sides weigh the same, whatever their share of the sample.
    share = np.where(grades > 0, 0.5 / max(1, (grades > 0).sum()), 0.5 / max(1, (grades == 0).sum()))
    # A word must speak clearer than chance: its penalty is some deviations of the evidence that a word as frequent
    # would bring at random.
    less = max(1, min((grades > 0).sum(), (grades == 0).sum()))
    frequency = np.bincount(column, weights=share[doc], minlength=len(used))
    penalty = 0.25 * DEVIATIONS * np.sqrt((frequency * (1 - frequency) + 1.0 / less) / less)

    def shrink(step: np.ndarray, rate: float) -> np.ndarray:
        return np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0.0)

    def damp(step: np.ndarray, rate: float) -> np.ndarray:
        return step / (1 + rate * RIDGE)

    w, theta = _solve(doc, column, len(used), grades, share, start, shrink, steps)
    # The penalty has chosen the words; their weights are fitted again without its bias.
    held = np.flatnonzero(w)
    if not len(held):
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), start + 40)
    place = np.full(len(used), -1)
    place[held] = np.arange(len(held))
    mask = place[column] >= 0
    w, theta = _solve(doc[mask], place[column[mask]], len(held), grades, share, theta, damp, 8 * steps)
    return Model(used[held], w, theta)


def _solve(doc, column, features, grades, share, theta, prox, steps):
    """Accelerated proximal gradient descent; the step follows from the largest eigenvalue of the features."""
    n = len(grades)

    def spread(w: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=w[column], minlength=n)

    def gather(g: np.ndarray) -> np.ndarray:
        return np.bincount(column, weights=g[doc], minlength=features)

    v, norm = np.ones(features), 1.0
    for _ in range(12):
        v = gather(share * spread(v))
        norm = np.linalg.norm(v) or 1.0
        v = v / norm
    rate = 1.0 / (0.25 * (norm + 1.0))
    w, shown, shown_theta, t = np.zeros(features), np.zeros(features), theta, 1.0
    for _ in range(steps):
        g, g_theta = _gradient(spread(shown), shown_theta, grades, share)
        new = prox(shown - rate * gather(g), rate)
        new_theta = np.maximum.accumulate(shown_theta - rate * g_theta)
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        shown = new + (t - 1) / grown * (new - w)
        shown_theta = np.maximum.accumulate(new_theta + (t - 1) / grown * (new_theta - theta))
        w, theta, t = new, new_theta, grown
    return w, theta


def _gradient(score: np.ndarray, theta: np.ndarray, grades: np.ndarray, share: np.ndarray) -> tuple:
    """Of the weighted negative log-likelihood, by score and by threshold."""
    below = _sigmoid(theta[None, :] - score[:, None])
    n, last = len(grades), len(theta)
    at = np.arange(n)
    high = np.where(grades < last, below[at, np.minimum(grades, last - 1)], 1.0)
    low = np.where(grades > 0, below[at, np.maximum(grades - 1, 0)], 0.0)
    d_high, d_low = high * (1 - high), low * (1 - low)
    p = np.maximum(high - low, 1e-9)
    by_theta = np.zeros(last)
    up = grades < last
    by_theta -= np.bincount(grades[up], weights=(share * d_high / p)[up], minlength=last)[:last]
    down = grades > 0
    by_theta += np.bincount(grades[down] - 1, weights=(share * d_low / p)[down], minlength=last)[:last]
    return share * (d_high - d_low) / p, by_theta


def scores(column: pa.Array, model: Model) -> np.ndarray:
    """Weighted sum over the distinct words of each text."""
    out = np.zeros(len(column))
    words = Words(*text_buffer(column), ALNUM)
    numbers = _buckets(words)
    weight = np.zeros(BUCKETS)
    weight[model.buckets] = model.weights
    at = np.flatnonzero(weight[numbers] != 0)
    rows = np.searchsorted(words.first, at, side="right") - 1
    pairs = np.unique(rows.astype(np.int64) * BUCKETS + numbers[at])
    return out + np.bincount(pairs // BUCKETS, weights=weight[pairs % BUCKETS], minlength=len(column))


def _scorer(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            p = model.probabilities(scores(batch.column(1), model))
            expected = p @ np.arange(p.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(expected), pa.array(p.argmax(axis=1).astype(np.int32)),
                 pa.array(p[:, 1:].sum(axis=1)), pa.array(p[:, 0] <= 0.5)],
                names=["doc_id", "expected_severity", "severity", "p_toxic", "toxic"])

    return run


def rate_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: expected and likeliest severity, P(severity >= 1), and the verdict.

    Null and empty texts have no words and score as such; without a toxic label nothing is toxic. Rows given twice
    are rated twice; of several labels of one id the worst counts. Needs ``doc_id`` and ``text``.
    """
    model = trained(docs, labels, sample)
    return docs.select("doc_id", "text").mapInArrow(
        _scorer(model), "doc_id long, expected_severity double, severity int, p_toxic double, toxic boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns, in one pass."""
    model = trained(docs, labels, sample)
    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, place):
            p = model.probabilities(scores(batch.column(place), model))
            yield batch.filter(pa.array(p[:, 0] > 0.5))

    return docs.mapInArrow(run, docs.schema)
