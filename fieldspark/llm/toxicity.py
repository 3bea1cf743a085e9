"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade >= k | x) = sigmoid(w.x - t_k) for k = 1 ... K-1, with rising thresholds t_k: one weight
vector is shared by all thresholds, so that a word moves a text along one scale of severity. Features
are the distinct lower-cased words of a text and the distinct beginnings of its words, three to six
letters long, each worth 1 whatever its frequency. The expected
severity is the sum of the K-1 probabilities; the predicted grade is the number of them above one half.

Weights get an L1 penalty and are fitted by proximal AdaGrad steps over the whole sample, which leaves a
short list of features with a weight; thresholds are not penalised. Fitting takes a bounded sample:
``Fit.rows`` labelled documents chosen by a hash of doc_id, with their distinct words; features of fewer
than ``Fit.fewest`` sample documents are left out. Prediction reads every text whole.

Labels may have any number of ordered grades. ``graded`` turns yes/no labels into three: 0 for clean
texts, and for toxic ones 1 or 2 according to whether a first fit to the two classes scores them
below or from the median of the toxic texts.

Defined cases: a NULL or wordless text has no features: its grade follows from the thresholds alone.
Labels with NULL doc_id or grade are ignored; of several labels of a document the highest counts.
Without two different grades all documents get severity 0. Repeated rows each give a row; an empty table
gives none. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import hashed_share, over_batches, texts

BEGINNINGS = (3, 4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Fit:
    """Bound of the training sample and settings of the descent."""

    rows: int = 6_000
    fewest: int = 8
    screen: int = 1_000
    penalty: float = 2e-4
    rounds: int = 800


@dataclass
class Scale:
    """Feature weights and rising thresholds."""

    weights: dict[str, float]
    thresholds: list[float]

    def score(self, words: set[str]) -> float:
        return sum(sorted(self.weights[name] for name in features_of(words) & self.weights.keys()))


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """The words themselves, and their beginnings marked by a hyphen."""
    found = set(words)
    for size in BEGINNINGS:
        found.update({word[:size] + "-" for word in words if len(word) > size})
    return found


def graded(samples: list[tuple[set[str], int]], fit: Fit) -> list[int]:
    """Grades 0, 1, 2 from yes/no labels: see above."""
    labels = [int(bool(label)) for _, label in samples]
    first = fit_scale([(words, label) for (words, _), label in zip(samples, labels, strict=True)], fit)
    if first is None:
        return labels
    scores = [first.score(words) for words, _ in samples]
    middle = float(np.median([score for score, label in zip(scores, labels, strict=True) if label]))
    return [label and 1 + (score >= middle) for score, label in zip(scores, labels, strict=True)]


def fit_scale(samples: list[tuple[set[str], int]], fit: Fit = Fit()) -> Scale | None:
    """Fit to (words, grade) samples, grades 0 ... K-1; None if only one grade occurs."""
    grades = np.array([grade for _, grade in samples], np.int64)
    if not len(grades) or grades.min() == grades.max():
        return None
    found = [features_of(words) for words, _ in samples]
    frequent = Counter(name for names in found for name in names)
    usual = grades.mean()
    excess: Counter = Counter()
    for own, grade in zip(found, grades.tolist(), strict=True):
        if grade:
            excess.update(dict.fromkeys(own, grade))
    spread = max(1e-9, grades.var())
    departure = {
        name: abs(excess[name] - n * usual) / np.sqrt(n * spread) for name, n in frequent.items() if n >= fit.fewest
    }
    names = sorted(sorted(departure, key=lambda name: (-departure[name], name))[:fit.screen])
    number = {name: k for k, name in enumerate(names)}
    listed = [[number[name] for name in own if name in number] for own in found]
    of_row = np.repeat(np.arange(len(listed)), [len(row) for row in listed])
    of_word = np.array([k for row in listed for k in row], np.int64)
    levels = int(grades.max())
    above = grades[:, None] >= np.arange(1, levels + 1)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def gradient(weights, thresholds):
        """Of the mean negative log-likelihood of the grade, P(>= k) - P(>= k + 1)."""
        scores = np.bincount(of_row, weights[of_word], len(samples))
        tail = np.column_stack([np.ones(len(samples)), sigmoid(scores[:, None] - thresholds), np.zeros(len(samples))])
        each = np.arange(len(samples))
        upper, lower = tail[each, grades], tail[each, grades + 1]
        chance = np.maximum(upper - lower, 1e-9)
        bend_upper, bend_lower = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        of_scores = -(bend_upper - bend_lower) / len(samples)
        of_thresholds = np.zeros(levels)
        np.add.at(of_thresholds, grades[grades > 0] - 1, bend_upper[grades > 0] / len(samples))
        np.add.at(of_thresholds, grades[grades < levels], -bend_lower[grades < levels] / len(samples))
        return np.bincount(of_word, of_scores[of_row], len(names)), of_thresholds

    shares = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    thresholds = np.log((1 - shares) / shares)
    weights = np.zeros(len(names))
    # A bound of the curvature: a half, times the largest mean feature count of a feature's texts.
    per_row = np.bincount(of_row, minlength=len(samples))
    steepest = np.bincount(of_word, per_row[of_row], len(names)).max(initial=0.0) / len(samples)
    step = 1 / (0.5 * max(1e-9, steepest))
    ahead_w, ahead_t, momentum = weights, thresholds, 1.0
    for _ in range(fit.rounds):
        slope_w, slope_t = gradient(ahead_w, ahead_t)
        moved = ahead_w - step * slope_w
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * fit.penalty, 0)
        # Thresholds have few terms each, so that their own step may be larger.
        new_t = np.maximum.accumulate(ahead_t - slope_t)
        next_momentum = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / next_momentum
        ahead_w, ahead_t = new_w + pull * (new_w - weights), np.maximum.accumulate(new_t + pull * (new_t - thresholds))
        weights, thresholds, momentum = new_w, new_t, next_momentum
    kept = np.flatnonzero(weights)
    return Scale({names[k]: float(weights[k]) for k in kept}, thresholds.tolist())


def training_sample(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> list[tuple[set[str], int]]:
    """The bounded sample as (distinct words, label), in the order of doc_id."""
    graded = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max("toxic").alias("grade"))
    share = min(1.0, 1.1 * fit.rows / max(1, graded.count()))
    # Bounded by the sample size, so it may be sent to every task.
    chosen = graded.where(hashed_share("doc_id", F.lit(share))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [" ".join(sorted(words_of(text))) for text in texts(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.array(words, pa.string())], ["doc_id", "grade", "words"]
            )
        return step

    found = over_batches(
        rows.select("doc_id", "text", F.col("grade").cast("long").alias("grade")), "doc_id long, grade long, words string", start
    ).toPandas().sort_values(["doc_id", "words"]).drop_duplicates("doc_id")
    return [(set(words.split()), int(grade)) for words, grade in zip(found["words"], found["grade"], strict=True)]


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Scale | None:
    """A severity scale from yes/no labels."""
    samples = training_sample(docs, labels, fit)
    grades = graded(samples, fit)
    return fit_scale([(words, grade) for (words, _), grade in zip(samples, grades, strict=True)], fit)


def severity(docs: DataFrame, scale: Scale | None) -> DataFrame:
    """Rows (doc_id, severity, grade, toxic): expected severity, predicted grade, and whether that is above 0."""
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if scale is None:
        return columns.select("doc_id", F.lit(0.0).alias("severity"), F.lit(0).alias("grade"), F.lit(False).alias("toxic"))
    thresholds = np.array(scale.thresholds)

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = np.array([scale.score(words_of(text)) for text in texts(batch)], float)
            tail = 1 / (1 + np.exp(-np.clip(scores[:, None] - thresholds, -700, 700)))
            grades = (tail > 0.5).sum(axis=1)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tail.sum(axis=1)), pa.array(grades.astype(np.int32)), pa.array(grades > 0)],
                ["doc_id", "severity", "grade", "toxic"],
            )
        return step

    return over_batches(columns, "doc_id long, severity double, grade int, toxic boolean", start)
