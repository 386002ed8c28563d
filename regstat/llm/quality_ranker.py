"""Quality classifier: Bradley-Terry pairwise ranking.

Every labelled good document is preferred to every labelled poor one.  The
model scores a document linearly, ``s = w . x``; the chance that i beats j is
``sigmoid(s_i - s_j)``, so the fit is a logistic regression without constant
on feature differences of preference pairs (ridge penalty, Newton steps).
Only the order of scores is learned; the threshold is the quantile of the
labelled scores that best parts the classes, and the reported score is the
logistic of the distance to it, placed so that the threshold reads 0.3.

The features are rates and logarithms of the text's own counts.  The fit uses
at most ``MAX_LABELLED`` documents and ``MAX_PAIRS`` pairs drawn from their
two classes; scoring runs over every whole text in its scan.

Defined cases: null and empty texts are scored on zero counts; without labels
of both classes every score is 0.5; of a labelled id's several texts the one
with the smallest counts is learned; repeated rows each get a row; a null id is
scored and never held out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat.llm.common import held_out, small_batches
from regstat.llm.text_stats import COUNTS, count_batches, counted, labelled_sample, with_labels

MAX_LABELLED = 20_000     # labelled documents of the fit
MAX_PAIRS = 200_000       # preference pairs of the fit
RIDGE = 1e-3
CUT = 0.3                 # reported score at the threshold


class Ranker(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float


def features(counts: np.ndarray) -> np.ndarray:
    """Rates per word, byte or line and logarithms of lengths, one row a text."""
    c = dict(zip(COUNTS, counts.T.astype(float), strict=True))
    words, size, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_bytes"], 1), np.maximum(c["n_lines"], 1)
    rates = [c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_upper"] / size, c["n_digits"] / size, c["n_marks"] / words,
             c["n_exclaims"] / words, c["n_pipes"] / words, c["n_twins"] / words, c["n_short"] / words, c["word_chars"] / words / 10]
    logs = [np.log1p(c["n_words"]), np.log1p(c["n_words"] / lines), np.log1p(c["n_distinct"]) / np.log1p(words)]
    roots = [np.sqrt(r) for r in rates[:9]]      # the first traces of a fault weigh more than later ones
    return np.stack([*rates, *logs, *roots], axis=1)


def fit(x: np.ndarray, label: np.ndarray, max_pairs: int = MAX_PAIRS) -> Ranker | None:
    """The ranker of labelled feature rows; None unless both classes are there."""
    good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(poor):
        return None
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-12] = 1.0
    z = (x - mean) / scale
    draw = np.random.default_rng(1)
    diff = z[draw.choice(good, max_pairs)] - z[draw.choice(poor, max_pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (p - 1) / len(diff) + RIDGE * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    levels = np.unique(np.quantile(s, np.linspace(0, 1, 1001)))
    right = np.array([((s[good] >= t).mean() + (s[poor] < t).mean()) / 2 for t in levels])
    best = np.flatnonzero(right >= right.max() - 1e-12)
    at = best[len(best) // 2]
    threshold = (levels[at] + levels[max(at - 1, 0)]) / 2 if (s[poor] < levels[at]).any() else levels[at]
    return Ranker(mean, scale, w, float(threshold), float(s.std()) or 1.0)


def score(model: Ranker | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    distance = ((x - model.mean) / model.scale @ model.weights - model.threshold) / model.spread
    return 1 / (1 + np.exp(-np.clip(4 * distance + np.log(CUT / (1 - CUT)), -30, 30)))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranker | None:
    rows = text_stats_with_labels(docs, labels, "quality", max_labelled)
    counts, label = rows[:, :len(COUNTS)], rows[:, -1]
    return fit(features(counts), label)


def text_stats_with_labels(docs: DataFrame, labels: DataFrame, column: str, limit: int) -> np.ndarray:
    """Counts and label of the bounded labelled sample, in the order of the ids, on the driver."""
    marked = counted(with_labels(docs, labelled_sample(labels, column, limit)))
    one = marked.groupBy("doc_id").agg(F.min(F.struct(*COUNTS, "label")).alias("x"))      # a repeated id sends one row
    return one.select("doc_id", "x.*").toPandas().sort_values("doc_id").drop(columns="doc_id").to_numpy(np.int64)


def rank(docs: DataFrame, model: Ranker | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts in count_batches(batches):
            s = score(model, features(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(s)], names=["doc_id", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = small_batches(plain).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
