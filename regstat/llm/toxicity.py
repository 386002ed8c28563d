"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are hashed n-grams (3 to 5 characters of the text in lower case, of
any script), each counted once a text.  Their log-count ratio ``r`` between
toxic and other labelled texts scales them; a logistic regression on the scaled
features gives the weights, interpolated towards their mean size.  Every n-gram
seen in the labelled sample has a weight (``2**BITS`` hash values); one that is
new to it has none.

The fit uses at most ``MAX_LABELLED`` labelled documents of ``MAX_BYTES`` of
text together, picked in the order of a hash of the id, one text an id, so at
most ``3 * MAX_BYTES`` features reach the driver.  Scoring takes every whole
text in its scan.

Defined cases: null and empty texts have no features and score by the
constant alone; without labels of both classes every score is 0.5; of a
labelled id's several texts the smallest is learned; a labelled text of more
than ``MAX_BYTES`` ends the sample before it; repeated rows each get a row; a
null id is scored and never held out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regstat.llm.common import held_out, small_batches, staged, sub_batches, texts
from regstat.llm.text_stats import labelled_sample, with_labels

MAX_LABELLED = 8_000
MAX_BYTES = 12 << 20
BITS = 20
ORDERS = (3, 4, 5)
SMOOTH = 1.0              # added to every count
RIDGE = 1e-4
MIX = 0.25                # share of the weights' mean size in the final weights
STEPS = 100               # of the fit
CUT = 0.5
PIECE = 1 << 18           # characters hashed at once
ENTRIES = 1 << 21         # features of the labelled texts handled at once


class Classifier(NamedTuple):
    weights: np.ndarray   # of each hash value, ratios included
    constant: float


def _hashes(chars: np.ndarray) -> Iterator[np.ndarray]:
    """Hash value of the n-gram at each start, for each order."""
    h, n = chars, 1
    for order in ORDERS:
        while n < order:
            h = h[:-1] * np.uint32(0x01000193) ^ chars[n:]
            n += 1
        if not len(h):
            return
        mixed = h * np.uint32(0x9E3779B1)
        yield (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D + 2 * order) >> np.uint32(32 - BITS)


def _once(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Each different value of ``h``, where it stands last; ``last`` is scratch of 2**BITS places."""
    at = np.arange(len(h), dtype=np.int32)
    last[h] = at
    return h[last[h] == at]


def features(text: bytes, last: np.ndarray | None = None) -> np.ndarray:
    """Hash value of each different n-gram of a text."""
    last = np.empty(1 << BITS, np.int32) if last is None else last
    chars = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    found = np.zeros(0, np.uint32)
    for at in range(0, len(chars), PIECE):        # pieces overlap by what an n-gram needs
        some = chars[max(at - max(ORDERS) + 1, 0):at + PIECE]
        found = _once(np.concatenate([found, *_hashes(some)]), last)
    return found


def _sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """doc_id, label and text of the bounded labelled sample, one row an id."""
    marked = with_labels(docs, labelled_sample(labels, "toxic", max_labelled))
    one = staged(marked.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text")), "labelled-texts")
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)      # over max_labelled rows at most
    sizes = one.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")).withColumn("size", F.sum("size").over(before))
    return one.join(F.broadcast(sizes.filter(F.col("size") <= MAX_BYTES).select("doc_id")), "doc_id")


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier | None:
    """The classifier of the labelled texts outside the held-out fold; None unless both classes are there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.empty(1 << BITS, np.int32)
        for batch in sub_batches(batches):
            each = [np.sort(features(t, last)).tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(each, pa.binary())], names=["doc_id", "label", "f"])

    got = small_batches(_sample(docs, labels, max_labelled)).mapInArrow(run, "doc_id long, label int, f binary").toPandas().sort_values("doc_id")
    y, rows = got["label"].to_numpy(float), [np.frombuffer(x, np.uint32) for x in got["f"]]
    if not y.any() or y.all():
        return None
    weights, constant = fit(y, rows, ratios(y, rows))
    return Classifier(weights.astype(np.float32), constant)


def ratios(y: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Log-count ratio of each hash value between the classes; 0 for what no text holds."""
    counts = np.zeros((2, 1 << BITS))
    for label, row in zip(y, rows, strict=True):
        counts[int(label), row] += 1
    share = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=1, keepdims=True)
    return np.where(counts.any(axis=0), np.log(share[1]) - np.log(share[0]), 0.0)


class _Block:
    """Some texts' features, by text and by feature."""

    def __init__(self, first: int, rows: list[np.ndarray]):
        self.rows = first + np.flatnonzero([len(x) for x in rows])
        lengths = np.array([len(x) for x in rows if len(x)])
        self.starts = np.cumsum(lengths) - lengths
        self.flat = np.concatenate(rows)
        order = np.argsort(self.flat, kind="stable")
        self.row_of = np.repeat(np.arange(len(lengths)), lengths).astype(np.int32)[order]
        by_feature = self.flat[order]
        self.feature_starts = np.flatnonzero(np.diff(by_feature, prepend=np.int64(-1)))
        self.features = by_feature[self.feature_starts]


def _blocks(rows: list[np.ndarray]) -> Iterator[_Block]:
    first, size = 0, 0
    for i, row in enumerate(rows):
        size += len(row)
        if size >= ENTRIES or i == len(rows) - 1:
            if size:
                yield _Block(first, rows[first:i + 1])
            first, size = i + 1, 0


def fit(y: np.ndarray, rows: list[np.ndarray], r: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights (ratios included) and constant of the logistic regression on ``r``-scaled features, classes weighed equally.

    Accelerated gradient steps of a fixed number and length: the same rows always give the same weights.
    """
    blocks = list(_blocks(rows))

    def sums(of_feature: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        for b in blocks:
            out[b.rows] = np.add.reduceat(of_feature[b.flat], b.starts)
        return out

    def pulled(of_row: np.ndarray) -> np.ndarray:
        out = np.zeros(len(r))
        for b in blocks:
            out[b.features] += np.add.reduceat(of_row[b.rows][b.row_of], b.feature_starts)
        return r * out

    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, b = np.zeros(len(r)), 0.0
    ahead, ahead_b = w, b
    step = 4.0 / (sums(r**2).max() + 1 + 4 * RIDGE)
    for t in range(STEPS):
        g = weight * (1 / (1 + np.exp(-np.clip(sums(r * ahead) + ahead_b, -30, 30))) - y)
        nxt = ahead - step * (pulled(g) + RIDGE * ahead)
        nxt_b = ahead_b - step * g.sum()
        mom = t / (t + 3)
        ahead, ahead_b, w, b = nxt + mom * (nxt - w), nxt_b + mom * (nxt_b - b), nxt, nxt_b
    used = np.zeros(len(r), bool)
    for block in blocks:
        used[block.features] = True
    size = np.abs(w[used]).mean() if used.any() else 0.0
    return r * ((1 - MIX) * w + MIX * size), float(b)


def scores(model: Classifier | None, batch: list[bytes]) -> np.ndarray:
    if model is None:
        return np.full(len(batch), 0.5)
    last = np.empty(1 << BITS, np.int32)
    s = np.array([model.weights[features(t, last)].sum(dtype=float) for t in batch]) + model.constant
    return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def classify(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # fixed size: 2**BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(scores(shared.value, texts(batch)))], names=["doc_id", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = plain.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
