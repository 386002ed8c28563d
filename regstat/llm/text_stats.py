"""Counts of each whole text that the quality operators share, taken in one pass in Arrow batches.

A word is a run of bytes other than the six ASCII white-space characters; a
null text has no words.  Counts (all long):

n_words, word_chars (code points in words), n_symbols (of ``#*$%&|<>``),
n_dup_lines (lines with a word that equal an earlier line), n_repeat_words
(words inside 8-word windows that the text holds twice or more), n_bytes,
n_lines (with a word), n_upper and n_digits (ASCII), n_marks (of ``.,;:!?``),
n_exclaims, n_pipes, n_distinct (different words), n_twins (words equal to the
word before), n_short (words of at most two bytes).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regstat.llm.common import small_batches, sub_batches, texts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "n_lines", "n_upper", "n_digits", "n_marks",
          "n_exclaims", "n_pipes", "n_distinct", "n_twins", "n_short")
WINDOW = 8

_SPACE, _SYMBOLS, _UPPER, _DIGITS, _MARKS = b" \t\n\x0b\x0c\r", b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?"
_CONTINUATION = bytes(range(0x80, 0xC0))
_ODD = np.random.default_rng(8).integers(0, 2**63, WINDOW).astype(np.uint64) | np.uint64(1)


def n_repeat_words(words: list[bytes], hashes: np.ndarray) -> int:
    """Words covered by windows that occur twice or more.

    Equal windows have equal hashes; windows whose hash repeats are then
    compared word by word.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    keys = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        keys += hashes[i:i + n] * _ODD[i]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    first: dict[tuple, int] = {}
    covered = np.zeros(n + WINDOW, np.int64)
    for i in np.flatnonzero(again).tolist():
        j = first.setdefault(tuple(words[i:i + WINDOW]), i)
        if j != i:
            for at in (i, j):
                covered[at] += 1
                covered[at + WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


def _without(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def counts_of(text: bytes) -> tuple[int, ...]:
    words = text.split()
    n = len(words)
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (n, len(text) - _without(text, _CONTINUATION) - _without(text, _SPACE), _without(text, _SYMBOLS), len(lines) - len(set(lines)),
            n_repeat_words(words, hashes), len(text), len(lines), _without(text, _UPPER), _without(text, _DIGITS), _without(text, _MARKS),
            text.count(b"!"), text.count(b"|"), len(set(words)), int((hashes[1:] == hashes[:-1]).sum()), sum(len(w) <= 2 for w in words))


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each (sub-)batch with its matrix of counts, one row a text."""
    for batch in sub_batches(batches):
        yield batch, np.array([counts_of(t) for t in texts(batch)], np.int64).reshape(batch.num_rows, len(COUNTS))


def counted(rows: DataFrame) -> DataFrame:
    """``rows``, with the counts of their texts in place of the texts."""
    rest = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, m in count_batches(batches):
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest))), *(pa.array(c) for c in m.T.copy())], names=[*rest, *COUNTS])

    schema = T.StructType([*(rows.schema[c] for c in rest), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return small_batches(rows.select(*rest, "text")).mapInArrow(run, schema)


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every text."""
    return counted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))


def labelled_sample(labels: DataFrame, column: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids outside the held-out fold (doc_id, label), picked by a hash of the id; ids with unclear labels are left out."""
    from regstat.llm.common import held_out
    clear = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").drop("most"))
    return clear.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, text, label of the sampled ids' documents (the sample's bound is small enough to broadcast)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.join(F.broadcast(sample), "doc_id")
