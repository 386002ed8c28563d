"""Suffix-array dedup: removes every byte that lies in a 100-byte string which also starts earlier.

"Earlier" is a smaller document, or a smaller start in the same document.
Strings of ``LENGTH`` bytes that are equal must meet in one task to be
ordered, without sending 100 bytes for each position:

1. Every window of ``LENGTH`` bytes is held by an anchor, the leftmost of its
   ``GRAM``-byte substrings with the least hash.  Equal windows have equal anchors
   at equal places.  An anchor holds a run of neighbouring windows; its context
   is the text they cover.  Only (anchor hash, context hash, place) is shuffled,
   packed in blobs by anchor hash, after equal contexts of a batch were combined.
2. Of equal contexts all but the earliest are repeats as a whole.  Anchors whose
   contexts differ, a few in a hundred, are asked for their texts.
3. The texts of such contexts meet by anchor; windows without an equal hash in
   the task are trimmed from their ends, equal strings fold into their earliest,
   and a suffix array (:mod:`regstat.llm.suffix_array`) over the rest puts equal windows side
   by side; neighbours are compared byte by byte and all but the earliest of
   each class are repeats.  The array is built over at most ``ARRAY`` bytes at a time: a
   hot anchor's contexts are split by window offset first.
4. The repeats are gathered per document and its bytes are cut.

Defined cases: a null or empty text has 0 bytes and keeps the hash of the empty
string; rows with a null id come first in order; rows that share an id are
ordered by their text, equal rows one after the other, so they repeat each other;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstat.llm.common import mix64, small_batches, staged, sub_batches, texts
from regstat.llm.suffix_array import suffix_array

LENGTH = 100
GRAM = 36
SPAN = LENGTH - GRAM + 1        # grams in a window
PIECE = 1 << 20                 # windows of a text handled at once
BATCH = 4 << 20                 # bytes of text whose anchors are combined and packed together
PARTITION = 16 << 20            # bytes of text (or of asked contexts) per reducing task
ARRAY = 1 << 18                 # bytes under one suffix array
_ODD = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(5).integers(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("key", "<i8"), ("lo", "<u4"), ("n", "u1"), ("a", "u1")])
FOUND = "ask boolean, anchor long, key long, lo long, n int, a int"


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64: prefix sums give the hash of any substring."""

    def __init__(self, size: int):
        self.up = np.full(size, _ODD, np.uint64)
        self.down = np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
        self.up[0] = self.down[0] = 1
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * self.up[:len(data)], out=out[1:])
        return out


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = h
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, powers: _Powers) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, first window, windows, anchor's distance from the first window) of each anchor of a text."""
    prefix = powers.prefix(data)
    grams = mix64((prefix[GRAM:] - prefix[:-GRAM]) * powers.down[:len(data) - GRAM + 1])
    least = _sliding_min(grams, SPAN)
    # a gram is an anchor if it is the least of a window that holds it: the largest of those windows' minima is then its own hash
    edge = np.zeros(SPAN - 1, np.uint64)
    largest = ~_sliding_min(~np.concatenate([edge, least, edge]), SPAN)
    place = np.flatnonzero(largest == grams)
    held = np.searchsorted(place, np.arange(len(least)))
    wrong = np.flatnonzero(grams[place[held]] != least)
    while len(wrong):
        held[wrong] += 1
        wrong = wrong[grams[place[held[wrong]]] != least[wrong]]
    first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    n = np.diff(np.append(first, len(least)))
    at = place[held[first]]
    end = first + n + LENGTH - 1
    context = mix64((prefix[end] - prefix[first]) * powers.down[first] + n.astype(np.uint64) * np.uint64(0x51ED270B0A1F0C25)
                    + (at - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return grams[at], context, first, n, at - first


def _blobs(rows: np.ndarray, tasks: int) -> Iterator[tuple[int, bytes]]:
    """Rows of one batch by reducing task; of equal contexts only the earliest keeps its hashes, the others are marked as repeats (n = 0 contexts)."""
    order = np.lexsort((rows["lo"], rows["key"], rows["context"], rows["anchor"]))
    rows = rows[order]
    again = np.concatenate([[False], (rows["anchor"][1:] == rows["anchor"][:-1]) & (rows["context"][1:] == rows["context"][:-1])])
    to = (mix64(rows["anchor"]) % np.uint64(tasks)).astype(np.int64)
    for part, sign in ((~again, 1), (again, -1)):
        mine, dest = rows[part], to[part]
        if sign < 0:
            mine = merged(mine["key"], mine["lo"].astype(np.int64), mine["n"].astype(np.int64))
            dest = (mix64(mine["key"].view(np.uint64)) % np.uint64(tasks)).astype(np.int64)
        order = np.argsort(dest, kind="stable")
        mine, dest = mine[order], dest[order]
        cuts = np.flatnonzero(np.concatenate([[True], dest[1:] != dest[:-1], [True]])) if len(dest) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(dest[a]) if sign > 0 else -1 - int(dest[a]), _packed(mine[a:b])


def _packed(rows: np.ndarray) -> bytes:
    """Column by column: like values compress together."""
    return b"".join(np.ascontiguousarray(rows[c]).tobytes() for c in rows.dtype.names)


def _unpacked(blob: bytes, dtype: np.dtype) -> np.ndarray:
    n, at = len(blob) // dtype.itemsize, 0
    out = np.empty(n, dtype)
    for c in dtype.names:
        size = dtype[c].itemsize * n
        out[c] = np.frombuffer(blob[at:at + size], dtype[c])
        at += size
    return out


_RANGE = np.dtype([("key", "<i8"), ("lo", "<i8"), ("n", "<i8")])


def merged(key: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Ranges [lo, lo + n) of each key, touching and overlapping ones joined."""
    out = np.empty(len(key), _RANGE)
    order = np.lexsort((lo, key))
    out["key"], out["lo"], out["n"] = key[order], lo[order], n[order]
    if not len(out):
        return out
    end = out["lo"] + out["n"]
    # ends grow with the starts but for ranges inside others: carry the furthest end of the key
    new_key = np.concatenate([[True], out["key"][1:] != out["key"][:-1]])
    lift = np.cumsum(new_key).astype(np.int64) << 40
    far = np.maximum.accumulate(end + lift) - lift
    head = new_key | np.concatenate([[True], out["lo"][1:] > far[:-1]])
    cuts = np.flatnonzero(head)
    joined = out[cuts]
    joined["n"] = far[np.append(cuts[1:], len(out)) - 1] - joined["lo"]
    return joined


def _ranges(rows: np.ndarray) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays([pa.array(np.zeros(n, bool)), pa.array(np.zeros(n, np.int64)), pa.array(rows["key"]), pa.array(rows["lo"]),
                                       pa.array(rows["n"].astype(np.int32)), pa.array(np.zeros(n, np.int32))], names=["ask", "anchor", "key", "lo", "n", "a"])


def anchor_blobs(docs: DataFrame, tasks: int) -> DataFrame:
    """(task, blob) of all anchors of ``docs`` (key, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers(PIECE + LENGTH + 1)
        parts, size = [], 0

        def flush() -> pa.RecordBatch:
            to, blobs = zip(*_blobs(np.concatenate(parts), tasks), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(blobs, pa.binary())], names=["task", "blob"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                for at in range(0, len(text) - LENGTH + 1, PIECE):
                    data = np.frombuffer(text, np.uint8, min(PIECE + LENGTH - 1, len(text) - at), at)
                    anchor, context, first, n, a = anchors(data, powers)
                    rows = np.empty(len(anchor), _ROW)
                    rows["anchor"], rows["context"], rows["key"], rows["lo"], rows["n"], rows["a"] = anchor, context, key, first + at, n, a
                    parts.append(rows)
                    size += len(data)
                    if size >= BATCH:
                        yield flush()
                        parts, size = [], 0
        if parts:
            yield flush()

    return small_batches(docs).mapInArrow(run, "task int, blob binary")


def repeated_contexts(blobs: DataFrame, tasks: int) -> DataFrame:
    """Repeats known from hashes alone, and the contexts to be asked for (``FOUND``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ranges = [], []
        for batch in batches:
            for to, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (rows if to >= 0 else ranges).append(_unpacked(blob, _ROW if to >= 0 else _RANGE))
        if ranges:
            found = np.concatenate(ranges)
            ranges.clear()
            yield _ranges(merged(found["key"], found["lo"], found["n"]))
        if not rows:
            return
        x = np.concatenate(rows)
        rows.clear()
        x = x[np.argsort(x["anchor"], kind="stable")]
        same = x["anchor"][1:] == x["anchor"][:-1]
        x = x[np.append(same, False) | np.concatenate([[False], same])]          # anchors met once hold no repeat
        x = x[np.lexsort((x["lo"], x["key"], x["context"], x["anchor"]))]
        if not len(x):
            return
        head = np.concatenate([[True], x["anchor"][1:] != x["anchor"][:-1]])
        first = head | np.concatenate([[True], x["context"][1:] != x["context"][:-1]])
        again = x[~first]
        yield _ranges(merged(again["key"], again["lo"].astype(np.int64), again["n"].astype(np.int64)))
        contexts = np.add.reduceat(first.astype(np.int64), np.flatnonzero(head))
        ask = x[first & (contexts[np.cumsum(head) - 1] > 1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(ask), bool)), pa.array(ask["anchor"].view(np.int64) if len(ask) else np.zeros(0, np.int64)),
                                          pa.array(ask["key"]), pa.array(ask["lo"].astype(np.int64)), pa.array(ask["n"].astype(np.int32)),
                                          pa.array(ask["a"].astype(np.int32))], names=["ask", "anchor", "key", "lo", "n", "a"])

    return blobs.repartition(tasks, F.when(F.col("task") < 0, -1 - F.col("task")).otherwise(F.col("task"))).mapInArrow(run, FOUND)


def with_context(docs: DataFrame, asks: DataFrame) -> DataFrame:
    """The asked contexts with their text: anchor, key, lo, a, context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(texts(batch)):
                asked = batch.column(2).slice(i, 1).flatten()
                anchor, lo, n, a = (asked.field(c) for c in range(4))
                cut = [text[x:x + m + LENGTH - 1] for x, m in zip(lo.to_pylist(), n.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([anchor, pa.array([batch.column(0)[i].as_py()] * len(cut), pa.int64()), lo, a, pa.array(cut, pa.binary())],
                                                 names=["anchor", "key", "lo", "a", "context"])

    per_doc = asks.groupBy("key").agg(F.collect_list(F.struct("anchor", "lo", "n", "a")).alias("asked"))
    return docs.join(per_doc, "key").select("key", "text", "asked").mapInArrow(run, "anchor long, key long, lo long, a int, context binary")


class Piece(NamedTuple):
    text: bytes
    key: int
    lo: int         # place of its first window
    offset: int     # of its first window from the anchor
    anchor: int

    @property
    def windows(self) -> int:
        return len(self.text) - LENGTH + 1

    def part(self, first: int, last: int) -> Piece:
        """Windows first to last (inclusive)."""
        return Piece(self.text[first:last + LENGTH], self.key, self.lo + first, self.offset + first, self.anchor)


def trimmed(pieces: list[Piece], powers: _Powers) -> list[Piece]:
    """From the first to the last window of each piece whose hash occurs elsewhere too; pieces without one go."""
    hashes = []
    for piece in pieces:
        p = powers.prefix(np.frombuffer(piece.text, np.uint8))
        hashes.append((p[LENGTH:] - p[:-LENGTH]) * powers.down[:piece.windows])
    h = np.concatenate(hashes)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    again = np.zeros(len(h), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    starts = np.cumsum([0, *map(len, hashes)])
    at = np.flatnonzero(again)
    if not len(at):
        return []
    owner = np.searchsorted(starts, at, "right") - 1
    heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    out = []
    for a, b in zip(heads, [*heads[1:], len(at)], strict=True):
        i = owner[a]
        out.append(pieces[i].part(int(at[a] - starts[i]), int(at[b - 1] - starts[i])))
    return out


def folded(pieces: list[Piece], again: list[tuple[int, int, int]]) -> list[Piece]:
    """The earliest of equal pieces; the windows of the others go to ``again`` (key, lo, n)."""
    kept: dict[bytes, Piece] = {}
    for piece in sorted(pieces, key=lambda p: (p.key, p.lo)):
        if kept.setdefault(piece.text, piece) is not piece:
            again.append((piece.key, piece.lo, piece.windows))
    return list(kept.values())


def ordered(pieces: list[Piece]) -> np.ndarray:
    """Ranges of the windows that equal an earlier one, by a suffix array over all pieces."""
    joined = b"".join(p.text + b"\0" for p in pieces)
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum([len(p.text) + 1 for p in pieces])
    symbols = data.astype(np.int64) + 1
    symbols[ends - 1] = 0
    order = np.array(suffix_array(symbols.tolist()))
    owner = np.searchsorted(ends, order, "right")
    inside = order + LENGTH < ends[owner]
    order, owner = order[inside], owner[inside]
    windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    new = np.ones(len(order), bool)
    for at in range(1, len(order), 1 << 14):
        b = order[at:at + (1 << 14)]
        new[at:at + len(b)] = (windows[b] != windows[order[at - 1:at - 1 + len(b)]]).any(1)
    key = np.array([p.key for p in pieces])[owner]
    lo = np.array([p.lo for p in pieces])[owner] + order - (ends - np.array([len(p.text) + 1 for p in pieces]))[owner]
    kind = np.cumsum(new)
    by = np.lexsort((lo, key, kind))
    repeat = by[1:][kind[by][1:] == kind[by][:-1]]
    return merged(key[repeat], lo[repeat], np.ones(len(repeat), np.int64))


def repeated_windows(pieces: list[Piece]) -> np.ndarray:
    """Ranges (key, lo, n) of all windows of the pieces that equal an earlier window."""
    powers = _Powers(max((len(p.text) for p in pieces), default=0) + 1)
    again: list[tuple[int, int, int]] = []
    found = []

    def solve(mine: list[Piece]) -> None:
        for _ in range(2):                 # folding equal pieces leaves others alone
            mine = folded(trimmed(mine, powers), again) if mine else []
        if sum(len(p.text) for p in mine) <= ARRAY or len({p.anchor for p in mine}) > 1:
            for group in _groups(mine):
                if len({p.anchor for p in group}) == 1 and sum(len(p.text) for p in group) > ARRAY:
                    solve(group)
                elif group:
                    found.append(ordered(group))
            return
        # a hot anchor: windows at different offsets from it are different, so halve the offsets
        lo, hi = min(p.offset for p in mine), max(p.offset + p.windows for p in mine)
        middle = (lo + hi) // 2
        for a, b in ((lo, middle), (middle, hi)):
            solve([p.part(max(a - p.offset, 0), min(b - p.offset, p.windows) - 1) for p in mine if p.offset < b and p.offset + p.windows > a])

    solve(pieces)
    if again:
        found.append(np.array(again, _RANGE))
    return merged(*(np.concatenate([f[c] for f in found]) for c in ("key", "lo", "n"))) if found else np.empty(0, _RANGE)


def _groups(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Whole anchors, as many as fit in ``ARRAY`` bytes (or one alone)."""
    out, size = [], 0
    for _, some in groupby(sorted(pieces, key=lambda p: p.anchor), key=lambda p: p.anchor):
        group = list(some)
        own = sum(len(p.text) for p in group)
        if out and size + own > ARRAY:
            yield out
            out, size = [], 0
        out, size = out + group, size + own
    if out:
        yield out


def compared(contexts: DataFrame, tasks: int) -> DataFrame:
    """Repeats (key, lo, n) among the asked contexts; those of an anchor meet in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [Piece(text, key, lo, -a, anchor) for b in batches for anchor, key, lo, a, text in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if pieces:
            yield _ranges(repeated_windows(pieces)).select(["key", "lo", "n"])

    return contexts.repartition(tasks, "anchor").select("anchor", "key", "lo", "a", "context").mapInArrow(run, "key long, lo long, n int")


def kept_spans(text: bytes, ranges: list[dict]) -> tuple[bytes, int]:
    """What stays of a text, and the number of removed runs, for ranges (lo, n) of repeated windows."""
    spans: list[list[int]] = []
    for lo, n in sorted((r["lo"], r["n"]) for r in ranges):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], lo + n + LENGTH - 1)
        else:
            spans.append([lo, lo + n + LENGTH - 1])
    return b"".join(text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)], strict=True)), len(spans)


def _with_ranges(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    return docs.join(repeats.groupBy("key").agg(F.collect_list(F.struct("lo", "n")).alias("ranges")), "key", "left")


def cut(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes and runs, and the hash of what stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 256):
            rows = []
            for text, ranges in zip(texts(batch), batch.column(2).to_pylist(), strict=True):
                kept, spans = kept_spans(text, ranges or [])
                rows.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_ranges(docs, repeats).select("doc_id", "text", "ranges").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_texts(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``docs`` with the texts that stay; where a run ends inside a character, the character's stray bytes go, too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 256):
            ranges = batch.column(batch.num_columns - 1).to_pylist()
            new = [kept_spans(t, r)[0].decode("utf-8", "ignore") if r else t.decode() for t, r in zip(texts(batch), ranges, strict=True)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(new, batch.schema.field(at).type)).select(range(batch.num_columns - 1))

    return _with_ranges(docs, repeats).select(*docs.columns, "ranges").mapInArrow(run, docs.schema)


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, key, text (and ``more``): keys order the documents and are different; the ids themselves unless some are null or repeated."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)
    odd = plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").limit(1).count()
    if not odd:
        return plain.withColumn("key", F.col("doc_id"))
    # numbers that grow with the sorted partitions and inside them
    sorted_rows = plain.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    return staged(sorted_rows.withColumn("key", F.monotonically_increasing_id()), "keyed")


def repeated(rows: DataFrame) -> DataFrame:
    """Ranges of windows (key, lo, n) of the texts (key, text) that also start earlier."""
    plain = rows.select("key", "text")
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // PARTITION))
    found = staged(repeated_contexts(anchor_blobs(plain, 8 * tasks), tasks), "contexts")
    asks = found.filter("ask")
    asked = asks.agg(F.sum(F.col("n") + LENGTH)).first()[0] or 0
    windows = staged(compared(with_context(plain, asks), max(1, -(-asked // (PARTITION // 4)))), "windows")
    return found.filter(~F.col("ask")).select("key", "lo", "n").unionByName(windows)


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = keyed(docs)
    return cut(rows, repeated(rows))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with the repeated strings cut from their texts."""
    rows = keyed(docs, F.struct(*docs.columns).alias("row"))
    new = cut_texts(rows, repeated(rows))
    return new.select(*(F.col("text").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
