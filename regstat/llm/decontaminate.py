"""Benchmark decontamination by latent semantic retrieval.

An item of more than ``WIDTH`` words is taken apart into passages like a text's;
the others are one piece.

1. Vocabulary: the benchmark's words that few documents hold (at most
   ``MAX_SHARE`` of them), and of each piece at least its ``RAREST`` rarest.  Document
   frequencies are counted over all documents.
2. Latent space: randomised SVD of the TF-IDF rows of passages (``WIDTH`` words
   every ``STRIDE``).  Tasks add up ``A' A Omega`` and then the small Rayleigh-Ritz matrix
   of their passages; the basis is fitted on the passages of all documents and on the
   items' pieces.  The rows are sparse: they are written once, and both passes read them.
3. Search: every passage of every document is projected, and each item that has a
   piece with a cosine of at least ``COSINE`` is a candidate; there is no limit on candidates.
4. Check: the longest common subsequence of words of the item and the
   text around the passage (for an item of several pieces, its whole length on
   both sides, narrowed to where its rare words are) must reach ``LCS`` of the item's words, or ``LCS_ANSWER``
   if the answer (the item's last sentence, or last third) is there by ``ANSWER``; of the
   item's vocabulary words alone ``RARE`` must be there in order, so frequent words do not make a match.

The benchmark is taken in blocks of at most ``BLOCK_BYTES``, so what a task
holds is bounded whatever its size.

Defined cases: null or empty texts and items match nothing; documents and
items with a null id are matched like the others and report a null id; repeated
documents and items are reported for each row's id, once per (doc_id, item_id)
and text; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat.llm.common import small_batches, staged, sub_batches, texts

WIDTH, STRIDE = 64, 32
RANK, EXTRA = 192, 16
MAX_SHARE, RAREST = 0.02, 8
COSINE = 0.3
LCS, LCS_ANSWER, ANSWER = 0.75, 0.5, 0.6
RARE = 0.6                     # share of the item's vocabulary words in common order that every match needs
AROUND = 12                    # words looked at beyond the item's words found
BLOCK_BYTES = 4 << 20
SLAB = 256                     # rows of the summed matrices that travel together
ENTRIES = 1 << 10              # entries of sparse rows multiplied at once
PASSAGES = 4_096               # passages multiplied at once
HITS = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double, position long"

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """ASCII letters in lower case; ASCII punctuation parts words."""
    return text.translate(_PLAIN).split()


class Item(NamedTuple):
    item_id: int | None
    words: list[bytes]
    answer: list[bytes]


def items_of(rows: list[tuple[int | None, bytes]]) -> list[Item]:
    out = []
    for item_id, text in rows:
        words = words_of(text)
        if words:
            sentences = [s for s in text.replace(b"\n", b" ").replace(b"?", b".").replace(b"!", b".").split(b".") if s.strip()]
            last = words_of(sentences[-1]) if len(sentences) > 1 else []
            out.append(Item(item_id, words, last if len(last) >= 3 else words[-max(3, len(words) // 3):]))
    return out


def pieces_of(words: list[bytes]) -> list[list[bytes]]:
    """An item's passages, each of at most ``WIDTH`` words."""
    last = max(0, -(-(len(words) - WIDTH) // STRIDE))
    return [words[s * STRIDE:s * STRIDE + WIDTH] for s in range(last + 1)]


class Space(NamedTuple):
    """Terms with their weights and latent vectors, and the latent directions of the items' pieces, in the items' order."""
    index: dict[bytes, int]
    vectors: np.ndarray          # term x rank, idf included
    items: np.ndarray            # piece x rank, unit length


class Rows(NamedTuple):
    """Sparse rows: the entries of row ``i`` are those with ``row == i``, in row order."""
    row: np.ndarray
    col: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def times(self, m: np.ndarray) -> np.ndarray:
        """The first entries of all rows at once, then the second ones, and so on; rows with more entries come first."""
        n = np.bincount(self.row, minlength=self.shape[0])
        order, first = np.argsort(-n, kind="stable"), np.cumsum(n) - n
        sums = np.zeros((self.shape[0], m.shape[1]))
        for k in range(n.max(initial=0)):
            at = first[order[:np.count_nonzero(n > k)]] + k
            sums[:len(at)] += self.value[at, None] * m[self.col[at]]
        out = np.empty_like(sums)
        out[order] = sums
        return out

    def transposed_times(self, m: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        order = np.argsort(self.col, kind="stable")
        return _gathered(self.col[order], self.row[order], self.value[order], m, self.shape[1], out)


def _gathered(to: np.ndarray, of: np.ndarray, value: np.ndarray, m: np.ndarray, n: int, out: np.ndarray | None = None) -> np.ndarray:
    """Row ``to[k]`` of the result is the sum of ``value[k] * m[of[k]]``, added to ``out`` if given; ``to`` is sorted."""
    out = np.zeros((n, m.shape[1])) if out is None else out
    for lo in range(0, len(to), ENTRIES):
        part = slice(lo, lo + ENTRIES)
        rows, first = np.unique(to[part], return_index=True)
        out[rows] += np.add.reduceat(value[part, None] * m[of[part]], first, axis=0)
    return out


def tfidf(pieces: list[list[bytes]], index: dict[bytes, int], idf: np.ndarray) -> Rows:
    """The pieces' TF-IDF rows of unit length."""
    row, col, value = [], [], []
    for i, piece in enumerate(pieces):
        terms, n = np.unique(np.fromiter((index[w] for w in piece if w in index), np.int64), return_counts=True)
        weight = n * idf[terms]
        row.append(np.full(len(terms), i))
        col.append(terms)
        value.append(weight / max(np.linalg.norm(weight), 1e-9))
    return Rows(np.concatenate(row), np.concatenate(col), np.concatenate(value), (len(pieces), len(index)))


def lcs_length(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, a bit per word of ``a``."""
    at: dict[bytes, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        m = at.get(w)
        if m:
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def document_frequencies(docs: DataFrame, terms: list[bytes]) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and the number of documents, over all of them."""
    index = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros(len(terms), np.int64), 0
        for batch in sub_batches(batches):
            rows += batch.num_rows
            held: list[int] = []
            for text in texts(batch):
                held += map(index.get, index.keys() & set(words_of(text)))
            sums += np.bincount(np.array(held, np.int64), minlength=len(terms))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.flatnonzero(sums), -1)), pa.array(np.append(sums[sums > 0], rows))], names=["term", "n"])

    found = small_batches(docs.select("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(len(terms), np.int64)
    inside = found["term"] >= 0
    df[found["term"][inside]] = found["n"][inside]
    return df, int(found["n"][~inside].sum())


def passages(words: list[bytes], index: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, term) of the vocabulary words of a text, and the starts of its passages that hold any."""
    if len(words) < 256 or not index.keys().isdisjoint(words):
        found = [*map(index.get, words)]
        held = [i for i, t in enumerate(found) if t is not None]
        place, term = np.array(held, np.int64), np.array([found[i] for i in held], np.int32)
    else:
        term, place = np.zeros(0, np.int32), np.zeros(0, np.int64)
    if not len(place):
        return place, term, place
    last = max(0, -(-(len(words) - WIDTH) // STRIDE))        # the last passage that adds words
    slots = {i // STRIDE for i in held}
    slots = {min(max(slot, 0), last) for slot in slots | {slot - 1 for slot in slots}}
    return place, term, np.array(sorted(slots), np.int64) * STRIDE


def _sums(place: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the rows whose place lies in each passage."""
    total = np.concatenate([np.zeros((1, rows.shape[1]), rows.dtype), np.cumsum(rows, 0, dtype=np.float64).astype(rows.dtype)])
    return total[np.searchsorted(place, starts + WIDTH)] - total[np.searchsorted(place, starts)]


def passage_terms(docs: DataFrame, index: dict[bytes, int]) -> DataFrame:
    """The vocabulary words of every passage that holds any, in all documents: how many each passage has, then the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            sizes, terms = [], []
            for text in texts(batch):
                place, term, starts = passages(words_of(text), index)
                for at in range(0, len(starts), PASSAGES):
                    some = starts[at:at + PASSAGES]
                    a, b = np.searchsorted(place, some), np.searchsorted(place, some + WIDTH)
                    sizes.append((b - a).astype(np.int32).tobytes())
                    terms.append(np.concatenate([term[x:y] for x, y in zip(a, b, strict=True)]).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.binary()), pa.array(terms, pa.binary())], names=["sizes", "terms"])

    return small_batches(docs.select("text")).mapInArrow(run, "sizes binary, terms binary")


def _passage_rows(sizes: list[bytes], terms: list[bytes], idf: np.ndarray) -> Iterator[Rows]:
    """The unit TF-IDF rows of stored passages, about ``PASSAGES`` at a time."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for i, pair in enumerate(zip(sizes, terms, strict=True)):
        waiting.append((np.frombuffer(pair[0], np.int32), np.frombuffer(pair[1], np.int32)))
        if i + 1 < len(sizes) and sum(len(n) for n, _ in waiting) < PASSAGES:
            continue
        n = np.concatenate([n for n, _ in waiting])
        key, times = np.unique(np.repeat(np.arange(len(n)), n) * len(idf) + np.concatenate([t for _, t in waiting]), return_counts=True)
        waiting = []
        row, col = key // len(idf), key % len(idf)
        value = times * idf[col]
        norm = np.sqrt(np.bincount(row, value * value, len(n)))
        yield Rows(row, col, value / np.maximum(norm, 1e-9)[row], (len(n), len(idf)))


def _summed(stored: DataFrame, weighted: np.ndarray, ritz: bool) -> np.ndarray:
    """``A' (A M)`` (or ``(A M)' (A M)``, for ``ritz``) over the unit TF-IDF rows A of stored passages; M is ``weighted`` without its idf."""
    idf, m = weighted[:, 0], weighted[:, 1:]
    size = m.shape[1] if ritz else len(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((size, m.shape[1]))
        for batch in sub_batches(batches):
            for rows in _passage_rows(batch.column(0).to_pylist(), batch.column(1).to_pylist(), idf):
                y = rows.times(m)
                if ritz:
                    out += y.T @ y
                else:
                    rows.transposed_times(y, out)
        for lo in range(0, size, SLAB):
            yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([out[lo:lo + SLAB].tobytes()], pa.binary())], names=["slab", "part"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slab": [pdf["slab"].iat[0]], "part": [sum(np.frombuffer(p) for p in pdf["part"]).tobytes()]})

    few = stored.coalesce(max(1, stored.sparkSession.sparkContext.defaultParallelism))      # what travels is one sum a core
    parts = few.mapInArrow(run, "slab long, part binary").groupBy("slab").applyInPandas(add, "slab long, part binary").collect()
    out = np.zeros((size, m.shape[1]))
    for slab, part in parts:
        out[slab:slab + SLAB] = np.frombuffer(part).reshape(-1, m.shape[1])
    return out


def fit(docs: DataFrame, items: list[Item], n_fit: int | None = None) -> Space | None:
    """The latent space of one block of items, fitted on all documents (on about ``n_fit`` of them only if a caller asks)."""
    terms = sorted({w for item in items for w in item.words})
    if not terms:
        return None
    df, n = document_frequencies(docs, terms)
    if not n:
        return None
    of = dict(zip(terms, df.tolist(), strict=True))
    chosen = {t for t in terms if of[t] <= MAX_SHARE * n}
    pieces = [piece for item in items for piece in pieces_of(item.words)]
    for piece in pieces:
        chosen.update(sorted(set(piece), key=lambda w: (of[w], w))[:RAREST])
    vocabulary = sorted(chosen)
    index = {t: i for i, t in enumerate(vocabulary)}
    idf = np.log((n + 1) / (np.array([of[t] for t in vocabulary]) + 0.5)).clip(min=0.05)
    own = tfidf(pieces, index, idf)

    rank = min(RANK + EXTRA, len(vocabulary))
    some = docs if n_fit is None else docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(n)) < n_fit)
    stored = staged(passage_terms(some, index), "fit-passages")
    basis = np.random.default_rng(6).standard_normal((len(vocabulary), rank))
    spread = _summed(stored, np.column_stack([idf, basis]), ritz=False) + len(pieces) * own.transposed_times(own.times(basis))
    q, _ = np.linalg.qr(spread)
    small = _summed(stored, np.column_stack([idf, q]), ritz=True) + len(pieces) * own.times(q).T @ own.times(q)
    values, inner = np.linalg.eigh(small)
    v = q @ inner[:, np.argsort(-values)[:RANK]]
    latent = own.times(v)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return Space(index, (idf[:, None] * v).astype(np.float32), latent.astype(np.float32))


def _narrowed(rare: list[bytes], words: list[bytes]) -> tuple[int, int]:
    """The first shortest prefix of ``words`` with all that ``rare`` has in common order, cut at the front likewise: its first and last place."""
    def end(a: list[bytes], b: list[bytes]) -> int:
        lo, hi, most = 0, len(b), lcs_length(a, b)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if lcs_length(a, b[:mid]) == most else (mid + 1, hi)
        return lo

    b = end(rare, words)
    return b - end(rare[::-1], words[:b][::-1]), b - 1


def _check(words: list[bytes], place: list[int], term: list[int], start: int, item: Item, own: set[int], rare: list[bytes], index: dict[bytes, int]) -> tuple[float, float, int] | None:
    """(share of the item, share of the answer, place) of the common subsequence around a passage; None if too few rare words are in it.

    For an item of several pieces, ``start`` stands for all starts below ``start + len(item.words)``.  ``own`` and ``rare``
    are the item's vocabulary words, as terms and in order.
    """
    n, long = len(item.words), len(item.words) > WIDTH
    lo, hi = (start - n - STRIDE, start + n + WIDTH + n + STRIDE) if long else (start - STRIDE, start + WIDTH + STRIDE)
    a = bisect_left(place, lo)
    b = bisect_left(place, hi, a)
    mine = [p for p, t in zip(place[a:b], term[a:b], strict=True) if t in own]
    if len(mine) < RARE * len(rare) or lcs_length(rare, [words[p] for p in mine]) < RARE * len(rare):      # no subsequence is longer than the text
        return None
    around = AROUND
    if long:      # where the rare words are; the rest of the item may stand on either side
        first, last = _narrowed(rare, [words[p] for p in mine])
        mine = mine[first:last + 1]
        head = next(i for i, w in enumerate(item.words) if w in index)
        tail = next(i for i, w in enumerate(reversed(item.words)) if w in index)
        around = max(AROUND + max(head, tail), n - (mine[-1] + 1 - mine[0]))
    lo = max(0, mine[0] - around)
    text = words[lo:mine[-1] + around + 1]
    return lcs_length(item.words, text) / len(item.words), lcs_length(item.answer, text) / len(item.answer), lo


class Matcher:
    """Finds the items of one block in a text."""

    def __init__(self, space: Space, items: list[Item]):
        self.space, self.items = space, items
        self.terms = [{space.index[w] for w in item.words if w in space.index} for item in items]
        self.rare = [[w for w in item.words if w in space.index] for item in items]
        self.owner = np.repeat(np.arange(len(items)), [len(pieces_of(item.words)) for item in items]).tolist()

    def found(self, text: bytes) -> dict[int, tuple[float, float, float, int]]:
        """item -> (share of the item, share of the answer, cosine, minus the place) of its best passage."""
        index, vectors, latent = self.space
        words = words_of(text)
        place, term, starts = passages(words, index)
        at_word, of_term = place.tolist(), term.tolist()
        best: dict[int, tuple[float, float, float, int]] = {}
        for at in range(0, len(starts), 4096):
            some = starts[at:at + 4096]
            projected = _sums(place, vectors[term], some)
            cosine = projected @ latent.T / np.maximum(np.linalg.norm(projected, axis=1, keepdims=True), 1e-9)
            candidates: dict[tuple[int, int], float] = {}
            near = np.nonzero(cosine >= COSINE)
            for start, piece, c in zip(some[near[0]].tolist(), near[1].tolist(), cosine[near].tolist(), strict=True):
                j = self.owner[piece]
                n = len(self.items[j].words)
                key = j, start // n * n if n > WIDTH else start      # one check of a long item for each stretch of its length
                candidates[key] = max(candidates.get(key, 0.0), c)
            for (j, start), c in candidates.items():
                checked = _check(words, at_word, of_term, start, self.items[j], self.terms[j], self.rare[j], index)
                if checked is None:
                    continue
                share, answer, lo = checked
                if share >= LCS or share >= LCS_ANSWER and answer >= ANSWER:
                    this = (share, answer, round(c, 4), -lo)
                    best[j] = max(best.get(j, this), this)
        return best


def matchers(docs: DataFrame, benchmark: DataFrame) -> Iterator[Matcher]:
    """One matcher per block of the benchmark, each fitted on ``docs``."""
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    blocks = max(1, -(-(bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    for b in range(blocks):      # by id and text: items that share an id, or have none, are in many blocks
        rows = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()      # bound: about BLOCK_BYTES
        items = items_of(sorted(((r["item_id"], r["text"].encode()) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        space = fit(docs, items)
        if space is not None:
            yield Matcher(space, items)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer_share, position of every document that holds a benchmark item."""
    plain = _plain(docs)
    out = plain.limit(0).select(F.col("doc_id"), F.col("doc_id").alias("item_id"), *(F.lit(0.0).alias(c) for c in ("cosine", "lcs_share", "answer_share")),
                                F.col("doc_id").alias("position"))
    for matcher in matchers(plain, benchmark):
        shared = plain.sparkSession.sparkContext.broadcast(matcher)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in sub_batches(batches):
                rows = [(doc_id, shared.value.items[j].item_id, c, s, a, -lo) for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True)
                        for j, (s, a, c, lo) in sorted(shared.value.found(text).items())]
                kinds = [pa.int64()] * 2 + [pa.float64()] * 3 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)],
                                                 names=["doc_id", "item_id", "cosine", "lcs_share", "answer_share", "position"])

        out = out.unionByName(plain.mapInArrow(run, HITS))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    out = docs
    for matcher in matchers(_plain(docs), benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(matcher)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in sub_batches(batches):
                yield batch.filter(pa.array([not shared.value.found(t) for t in texts(batch)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
