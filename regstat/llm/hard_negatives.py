"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

Components become integers, floor(256 * x); a row's score is its integer inner
product with the anchor.  Rows are dealt into blocks of about ``BLOCK`` rows by a
hash, anchors into chunks of about ``CHUNK``.  A task takes one chunk of anchors and
then one block after another: it sorts the block once in every dimension, and for
each anchor reads the lists from the end that its sign prefers (sorted access),
scores every row met (random access, exact integers) and stops once the threshold,
the score of the last values read, falls strictly below the kth score of each of the
anchor's windows, or below the window's lower bound.  The kth scores go along from
block to block of a task.  What a task returns is at most k rows a window, and Spark
ranks them over all tasks.

Two searches follow each other: the first ``POSITIVES`` other rows of the anchor's
label, then, for each of them, the first ``NEGATIVES`` rows of other labels whose
score lies between 30 % and 90 % of the positive's.  No row is left out at any size:
every block meets every chunk of the stated query set.

Defined cases.  Rows with a null label, a null vector or a null or non-finite
component take no part.  An anchor's "other rows" are all rows but itself, so a
repeated row counts as another row, and repeated anchors are searched each for
itself.  A row without an id is no anchor and comes after equal scores of rows with
one.  Shorter vectors are filled up with zeros; an empty vector scores 0.  Components
beyond 2**56 stay there; scores are exact at any size (Python integers where
floats could round) and only shown at a long's ends beyond it.  A positive with a
negative score has no negatives.  Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regstat.llm.common import staged

SCALE, ANCHOR_EVERY, MOVED_EVERY, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOWEST, HIGHEST = 30, 90            # percent of the positive's score
#: Rows of a block, anchors of a chunk, and blocks that one task meets in a row.
BLOCK, CHUNK, RUN = 4096, 256, 4
FIRST_DEPTH = 128
LONG, MOST = 2**63 - 1, 2.0**56
FOUND = "anchor long, place int, other long, id long, score long, exact string"


def prepared(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(row, id, label, vec): the rows that take part, in integers, every vector of the same length."""
    x = F.col("`" + vector.replace("`", "``") + "`").cast("array<double>")
    whole = x.isNotNull() & ~F.exists(x, lambda c: F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(True)))
    moved = F.coalesce(F.col("vec_id") % MOVED_EVERY == 0, F.lit(False))
    label = F.col("label").cast("long")
    part = rows.filter(label.isNotNull() & whole).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"),
        F.when(moved, (label + 1) % LABELS).otherwise(label).alias("label"), F.transform(x, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(MOST)), F.lit(-MOST))).cast("long")).alias("vec"))
    part = staged(part, "vectors")
    size = part.agg(F.coalesce(F.max(F.size("vec")), F.lit(0))).first()[0]
    return part.withColumn("vec", F.when(F.size("vec") == size, F.col("vec")).otherwise(
        F.concat("vec", F.array_repeat(F.lit(0).cast("long"), (F.lit(size) - F.size("vec"))))))


def anchors(part: DataFrame) -> DataFrame:
    return part.filter(F.col("id") % ANCHOR_EVERY == 0)


def _packed(df: DataFrame, n: int, name: str) -> DataFrame:
    """``n`` groups of about equal size by a hash of the row: (name, rows)."""
    return df.groupBy(F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(name)).agg(
        F.collect_list(F.struct("row", "id", "label", "vec", "windows")).alias("rows"))


def search(part: DataFrame, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The first ``k`` rows of each window of each query: (anchor, place, other, id, score, exact).

    ``queries`` has the columns of ``part`` and ``windows``, an array of (place, of): the window between
    ``LOWEST`` and ``HIGHEST`` percent of the score ``of`` (as text), an open one if that is null.
    ``exact`` is the score as text where it lies beyond a long.
    """
    n_blocks = -(-part.count() // BLOCK) or 1
    n_chunks = -(-queries.count() // CHUNK) or 1
    runs = -(-n_blocks // RUN)
    none = F.array().cast("array<struct<place:int,of:string>>").alias("windows")
    chunks = _packed(queries, n_chunks, "chunk").select(F.lit(0).alias("kind"), "chunk", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), F.lit(-1).alias("block"), "rows")
    blocks = _packed(part.select("row", "id", "label", "vec", none), n_blocks, "block").select(
        F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"), (F.col("block") % runs).alias("run"), "block", "rows")
    dealt = chunks.unionByName(blocks).repartition(n_chunks * runs, "chunk", "run").sortWithinPartitions("chunk", "run", "kind", "block")
    return dealt.mapInArrow(_searcher(k, same_label), FOUND)


class _Rows:
    """The rows of a chunk or a block as arrays, in the order of their ids."""

    def __init__(self, rows: pa.StructScalar | pa.ListScalar):
        values = rows.values
        self.row = values.field("row").to_numpy(zero_copy_only=False)
        ids = values.field("id")
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.label = values.field("label").to_numpy(zero_copy_only=False)
        flat = values.field("vec").flatten().to_numpy(zero_copy_only=False)
        self.vec = flat.reshape(len(self.row), -1) if len(flat) else np.zeros((len(self.row), 0), dtype=np.int64)
        self.windows = values.field("windows").to_pylist()
        order = np.lexsort((self.row, self.id, self.null))
        for name in ("row", "null", "id", "label", "vec"):
            setattr(self, name, getattr(self, name)[order])
        self.windows = [self.windows[i] for i in order]

    def bound(self) -> int:
        return max(abs(int(self.vec.max())), abs(int(self.vec.min()))) if self.vec.size else 0


def _numbers(rows: _Rows, other: _Rows):
    """The number type in which every score of these rows is exact."""
    most = rows.bound() * other.bound() * max(1, rows.vec.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


class _Lists:
    """A block with its per-dimension sorted lists."""

    def __init__(self, rows: _Rows, kind):
        self.rows, self.vec = rows, rows.vec.astype(kind)
        self.order = np.argsort(rows.vec.T, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.vec.T, self.order, axis=1)


def first_rows(lists: _Lists, anchor: np.ndarray, eligible: np.ndarray, windows: list, held: list, k: int) -> list[np.ndarray]:
    """Places (in id order) of the eligible rows that may be among the first ``k`` of each window [lo, hi], by sorted and random access.

    ``held`` are the scores found for each window so far.
    """
    n = len(lists.vec)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    met, scores, got = np.zeros(n, dtype=bool), np.zeros(n, dtype=lists.vec.dtype), np.zeros(0, dtype=np.int64)
    at, to = 0, min(n, FIRST_DEPTH if len(up) + len(down) else n)
    while True:
        fresh = np.zeros(n, dtype=bool)
        if len(up) + len(down):
            fresh[lists.order[up, n - to: n - at].ravel()] = True                  # sorted access: large values first where the sign is plus
            fresh[lists.order[down, at:to].ravel()] = True
        else:
            fresh[:] = True
        fresh &= ~met
        met |= fresh
        new = np.flatnonzero(fresh & eligible)
        scores[new] = lists.vec[new] @ anchor                                      # random access
        got = np.concatenate([got, new])
        if to == n:
            break
        threshold = lists.sorted[up, n - to] @ anchor[up] + lists.sorted[down, to - 1] @ anchor[down]
        some = scores[got]
        above = some > threshold
        if all((lo is not None and threshold < lo) or int(np.count_nonzero(above if hi is None else above & (some <= hi))) + sum(s > threshold for s in old) >= k
               for (lo, hi), old in zip(windows, held, strict=True)):
            break
        at, to = to, min(n, 2 * to)
    got.sort()
    some, out = scores[got], []
    for lo, hi in windows:
        inside = np.ones(len(got), dtype=bool)
        if lo is not None:
            inside &= some >= lo
        if hi is not None:
            inside &= some <= hi
        mine = np.flatnonzero(inside)
        first = np.argsort(-some[mine], kind="stable")[:k]                         # equal scores stay in id order
        out.append((got[mine[first]], some[mine[first]]))
    return out


def _window(of: str | None) -> tuple[int | None, int | None]:
    """The whole scores from ``LOWEST`` to ``HIGHEST`` percent of a score."""
    return (None, None) if of is None else (-(-LOWEST * int(of) // 100), HIGHEST * int(of) // 100)


def _searcher(k: int, same_label: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = best = None
        for batch in batches:
            for i in range(batch.num_rows):
                kind, key = batch["kind"][i].as_py(), (batch["chunk"][i].as_py(), batch["run"][i].as_py())
                if kind == 0:
                    if chunk is not None:
                        yield _shown(chunk, best)
                    chunk = _Rows(batch["rows"][i])
                    windows = [[_window(w["of"]) for w in ws] for ws in chunk.windows]
                    best, held_key = [[[] for _ in ws] for ws in windows], key
                elif chunk is not None and key == held_key:
                    block = _Rows(batch["rows"][i])
                    number = _numbers(chunk, block)
                    lists, anchors_ = _Lists(block, number), chunk.vec.astype(number)
                    for a in range(len(chunk.row)):
                        if not windows[a]:
                            continue
                        eligible = (block.label == chunk.label[a]) & (block.row != chunk.row[a]) if same_label else block.label != chunk.label[a]
                        old = [[s for s, *_ in b] for b in best[a]]
                        for b, (places, scores) in zip(best[a], first_rows(lists, anchors_[a], eligible, windows[a], old, k), strict=True):
                            b += [(int(s), bool(block.null[p]), int(block.id[p]), int(block.row[p])) for p, s in zip(places, scores, strict=True)]
                            b.sort(key=lambda t: (-t[0], *t[1:]))
                            del b[k:]
        if chunk is not None:
            yield _shown(chunk, best)
    return run


def _shown(chunk: _Rows, best: list) -> pa.RecordBatch:
    out = [(int(chunk.row[a]), w["place"], row, None if null else i, max(-LONG - 1, min(LONG, s)), None if abs(s) <= LONG else str(s))
           for a in range(len(chunk.row)) for w, found in zip(chunk.windows[a], best[a], strict=True) for s, null, i, row in found]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.record_batch([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names=["anchor", "place", "other", "id", "score", "exact"])


def _by_score() -> list[Column]:
    """Higher scores first, whole where they lie beyond a long, then smaller ids."""
    return [F.coalesce(F.col("exact").cast("decimal(38,0)"), F.col("score").cast("decimal(38,0)")).desc(), F.col("id").asc_nulls_last(), F.col("other").asc()]


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*_by_score())))
    return ranked.filter(F.col("rank") <= k)


def positives(part: DataFrame, asked: DataFrame) -> DataFrame:
    """The first ``POSITIVES`` other rows of each anchor's label: (anchor, rank, id, score, exact)."""
    open_window = F.array(F.struct(F.lit(0).alias("place"), F.lit(None).cast("string").alias("of"))).alias("windows")
    return _first(search(part, asked.select("*", open_window), POSITIVES, True), POSITIVES, "anchor").drop("place", "other")


def mine(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive."""
    part = prepared(rows, vector)
    asked = anchors(part)
    near = staged(positives(part, asked), "positives")
    bounds = near.select("anchor", F.struct(F.col("rank").cast("int").alias("place"), F.coalesce("exact", F.col("score").cast("string")).alias("of")).alias("window"))
    windows = bounds.groupBy("anchor").agg(F.array_sort(F.collect_list("window")).alias("windows"))
    again = asked.join(windows.withColumnRenamed("anchor", "row"), "row").select("row", "id", "label", "vec", "windows")
    found = _first(search(part, again, NEGATIVES, False), NEGATIVES, "anchor", "place")
    named = near.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(named, ["anchor", "place"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
