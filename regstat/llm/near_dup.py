"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set holds the 64-bit hashes of its different shingles of ``width`` words
(five unless the caller says otherwise; ASCII letters lower-cased; a text of fewer words is one shingle).  The sketch is
the ``K`` smallest hashes.

1. Every row has a key of its own (the id, unless some are null or repeated); equal
   sets are collapsed to their smallest key.
2. Inverted lists: each run of ``RUN`` neighbouring retained values is a list
   key, so two sets meet if their sketches overlap in one such run.  Sets at the
   threshold share dozens of runs, hence each set leaves its most crowded
   lists: a prefix filter over list lengths that keeps any pair with
   ``SHARED`` runs in common.  For sets smaller than the sketch the number of
   shared runs is guaranteed; for larger ones a pair at exactly 0.8 has fewer
   than 6 with a chance of about 2e-6 (simulated), falling fast with the similarity.
3. In every list each member meets one pivot, the first in one of ``ORDERS`` random orders
   of all sets, so lists share pivots (never all pairs); the Jaccard
   estimate from the union's sketch must reach ``LOOSE``.  These links join sets
   to loose families.
4. Exact Jaccard on the full sets: first each set with its best pivot, which
   links most copies; then, inside families of several components, the
   remaining pairs between different components, in blocks of ``BLOCK`` sets (set
   intersections by blocked products; of the links found a task returns a spanning forest); then pairs
   of different families whose lists meet.  Those are found by an exact prefix filter: a pair at 0.8 shares
   one of the rarest fifth (plus one) of each full set's values, under any common order.  So texts that share a template,
   but no more, meet in no list, however many they are.
5. Connected components of the exact links by large-star/small-star rounds.

Defined cases: texts without words have an empty set, link with nothing and
are their own component; rows with a null id get a null component and are kept;
rows that repeat an id are separate documents: a component is named by the
smallest id in it, one row of it is kept, and two components may have the same
name if different texts stand under one id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regstat.llm.common import mix64, small_batches, staged, sub_batches, texts
from regstat.llm.repeats import keyed

PERCENT = 80
K = 64
RUN, SHORT_RUN = 3, 2
SHARED = 6
LOOSE = 0.5
ORDERS = 3                 # random orders of all sets; each list takes its pivot by one of them
BLOCK = 128
COLUMNS = 1 << 13          # set values multiplied at once
MEMO_WORDS = 200_000
WIDTH = 5                  # words of a shingle
ORDER_BITS = 18            # values are ordered by the count of their first bits: a table of fixed size
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: bytes, words_hash: dict, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the different shingles of ``width`` words."""
    words = text.lower().split()
    h = np.fromiter(map(words_hash.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    n = max(len(h) - width + 1, 1)
    key = np.full(n, min(len(h), width), np.uint64)
    for i in range(min(width, len(h))):
        key = mix64(key * _ODD + h[i:i + n])
    return np.unique(key)


def runs(sketch: np.ndarray, size: int) -> np.ndarray:
    """List keys of one set: hashes of each RUN neighbouring values; sets of 4 or 5 also meet in pairs of values."""
    out = []
    for r in ([RUN, SHORT_RUN] if size in (4, 5) else [RUN]):
        if len(sketch) >= r:
            n = len(sketch) - r + 1
            key = np.full(n, r, np.uint64)
            for i in range(r):
                key = mix64(key * _ODD + sketch[i:i + n])
            out.append(key)
    return np.concatenate(out) if out and size >= 4 else np.zeros(0, np.uint64)


def shared_runs(size: int) -> int:
    """Runs that any partner at the threshold surely shares (sets inside their sketch), or shares but for a chance of about 2e-6."""
    if size > K:
        return SHARED
    least = SHARED
    for union in range(size, size * 100 // PERCENT + 1):
        common = -(-PERCENT * union // 100)
        least = min(least, common - (RUN - 1) * (union - common + 1))
    return max(least, 1)


def union_estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard estimate: share of the union's K smallest values that both sketches hold; exact when both sets fit."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    twice = both[1:] == both[:-1]
    first = np.concatenate([[True], ~twice])
    at = np.flatnonzero(first)[:K]
    return float(np.append(twice, False)[at].sum()) / max(len(at), 1)


def sketched(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """key, doc_id, n_shingles, set_key, sketch of every row (key, doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHash()
        for batch in sub_batches(batches):
            sets = [shingles(t, memo, width) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([s[:K].tobytes() for s in sets], pa.binary())], names=["key", "doc_id", "n_shingles", "set_key", "sketch"])

    return small_batches(rows.select("key", "doc_id", "text")).mapInArrow(run, "key long, doc_id long, n_shingles long, set_key binary, sketch binary")


def full_sets(rows: DataFrame, keys: DataFrame, width: int = WIDTH) -> DataFrame:
    """rep and its whole set, from the whole texts of the rows named in ``keys`` (rep)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHash()
        for batch in sub_batches(batches, 256):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t, memo, width).tobytes() for t in texts(batch)], pa.binary())], names=["rep", "members"])

    wanted = rows.select(F.col("key").alias("rep"), "text").join(keys, "rep")
    return wanted.select("rep", "text").mapInArrow(run, "rep long, members binary")


def inverted_lists(reps: DataFrame) -> DataFrame:
    """key, rep, n and the list's pivot, for the lists of two or more sets that the prefix filter keeps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 2048):
            rep, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keys = [runs(np.frombuffer(s, np.uint64), n) for s, n in zip(batch.column(2).to_pylist(), size.tolist(), strict=True)]
            each = np.array([len(k) for k in keys])
            need = np.array([shared_runs(int(n)) for n in size], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(rep, each)), pa.array(np.repeat(size, each)),
                                              pa.array(np.repeat(need, each))], names=["key", "rep", "n", "need"])

    rows = reps.filter("n >= 4").select("rep", "n", "sketch").mapInArrow(run, "key long, rep long, n long, need int")
    by_key = Window.partitionBy("key")
    crowded = rows.withColumn("m", F.count(F.lit(1)).over(by_key)).filter("m > 1")
    left = crowded.withColumn("nth", F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("m"), F.desc("key")))).filter("nth >= need")
    picked = left.withColumn("pivot", F.min(F.struct(F.xxhash64("rep", F.pmod("key", F.lit(ORDERS))).alias("h"), F.col("rep"))).over(by_key).getField("rep"))
    return picked.withColumn("m", F.count(F.lit(1)).over(by_key)).filter("m > 1").select("key", "rep", "n", "pivot")


def _size_fits(a: str, b: str) -> F.Column:
    return (100 * F.least(a, b)) >= PERCENT * F.greatest(a, b)


def estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """a, b, estimate of the pairs (a, b) whose sizes fit and whose union sketch reaches LOOSE."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            est = np.array([union_estimate(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)], float)
            keep = np.flatnonzero(est >= LOOSE)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array(est[keep])], names=["a", "b", "estimate"])

    side = lambda c: reps.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(_size_fits("n_a", "n_b")).select("a", "b", "s_a", "s_b")
    return both.mapInArrow(run, "a long, b long, estimate double")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 256):
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                common = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                if 100 * common >= PERCENT * ((len(x) + len(y)) // 8 - common):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    side = lambda c: sets.select(F.col("rep").alias(c), F.col("members").alias(f"s_{c}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _block_links(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links between rows of different components, by products of the sets' incidence over COLUMNS shared values at a time."""
    def flat(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sets = [np.frombuffer(s, np.uint64) for s in rows["members"]]
        sizes = np.array([len(s) for s in sets])
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes

    (lv, lr, ln), (rv, rr, rn) = flat(left), flat(right)
    shared = np.intersect1d(lv, rv)
    common = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), COLUMNS):
        part = shared[at:at + COLUMNS]

        def incidence(v: np.ndarray, r: np.ndarray, n: int, part: np.ndarray = part) -> np.ndarray:
            pos = np.searchsorted(part, v)
            hit = (pos < len(part)) & (part[np.minimum(pos, len(part) - 1)] == v)
            m = np.zeros((n, len(part)), np.float32)
            m[r[hit], pos[hit]] = 1
            return m
        common += incidence(lv, lr, len(left)) @ incidence(rv, rr, len(right)).T
    common = common.astype(np.int64)
    links = 100 * common >= PERCENT * (ln[:, None] + rn[None, :] - common)
    links &= left["comp"].to_numpy()[:, None] != right["comp"].to_numpy()[None, :]
    return _spanning(left["comp"].to_numpy(), right["comp"].to_numpy(), left["rep"].to_numpy(), right["rep"].to_numpy(), links)


def _spanning(lc: np.ndarray, rc: np.ndarray, lr: np.ndarray, rr: np.ndarray, links: np.ndarray) -> pd.DataFrame:
    """As many of the links as join the same components: a forest over the blocks' components."""
    i, j = np.nonzero(links)
    pairs = pd.DataFrame({"x": np.minimum(lc[i], rc[j]), "y": np.maximum(lc[i], rc[j]), "a": np.minimum(lr[i], rr[j]), "b": np.maximum(lr[i], rr[j])})
    pairs = pairs.drop_duplicates(["x", "y"])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    keep = []
    for x, y in zip(pairs["x"].tolist(), pairs["y"].tolist(), strict=True):
        rx, ry = root(x), root(y)
        keep.append(rx != ry)
        parent[rx] = ry
    return pairs.loc[keep, ["a", "b"]]


def block_links(families: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact links between components of one family (family, comp, rep), each pair of blocks in a task of its own.

    A component of ``BLOCK`` sets or more is dealt to blocks of its own, the
    smaller ones of a family share blocks; pairs of blocks that hold one
    component only are left out.  Sizes are counted by aggregation, so no task
    holds a whole family.
    """
    size = families.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("n"))
    shared = F.sum(F.when(F.col("n") < BLOCK, F.col("n")).otherwise(0))
    mixed = size.groupBy("family").agg(F.count(F.lit(1)).alias("comps"), shared.alias("shared")).filter("comps > 1").drop("comps")

    def dealt(key: str, n: str) -> F.Column:
        return F.pmod(F.xxhash64(key), F.ceil(F.col(n) / BLOCK))
    block = F.when(F.col("n") >= BLOCK, F.concat_ws("-", "comp", dealt("rep", "n"))).otherwise(F.concat(F.lit("s"), dealt("comp", "shared")))
    rows = staged(families.join(size.join(mixed, "family"), ["family", "comp"]).select("family", "comp", "rep", block.alias("block")), "blocks")
    blocks = rows.groupBy("family", "block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    other = blocks.select("family", F.col("block").alias("block2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    duties = (blocks.join(other, "family").filter("block <= block2 and not (lo = hi and lo2 = hi2 and lo = lo2)").select("family", "block", "block2"))
    sides = (duties.withColumn("left", F.lit(True)).unionByName(
        duties.filter("block < block2").select("family", F.col("block2").alias("block"), F.col("block").alias("block2"), F.lit(False).alias("left"))))
    with_rows = (sides.join(rows, ["family", "block"]).join(sets, "rep")
                 .select("family", F.least("block", "block2").alias("b1"), F.greatest("block", "block2").alias("b2"), "left", "rep", "comp", "members"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        mine = pdf[pdf["left"]]
        return _block_links(mine, pdf[~pdf["left"]] if pdf["b1"].iat[0] != pdf["b2"].iat[0] else mine)

    return with_rows.groupBy("family", "b1", "b2").applyInPandas(run, "a long, b long")


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, comp (smallest node reachable) of every node of the edges (a, b); large-star and small-star rounds until nothing changes."""
    ends = lambda e, x, y: e.select(F.col(x).alias("u"), F.col(y).alias("v"))
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    was = None
    while True:
        both = ends(edges, "a", "b").unionByName(ends(edges, "b", "a"))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = staged(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == was:
            break
        was = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(roots)


def links(rows: DataFrame, reps: DataFrame, width: int = WIDTH) -> DataFrame:
    """Exact links (a, b) between sets, enough to join every component: all pairs that share a list are linked, tested or already joined."""
    members = staged(inverted_lists(reps), "lists")
    star = (members.filter("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct())
    loose = staged(estimated(star, reps), "loose-pairs")
    family = staged(components(loose.select("a", "b"), "families"), "family")
    keys = family.select(F.col("node").alias("rep"))
    sets = staged(full_sets(rows, keys, width), "sets")

    ends = loose.select(F.col("a").alias("rep"), "a", "b", "estimate").unionByName(loose.select(F.col("b").alias("rep"), "a", "b", "estimate"))
    best = ends.groupBy("rep").agg(F.max(F.struct("estimate", "a", "b")).alias("x")).select("x.a", "x.b").distinct()
    first = staged(verified(best, sets), "first-links")
    comps = components(first, "first-components")

    named = family.withColumnsRenamed({"node": "rep", "comp": "family"})
    placed = named.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("family", F.coalesce("comp", "rep").alias("comp"), "rep")
    second = staged(block_links(placed, sets), "second-links")

    # sets in lists of several families; pairs with the pivot are tested already
    apart = members.filter("rep <> pivot").join(named, "rep", "left").select("key", "rep", F.coalesce("family", "rep").alias("family"))
    split = apart.groupBy("key").agg(F.min("family").alias("x"), F.max("family").alias("y")).filter("x <> y").select("key")
    outer = staged(apart.join(split, "key").select("rep", "family").distinct(), "apart")
    more = outer.select("rep").join(keys, "rep", "left_anti")
    whole = staged(outer.join(sets.unionByName(full_sets(rows, more, width)), "rep"), "apart-sets")
    third_pairs = staged(estimated(across(whole), reps), "across-pairs")
    third = verified(third_pairs, whole.select("rep", "members"))
    return first.unionByName(second).unionByName(third)


def _order(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def across(whole: DataFrame) -> DataFrame:
    """a, b: pairs of different families that share one of the rarest values of each set; no pair at the threshold is left out.

    ``whole`` has (rep, family, members).  A set of n values at 0.8 with another shares 0.8 n of
    them at least, so one of its first n - 0.8 n + 1 under an order common to all sets is also among
    the other's first ones.  The order puts rare values first.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in sub_batches(batches, 256):
            seen += np.bincount(_order(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)), minlength=1 << ORDER_BITS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["place", "n"])

    counts = np.zeros(1 << ORDER_BITS, np.int64)
    for place, n in whole.select("members").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n")).collect():    # 2 ** ORDER_BITS rows at most
        counts[place] = n
    ranks = whole.sparkSession.sparkContext.broadcast(counts)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 256):
            keys, sizes, each = [], [], []
            for members in batch.column(2).to_pylist():
                v = np.frombuffer(members, np.uint64)
                length = len(v) - -(-PERCENT * len(v) // 100) + 1
                keys.append(v[np.lexsort((v, ranks.value[_order(v)]))[:length]])
                sizes.append(len(v))
                each.append(length)
            repeat = np.repeat(np.arange(len(each)), each)
            if len(repeat):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), batch.column(0).take(pa.array(repeat)), batch.column(1).take(pa.array(repeat)),
                                                  pa.array(np.array(sizes)[repeat])], names=["value", "rep", "family", "n"])

    rare = whole.select("rep", "family", "members").mapInArrow(first, "value long, rep long, family long, n long")
    spread = rare.groupBy("value").agg(F.min("family").alias("x"), F.max("family").alias("y")).filter("x <> y").select("value")
    rare = staged(rare.join(spread, "value"), "rare-values")
    other = rare.select("value", F.col("rep").alias("rep2"), F.col("n").alias("n2"), F.col("family").alias("family2"))
    return (rare.join(other, "value").filter((F.col("rep") < F.col("rep2")) & (F.col("family") != F.col("family2")) & _size_fits("n", "n2"))
            .select(F.col("rep").alias("a"), F.col("rep2").alias("b")).distinct())


def marked(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """key, doc_id, n_shingles, component_id, kept of every row (key, doc_id, text)."""
    found = staged(sketched(rows, width), "sketches")
    reps = staged(found.filter("doc_id is not null and n_shingles > 0").groupBy("set_key")
                  .agg(F.min(F.struct("key", "doc_id")).alias("x"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
                  .select("set_key", F.col("x.key").alias("rep"), F.col("x.doc_id").alias("id"), "n", "sketch"), "sets-of-copies")
    comps = components(links(rows, reps, width), "components").join(reps.select(F.col("rep").alias("comp"), F.col("id").alias("name")), "comp")
    named = (reps.select("set_key", "rep", "id").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .select("set_key", F.coalesce("comp", "rep").alias("comp"), F.coalesce("name", "id").alias("name")))
    out = found.select("key", "doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return out.select("key", "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("name")).alias("component_id"),
                      (alone | (F.col("comp") == F.col("key"))).alias("kept"))


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return marked(keyed(docs), width).drop("key")


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, all columns, that stand for their component; rows with a null id stay."""
    rows = keyed(docs, F.struct(*docs.columns).alias("row"))
    gone = staged(marked(rows, width).filter(~F.col("kept")).select("key"), "copies")
    return rows.join(gone, "key", "left_anti").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
