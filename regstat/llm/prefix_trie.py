"""Trie of conversation prefixes by the Euler-tour technique.

Every conversation is rebuilt: its first h turns are those of conversation
c - c % 100, h = crc32(decimal c) % 6, and its own turns after its first h follow.
Each distinct sequence of first d turns is a node, from the empty root on.

1. *Places.* Turns are dealt out by ranges of (conversation, turn, role, text) and
   numbered inside each range; the counts of the ranges, a few rows per conversation,
   give the offsets.  From here on a turn is a 128-bit hash of its role and text.
2. *Nodes.* The name of a prefix is the exclusive or of its turns' hashes, each taken with
   its depth: it adds up over ranges like a count, and the parent's name is one turn taken
   off.  One partial aggregation by name makes the nodes.
3. *Arcs.* Each node has an enter and an exit arc.  Children are linked inside
   ``BUCKETS`` hash buckets of their parent, and buckets to each other, so a parent of
   a third of all nodes is no hot key.
4. *Ranks.* The tour is ranked by ``list_ranking``; leaves and savings are weights on the enter
   arcs, and a subtree's sums are the difference between its enter and its exit.
5. *Ends.* Ids that end at a node are listed in runs of 2**``RUN_BITS`` ids, sorted, and hashed run
   after run in a stream.  SHA-256 has to take one node's ids in one row of steps; the task holds one run at a time.

Defined cases: a null role or text is empty; null turns come first; equal turns of
a conversation are ordered by role, then text, and repeated rows are turns of their
own.  Rows without a conversation id belong to no conversation and are left out; an
empty table has no root.  Two different prefixes would be taken for one if both of
their 64-bit hashes agreed.  Extra columns are ignored.  Turns equal in all columns share a range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regstat.llm.common import staged
from regstat.llm.list_ranking import suffix_sums

GROUP, MOST_SHARED = 100, 5
BUCKETS, RUN_BITS = 64, 13


def _tags(depth: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), depth, F.col("k1"), F.col("k2")) for seed in (1, 2)]


def placed(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, part, pos, k1, k2, chars) and conversations (conv, root, n, h, shared): each turn with its place in its own conversation."""
    body = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", body("role").alias("role"), body("text").alias("text"))
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    dealt = staged(turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.monotonically_increasing_id().alias("at"), F.xxhash64(F.lit(1), "role", "text").alias("k1"),
        F.xxhash64(F.lit(2), "text", "role").alias("k2"), F.length("text").cast("long").alias("chars")), "turns")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    ranges = dealt.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = staged(ranges.select("conv", "part", "first", "n", before.alias("before")), "ranges")
    convs = ranges.groupBy("conv").agg(F.sum("n").alias("n")).withColumn("root", F.col("conv") - F.col("conv") % GROUP).withColumn(
        "h", F.crc32(F.col("conv").cast("string").cast("binary")) % 6)
    roots = convs.filter("conv = root").select("root", F.col("n").alias("n_root"))
    convs = staged(convs.join(roots, "root", "left").select("conv", "root", "n", "h", F.least("h", F.coalesce("n_root", F.lit(0))).alias("shared")), "convs")
    known = ranges.select("conv", "part", "first", "before").join(convs.select("conv", "h", "shared"), "conv")
    turns = dealt.join(known, ["conv", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before") + 1)
    return turns.select("conv", "part", "pos", "h", "shared", "k1", "k2", "chars"), convs


def members(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, p1, p2, q1, q2, chars, ends): each prefix of each rebuilt conversation by name (p1, p2), its parent's name and its last turn's length."""
    own = turns.filter("pos > h").select("conv", "part", (F.col("shared") + F.col("pos") - F.col("h")).alias("depth"), "k1", "k2", "chars")
    heads = turns.filter((F.col("conv") % GROUP == 0) & (F.col("pos") <= MOST_SHARED)).select(F.col("conv").alias("root"), F.col("pos").alias("depth"), "k1", "k2", "chars")
    given = convs.select("conv", "root", "h").join(heads, "root").filter("depth <= h").select("conv", F.lit(-1).cast("long").alias("part"), "depth", "k1", "k2", "chars")
    rebuilt = own.unionByName(given)
    t1, t2 = _tags(F.col("depth"))
    tagged = rebuilt.select("conv", "part", "depth", "chars", t1.alias("t1"), t2.alias("t2"))
    inside = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = staged(tagged.select("*", F.bit_xor("t1").over(inside).alias("x1"), F.bit_xor("t2").over(inside).alias("x2")), "running")
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = running.groupBy("conv", "part").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    sums = sums.select("conv", "part", *[F.coalesce(F.bit_xor(f"s{i}").over(earlier), F.lit(0).cast("long")).alias(f"b{i}") for i in (1, 2)])
    length = convs.select("conv", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    named = running.join(sums.join(length, "conv"), ["conv", "part"])
    name = [F.col(f"x{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)]
    return named.select("conv", "depth", name[0].alias("p1"), name[1].alias("p2"), name[0].bitwiseXOR(F.col("t1")).alias("q1"),
                        name[1].bitwiseXOR(F.col("t2")).alias("q2"), "chars", (F.col("depth") == F.col("length")).alias("ends"))


def digests(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, sha): SHA-256 of the sorted ids (conv) that end at each node."""
    order = ["depth", "p1", "p2", "conv"]
    run = F.shiftright(F.monotonically_increasing_id(), RUN_BITS)
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("run", run)
    runs = dealt.groupBy("depth", "p1", "p2", "run").agg(F.min("conv").alias("first"), F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))).alias("ids"))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for frame in frames:
            out = []
            for depth, p1, p2, ids in zip(frame["depth"], frame["p1"], frame["p2"], frame["ids"], strict=True):
                if (depth, p1, p2) != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (depth, p1, p2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["depth", "p1", "p2", "sha"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["depth", "p1", "p2", "sha"])

    return (runs.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "first", "run")
            .select("depth", "p1", "p2", "ids").mapInPandas(hashed, "depth long, p1 long, p2 long, sha string"))


def nodes(found: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: (node, depth, p1, p2, q1, q2, conv_id, n_convs, chars)."""
    made = found.groupBy("depth", "p1", "p2").agg(F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("conv").alias("conv_id"),
                                                 F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), none.alias("q1"), none.alias("q2"), "conv_id", "n_convs", zero.alias("chars"))
    return staged(made.unionByName(root).withColumn("node", F.monotonically_increasing_id()), "nodes")


def linked(made: DataFrame) -> DataFrame:
    """Nodes with ``parent``, ``parent_conv_id``, ``first_child``, ``sibling`` (null: none) and ``n_children``."""
    family = ["up", "q1", "q2", "bucket"]
    children = made.filter("depth > 0").select("node", (F.col("depth") - 1).alias("up"), "q1", "q2", F.pmod(F.xxhash64("node"), F.lit(BUCKETS)).alias("bucket"))
    parents = made.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("depth").alias("up"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    families = children.groupBy(*family).agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).join(parents, ["up", "q1", "q2"])
    families = staged(families.withColumn("after", F.lead("first").over(Window.partitionBy("parent").orderBy("bucket"))), "families")
    beside = children.withColumn("beside", F.lead("node").over(Window.partitionBy(*family).orderBy("node")))
    placed_ = beside.join(families, family).select("node", "parent", "parent_conv_id", F.coalesce("beside", "after").alias("sibling"))
    below = families.groupBy(F.col("parent").alias("node")).agg(F.min_by("first", "bucket").alias("first_child"), F.sum("n").alias("n_children"))
    tree = made.join(placed_, "node", "left").join(below, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return staged(tree, "tree")


def tour(tree: DataFrame) -> DataFrame:
    """The Euler tour (arc, nxt, leaves, saved): a node's enter arc is 2 * node, its exit arc 2 * node + 1."""
    enter = tree.select((F.col("node") * 2).alias("arc"), F.coalesce(F.col("first_child") * 2, F.col("node") * 2 + 1).alias("nxt"),
                        (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    leave = tree.select((F.col("node") * 2 + 1).alias("arc"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("nxt"),
                        F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    return enter.unionByName(leave)


def trie(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = placed(conversations)
    found = staged(members(turns, convs), "members")
    zero = F.lit(0).cast("long")
    turnless = convs.filter((F.col("shared") == 0) & (F.col("n") <= F.col("h"))).select("conv", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"))
    sha = digests(found.filter("ends").select("conv", "depth", "p1", "p2").unionByName(turnless))
    tree = linked(nodes(found, convs))
    ranked = suffix_sums(tour(tree), ["leaves", "saved"])
    signed = lambda c: F.sum(F.when(F.col("arc") % 2 == 0, F.col(c)).otherwise(-F.col(c))).alias(c)
    sums = ranked.groupBy(F.shiftright("arc", 1).alias("node")).agg(signed("leaves"), signed("saved"))
    return tree.join(sums, "node").join(sha, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
