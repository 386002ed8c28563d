"""Suffix sums along linked lists, by rulers and pointer jumping.

A list is a table (arc, nxt, weights): every arc names the next one, the last names
none.  Every arc jumps along the list, doubling its stride, until it stands before
a ruler (an arc chosen by a hash, one in ``STRIDE``) or the end; so about
log2(STRIDE * ln n) rounds shuffle the whole table, and the rulers alone, each with
the sum up to the next ruler, form a list ``STRIDE`` times shorter.  That one is
ranked the same way; a list of at most ``ALONE`` rulers is jumped to its end.  No
arc has two predecessors, so no join key is hot.  Each round is written to the
shared scratch folder and read back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstat.llm.common import staged

STRIDE, ALONE = 32, 65_536


def _jumped(links: DataFrame, weights: Sequence[str], stops: Column) -> DataFrame:
    """Every arc with the first stop after it as ``nxt`` and the weights summed up to there; ``stops`` is a condition on ``nxt``."""
    flagged = lambda df: df.withColumn("open", F.coalesce(F.col("nxt").isNotNull() & ~stops, F.lit(False)))
    state = staged(flagged(links), "list")
    while not state.filter("open").isEmpty():
        there = state.select(F.col("arc").alias("nxt"), F.col("nxt").alias("then"), *[F.col(w).alias(f"{w}_then") for w in weights])
        moved = state.filter("open").join(there, "nxt").select("arc", F.col("then").alias("nxt"), *[(F.col(w) + F.col(f"{w}_then")).alias(w) for w in weights])
        state = staged(state.filter("not open").unionByName(flagged(moved)), "list")
    return state.drop("open")


def suffix_sums(links: DataFrame, weights: Sequence[str], level: int = 0) -> DataFrame:
    """(arc, weights): the sums from each arc, itself included, to the end of its list."""
    ruler = lambda arc: F.pmod(F.xxhash64(F.lit(level), arc), F.lit(STRIDE)) == 0
    near = _jumped(links, weights, ruler(F.col("nxt")))
    rulers = staged(near.filter(ruler(F.col("arc"))), "rulers")
    if rulers.count() > ALONE:
        far = suffix_sums(rulers, weights, level + 1)
    else:
        far = _jumped(rulers, weights, F.lit(False)).drop("nxt")
    far = far.select(F.col("arc").alias("nxt"), *[F.col(w).alias(f"{w}_then") for w in weights])
    return near.join(far, "nxt", "left").select("arc", *[(F.col(w) + F.coalesce(f"{w}_then", F.lit(0))).alias(w) for w in weights])
