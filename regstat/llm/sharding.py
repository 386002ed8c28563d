"""Sharding over fixed virtual slots (built-in functions only).

A record's slot is ``pmod(xxhash64(doc_id), slots)`` and never changes.  A
small versioned map says which shard owns each slot; growing or rebalancing
edits the map, so only the edited slots' records move.  Bytes and rows are
aggregated per slot and stored beside the map for the rebalancing edits.

The query keeps the ``key`` law: the id and the number of shards decide.
:func:`slot_map` for n shards is the chain of edits 1 -> 2 -> ... -> n, each
giving the new shard an equal share of slots taken from the fullest shards,
so one more shard takes rows only into itself.

Defined cases: a null id hashes to one slot of its own; a null text counts
no bytes and has the checksum of the empty text; repeated rows all stay and
get places of their own; an empty table gives an empty result; other columns
of the input are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regstat.llm.common import staged
from regstat.session import scratch_path

SLOTS = 4096
OVERHEAD = 16      # bytes added to each record's size


def grow(owners: list[int], new_shard: int) -> list[int]:
    """The map edited for one more shard: it takes its equal share of slots, each from the shard then fullest."""
    owned: dict[int, list[int]] = {s: [] for s in range(new_shard)}
    for slot, shard in enumerate(owners):
        owned[shard].append(slot)
    edited = list(owners)
    for _ in range(len(owners) // (new_shard + 1)):
        fullest = max(owned, key=lambda s: (len(owned[s]), -s))
        edited[owned[fullest].pop()] = new_shard
    return edited


def slot_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Owner of each slot for ``shards`` shards; depends on nothing else."""
    owners = [0] * slots
    for s in range(1, shards):
        owners = grow(owners, s)
    return owners


def rebalance(owners: list[int], slot_bytes: dict[int, int], shards: int) -> list[int]:
    """The map edited until shards' bytes can't be made closer by moving one slot from the fullest to the emptiest."""
    edited, load = list(owners), [0] * shards
    for slot, shard in enumerate(owners):
        load[shard] += slot_bytes.get(slot, 0)
    while True:
        hi, lo = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
        fits = [(slot_bytes.get(i, 0), i) for i, s in enumerate(edited) if s == hi and 0 < slot_bytes.get(i, 0) < load[hi] - load[lo]]
        if not fits:
            return edited
        size, slot = min(fits, key=lambda x: (abs(2 * x[0] - (load[hi] - load[lo])), x[1]))
        edited[slot], load[hi], load[lo] = lo, load[hi] - size, load[lo] + size


def map_frame(spark: SparkSession, owners: list[int], version: int) -> DataFrame:
    """One row per slot: version, slot, shard."""
    return spark.range(1).select(F.lit(version).alias("version"),
                                 F.posexplode(F.from_json(F.lit(json.dumps(owners)), "array<int>")).alias("virtual_slot", "shard"))


def write_map(spark: SparkSession, path: str, owners: list[int], version: int) -> None:
    """Adds one version of the map; earlier versions stay readable."""
    map_frame(spark, owners, version).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("version") == version).select("virtual_slot", "shard")


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of each record."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_stats(records: DataFrame) -> DataFrame:
    """Rows and bytes per slot: at most ``slots`` rows."""
    return records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))


def shard(docs: DataFrame, shards: int, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Each record's shard, its place in the shard (gapless from 0) and its shard after one more is added.

    Places count by slot, then by id inside the slot: numbering runs over the
    thousands of slots in parallel and only the slots' row counts (at most
    ``slots`` rows) are summed per shard.
    """
    spark = docs.sparkSession
    records = staged(sized(docs, slots), "shard-records")
    path = map_path or scratch_path(spark, "shard-map")
    owners = slot_map(shards, slots)
    write_map(spark, path, owners, shards)
    write_map(spark, path, grow(owners, shards), shards + 1)
    stats = slot_stats(records)
    stats.write.mode("overwrite").parquet(f"{path}-stats/version={shards}")
    now, then = read_map(spark, path, shards), read_map(spark, path, shards + 1).withColumnRenamed("shard", "grown_shard")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    owned = (now.join(then, "virtual_slot")
             .join(spark.read.parquet(f"{path}-stats/version={shards}").select("virtual_slot", "rows"), "virtual_slot", "left")
             .withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows"))
    placed = records.withColumn("at", F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1)
    return (placed.join(F.broadcast(owned), "virtual_slot")      # bound: one row per slot
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("base") + F.col("at")).cast("long").alias("slot"),
                    "grown_shard", "virtual_slot"))


def write_shards(docs: DataFrame, path: str, map_path: str, version: int, slots: int = SLOTS) -> None:
    """The records themselves, one folder per shard, by a stored version of the map."""
    owners = read_map(docs.sparkSession, map_path, version)
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(slots)).cast("int")
    plain = docs.drop("shard", "virtual_slot")
    (plain.withColumn("virtual_slot", slot).join(F.broadcast(owners), "virtual_slot").hint("rebalance", "shard")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
