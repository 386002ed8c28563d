"""Sharding: the key law, gapless places, the versioned map and its edits."""

import struct
import zlib
from collections import Counter

import pytest
import xxhash

from regstat.llm import sharding
from regstat.llm.common import table
from regstat.session import scratch_path

from . import odd


def test_map_grows_only_into_the_new_shard():
    owners = sharding.slot_map(1)
    for n in range(1, 45):
        grown = sharding.grow(owners, n)
        moved = [(a, b) for a, b in zip(owners, grown, strict=True) if a != b]
        assert {b for _, b in moved} == {n} and len(moved) == sharding.SLOTS // (n + 1)
        assert sharding.slot_map(n + 1) == grown
        sizes = Counter(grown).values()
        assert max(sizes) - min(sizes) <= 2
        owners = grown


def test_rebalance_evens_bytes():
    owners = sharding.slot_map(8, 256)
    size = {s: 1000 + 37 * (s % 11) + (40_000 if owners[s] == 3 and s % 2 else 0) for s in range(256)}
    edited = sharding.rebalance(owners, size, 8)
    load = Counter()
    for s, shard in enumerate(edited):
        load[shard] += size[s]
    before = sum(size[s] for s in range(256) if owners[s] == 3)
    assert max(load.values()) < before / 2 and max(load.values()) - min(load.values()) <= 41_400
    assert sharding.rebalance([0] * 4, {}, 2) == [0] * 4


def test_matches_plain_version(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    now, then = sharding.slot_map(40), sharding.slot_map(41)
    out = sharding.shard(docs, 40).collect()
    assert len(out) == len(rows)
    places = {}
    for r in out:
        slot = xxhash.xxh64_intdigest(struct.pack("<q", r["doc_id"]), seed=42)
        slot = (slot - (1 << 64) if slot >> 63 else slot) % sharding.SLOTS
        assert (r["shard"], r["grown_shard"], r["virtual_slot"], r["law"]) == (now[slot], then[slot], slot, "key")
        assert r["size"] == len(rows[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(rows[r["doc_id"]])
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    # the law: other rows don't matter
    some = sharding.shard(docs.filter("doc_id < 40"), 40).collect()
    assert {(r["doc_id"], r["shard"]) for r in some} <= {(r["doc_id"], r["shard"]) for r in out}


def test_stored_map_and_stats(spark):
    path, docs = scratch_path(spark, "map"), table(spark, "/root/testdata/sf0.001", "documents")
    out = sharding.shard(docs, 5, 64, path).collect()
    assert [r["shard"] for r in sharding.read_map(spark, path, 5).orderBy("virtual_slot").collect()] == sharding.slot_map(5, 64)
    assert [r["shard"] for r in sharding.read_map(spark, path, 6).orderBy("virtual_slot").collect()] == sharding.slot_map(6, 64)
    stats = spark.read.parquet(f"{path}-stats/version=5").collect()
    assert sum(r["bytes"] for r in stats) == sum(r["size"] for r in out) and sum(r["rows"] for r in stats) == len(out)
    sharding.write_shards(docs, f"{path}-data", path, 5, 64)
    written = spark.read.parquet(f"{path}-data").select("doc_id", "shard").collect()
    assert {(r["doc_id"], r["shard"]) for r in written} == {(r["doc_id"], r["shard"]) for r in out}


def test_no_python_in_the_plan(spark):
    plan = sharding.shard(table(spark, "/root/testdata/sf0.001", "documents"), 40)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan


@pytest.mark.parametrize("some", [None, []])
def test_odd_cases(spark, some):
    docs = odd.docs(spark, some)
    out = sharding.shard(docs, 3).collect()
    assert len(out) == docs.count()
    places = {}
    for r in out:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(r["size"] == 16 and r["text_crc32"] == 0 for r in out if r["doc_id"] == 5)
