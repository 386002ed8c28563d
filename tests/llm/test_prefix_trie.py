"""Conversation prefix trie: against a dictionary of prefixes, hot conversations and parents, list ranking alone, odd cases."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from regstat.llm import list_ranking, prefix_trie, queries
from regstat.llm.common import table

SCHEMA = "conv_id long, turn int, role string, text string"


def plain(rows):
    """rows of (conv_id, turn, role, text) → the result, from a dictionary of prefixes."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h, sign = zlib.crc32(str(c).encode()) % 6, 1 if c >= 0 else -1
        built[c] = own.get(c - sign * (abs(c) % 100), [])[:h] + ts[h:]
    node = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            node.setdefault(tuple(ts[:d]), []).append(c)
    leaves, saved, children = dict.fromkeys(node, 0), dict.fromkeys(node, 0), dict.fromkeys(node, 0)
    for name in sorted(node, key=len, reverse=True):
        leaves[name] += children[name] == 0
        saved[name] += (len(node[name]) - 1) * (len(name[-1][1]) if name else 0)
        if name:
            up = name[:-1]
            children[up] += 1
            leaves[up] += leaves[name]
            saved[up] += saved[name]
    out = []
    for name, who in node.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(built[c]) == len(name)))
        out.append((min(who), len(name), min(node[name[:-1]]) if name else None, len(who), children[name], leaves[name], saved[name], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted([tuple(r) for r in prefix_trie.trie(df).collect()], key=str)


def test_whole_table_matches_dictionary(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted([tuple(r) for r in queries.op11_prefix_trie(spark, sf).collect()], key=str) == plain(rows)


def test_hot_conversation_hot_parent_and_copies(spark, monkeypatch):
    monkeypatch.setattr(list_ranking, "ALONE", 10)                     # several levels of rulers
    monkeypatch.setattr(prefix_trie, "RUN_BITS", 2)                    # several runs of ids a node
    rng = random.Random(4)
    rows = [(7, t, "user", f"turn {t}") for t in range(900)]           # one conversation of a third of all turns
    rows += [(c, 0, "user", f"first {c}") for c in range(400, 900)]    # a root with hundreds of children
    rows += [(c, t, "bot", f"same {t}") for c in range(1000, 1150) for t in range(3)]
    rows += [(c, t, rng.choice("ab"), f"x{rng.randrange(2)}") for c in range(2000, 2040) for t in range(rng.randrange(1, 9))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert run(df) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 0, "bot", None), (1, 0, None, "hi"), (2, 0, "", "日本😀"),
            (None, 0, "user", "lost"), (100, 1, "user", ""), (101, 5, "user", "x" * 10_000), (-5, 0, "user", "neg"), (-105, 0, "user", "neg"), (0, 0, "user", "zero"), (150, -1, "a", "b")]
    df = spark.createDataFrame([(*r, "n", 1, 2) for r in rows], SCHEMA + ", depth string, part int, node long")
    assert run(df) == plain(rows)
    assert run(spark.createDataFrame([], SCHEMA)) == [] and run(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 >= 2)       # its own turn is replaced, and 200 is absent
    rows = [(c, 0, "user", "gone")]
    assert run(spark.createDataFrame(rows, SCHEMA)) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())] == plain(rows)


def test_list_ranking_of_shuffled_lists(spark, monkeypatch):
    monkeypatch.setattr(list_ranking, "ALONE", 5)
    rng, n = random.Random(9), 3_000
    order = rng.sample(range(10**12), n)
    cut = {order[1_000], order[2_500]}                                                   # three lists
    links = [(a, None if a in cut or i + 1 == n else order[i + 1], i % 7, 1) for i, a in enumerate(order)]
    got = {r["arc"]: (r["w"], r["one"]) for r in list_ranking.suffix_sums(spark.createDataFrame(links, "arc long, nxt long, w long, one long"), ["w", "one"]).collect()}
    sums, want = (0, 0), {}
    for arc, nxt, w, one in reversed(links):
        sums = (w, one) if nxt is None else (sums[0] + w, sums[1] + one)
        want[arc] = sums
    assert got == want
    assert list_ranking.suffix_sums(spark.createDataFrame([], "arc long, nxt long, w long"), ["w"]).agg(F.count("*")).first()[0] == 0
