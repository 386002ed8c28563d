"""Hard negatives: against all pairs in plain Python, ties, repeats, odd components, the stopping rule."""

import math
import random

import numpy as np
import pytest

from regstat.llm import hard_negatives as H
from regstat.llm import queries
from regstat.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """All pairs, in Python integers; rows of (vec_id, embedding, label)."""
    part = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = math.fmod(label + 1, 10)
        part.append((i, label, [min(2**56, max(-2**56, math.floor(256 * x))) for x in v]))
    show = lambda s: max(-2**63, min(2**63 - 1, s))
    out = []
    for a, (i, label, v) in enumerate(part):
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(v, w, strict=False)), j is None, j or 0, b, same == label) for b, (j, same, w) in enumerate(part) if b != a))
        for s, null, j, _, _ in [t for t in scored if t[4]][:5]:
            ps = -s
            fit = [t for t in scored if not t[4] and 30 * ps <= -100 * t[0] <= 90 * ps][:10]
            out += [(i, None if null else j, r + 1, None if n else m, show(ps), show(-ns)) for r, (ns, n, m, _, _) in enumerate(fit)]
    return sorted(out, key=str)


def run(spark, rows, schema=SCHEMA):
    return sorted([tuple(r) for r in H.mine(spark.createDataFrame(rows, schema)).collect()], key=str)


def cluster(n, dims, seed, grain=None):
    gen = random.Random(seed)
    middle = [[gen.gauss(0, 0.2) for _ in range(dims)] for _ in range(4)]
    vec = lambda: [round(m + gen.gauss(0, 0.2), 3) if grain is None else gen.randrange(grain) / 256 for m in gen.choice(middle)]
    return [(i, vec(), gen.randrange(3)) for i in range(n)]


def test_whole_table_matches_all_pairs(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in table(spark, sf, "embeddings").select("vec_id", "embedding", "label").collect()]
    assert sorted([tuple(r) for r in queries.op13_hard_negatives(spark, sf).collect()], key=str) == plain(rows)


def test_many_ties_over_blocks_and_runs(spark, monkeypatch):
    for name, value in (("BLOCK", 40), ("CHUNK", 2), ("RUN", 2), ("FIRST_DEPTH", 4)):
        monkeypatch.setattr(H, name, value)
    rows = cluster(700, 3, 5, grain=3)
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cluster(230, 4, 7)
    rows += [(300, None, 1), (301, [0.1, None, 0.2, 0.3], 1), (302, [nan] * 4, 1), (303, [inf, 0.0, 0.0, 0.0], 1), (304, [0.5] * 4, None), (None, [0.4] * 4, 1),
             (None, [0.3] * 4, 2), (400, [], 1), (500, [0.2], 2), (-100, [0.3, -0.3, 0.2, 0.1], 9), (-7, [0.3, -0.3, 0.2, 0.1], 8), rows[100], rows[100], rows[3], (100, [0.9] * 4, 0)]
    assert run(spark, rows) == plain(rows)
    extra = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", row string, score int, windows int")
    assert sorted([tuple(r) for r in H.mine(extra).collect()], key=str) == plain(rows)
    assert run(spark, []) == [] and run(spark, [(100, [0.5], 1)]) == []


def test_components_beyond_floats(spark):
    rows = [(i, [s * m for s in (1e30, 3e20, -2.0)], i % 3) for i, m in enumerate((1.0, 0.7, 0.5, 1e-4, -1.0, 1e-25, 3e-20))] + [(100, [1e18, 1e3, 1.0], 0), (200, [1.0, 1e8, 1.0], 1)]
    assert run(spark, rows, "vec_id long, embedding array<double>, label int") == plain(rows)


@pytest.mark.parametrize("k", [1, 10])
def test_stops_early_and_stays_exact(k):
    """A stop before the lists end, with the same rows as a full scan."""
    class Block:
        pass
    gen, rows = np.random.default_rng(3), Block()
    rows.vec = gen.integers(-200, 200, (3000, 2))
    lists = H._Lists(rows, np.float32)
    anchor, all_rows = np.array([150, -40], dtype=np.float32), np.ones(3000, dtype=bool)
    asked = []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                asked.append(len(at))
            return super().__getitem__(at)
    lists.vec = lists.vec.view(Counting)
    scores = rows.vec @ np.array([150, -40])
    for lo, hi in ((None, None), (5_000, 20_000), (10**6, 10**7)):
        asked.clear()
        (places, found), = H.first_rows(lists, anchor, all_rows, [(lo, hi)], [[]], k)
        inside = [(-s, i) for i, s in enumerate(scores.tolist()) if (lo is None or s >= lo) and (hi is None or s <= hi)]
        assert [(-int(s), int(p)) for p, s in zip(places, found, strict=True)] == sorted(inside)[:k]
        assert sum(asked) < 3000
