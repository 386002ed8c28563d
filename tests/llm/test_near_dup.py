"""Near-duplicates against all pairs."""

import random

import numpy as np
import pytest

from regstat.llm import near_dup
from regstat.llm.common import table

from . import odd


def brute(texts, width=2):
    """component of each id by exact Jaccard of all pairs."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(len(w) - width + 1, 1))} if w else set()
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 80 * max(len(a), len(b)) <= 100 * min(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                comp[max(x, y)] = min(x, y)
    return {i: (root(i), len(sets[i])) for i in ids}


def check(spark, texts, width=2):
    out = near_dup.dedup(odd.plain(spark, texts), width).collect()
    assert len(out) == len(texts)
    want = brute(dict(enumerate(texts)), width)
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


@pytest.mark.parametrize("width", [2, 5])
def test_matches_all_pairs_on_documents(spark, width):
    rows = table(spark, "/root/testdata/sf0.001", "documents").toPandas().sort_values("doc_id")
    check(spark, rows["text"].tolist(), width)


def templated(n, seed=3):
    """Texts of 200 words, 120 of them one template, the others random: no pair is near."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(120)]
    return [" ".join(template + [f"r{rng.randrange(10**9)}" for _ in range(80)]) for _ in range(n)]


def test_templated_texts_make_no_pairs(spark, monkeypatch):
    """Candidates of texts that share a template grow with the texts, not with their square."""
    made, across = [], near_dup.across
    monkeypatch.setattr(near_dup, "across", lambda whole: made.append(across(whole).cache()) or made[-1])
    for n in (150, 300):
        out = near_dup.dedup(odd.plain(spark, templated(n)), 2)
        assert out.filter("kept").count() == n
    assert [m.count() <= n for m, n in zip(made, (150, 300), strict=True)] == [True, True]


def test_prefix_filter_loses_no_pair(spark):
    """Without families every link has to come across: near copies inside a crowd of one template."""
    rng = random.Random(12)
    texts = templated(60)
    for t in texts[:12]:
        words = t.split()
        for k in rng.sample(range(200), 9):
            words[k] = f"n{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    check(spark, texts, 2)
    sets = {i: near_dup.shingles(t.encode(), near_dup._WordHash(), 2) for i, t in enumerate(texts)}
    whole = spark.createDataFrame([(i, i, bytearray(v.tobytes())) for i, v in sets.items()], "rep long, family long, members binary")
    near = {(a, b) for a in sets for b in sets if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert len(near) >= 12 and near <= {tuple(r) for r in near_dup.across(whole).collect()}


def test_family_of_near_copies(spark, monkeypatch):
    """Copies of copies around the threshold, in several blocks, with short and tiny sets."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size in (4, 5, 6, 8, 12, 40, 150):
        family = [[rng.choice(vocabulary) for _ in range(size)]]
        for _ in range(25):
            copy = list(rng.choice(family))
            for _ in range(rng.randint(0, max(1, size // 25))):
                copy[rng.randrange(size)] = rng.choice(vocabulary)
            family.append(copy)
        texts += [" ".join(f) for f in family]
    rng.shuffle(texts)
    check(spark, texts)


def test_common_passage_links_nothing_wrong(spark):
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [" ".join([passage, *(f"q{rng.randrange(5000)}" for _ in range(rng.randint(1, 60)))]) for _ in range(120)]
    check(spark, texts)


def test_union_estimate_is_exact_for_small_sets():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 60, 25).astype(np.uint64)) for _ in range(2))
        assert near_dup.union_estimate(a, b) == pytest.approx(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))


def test_shared_runs_is_a_lower_bound():
    rng = np.random.default_rng(2)
    for size in range(4, near_dup.K + 1):
        for _ in range(20):
            base = np.sort(rng.choice(10**6, size, replace=False)).astype(np.uint64)
            gone = rng.integers(0, size // 5 + 1)
            other = np.unique(np.concatenate([rng.choice(base, size - gone, replace=False), rng.integers(0, 10**6, rng.integers(0, size // 5 + 1)).astype(np.uint64)]))
            common = len(np.intersect1d(base, other))
            if 100 * common >= 80 * len(np.union1d(base, other)) and len(other) <= near_dup.K and not np.array_equal(base, other):
                same = len(np.intersect1d(near_dup.runs(base, len(base)), near_dup.runs(other, len(other))))
                assert same >= max(near_dup.shared_runs(len(base)), near_dup.shared_runs(len(other)))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(200, 100), (100, 200), (5, 5)], "a long, b long")
    got = {r["node"]: r["comp"] for r in near_dup.components(edges, "chain").collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100}


@pytest.mark.parametrize("some", [None, []])
def test_odd_cases(spark, some):
    docs = odd.docs(spark, some)
    out = near_dup.dedup(docs, 2).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    if some is None:
        assert all(r["component_id"] is None and r["kept"] for r in by[None])
        assert by[4][0]["n_shingles"] == 0 and by[4][0]["kept"] and by[5][0]["kept"] and by[7][0]["kept"]
        assert by[6][0]["n_shingles"] == 1
        assert {r["component_id"] for r in by[3]} == {1}
    left = near_dup.one_of_each(docs, 2)
    assert left.columns == docs.columns
    assert left.count() == sum(r["kept"] for r in out) or some is None


def survivors(rows):
    """(doc_id, text) of one row, the first by id and text, of each component of the rows with an id, and all rows without one."""
    have = sorted(((i, t) for i, t in rows if i is not None), key=lambda r: (r[0], r[1] or ""))
    comp = brute({k: t for k, (_, t) in enumerate(have)})
    names = [(i, t, have[comp[k][0]][0], comp[k][0] == k) for k, (i, t) in enumerate(have)]
    return names, sorted([(i, t) for i, t, _, kept in names if kept] + [r for r in rows if r[0] is None], key=str)


def repeated_ids():
    """Families of near copies dealt over few ids, so that the smallest id of a set stands for other sets too."""
    rng = random.Random(8)
    out = []
    for f in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(60)]
        for _ in range(6):
            copy = list(base)
            for k in rng.sample(range(60), rng.randint(0, 2)):
                copy[k] = f"v{rng.randrange(3000)}"
            out.append((rng.randrange(9), " ".join(copy)))
        out += [out[-1], (f, f"alone {f} " + " ".join(f"u{rng.randrange(9000)}" for _ in range(30)))]
    return out


@pytest.mark.parametrize("case", ["odd", "few ids"])
def test_rows_with_repeated_ids(spark, case):
    docs = odd.docs(spark) if case == "odd" else spark.createDataFrame(repeated_ids(), "doc_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    names, want = survivors(rows)
    left = near_dup.one_of_each(docs, 2)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == want
    marks = [(r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.dedup(docs, 2).collect() if r["doc_id"] is not None]
    assert sorted(marks) == sorted((i, name, kept) for i, _, name, kept in names)
