"""Repeated strings against a brute-force set of windows; the suffix array against sorting."""

import hashlib
import random

import numpy as np
import pytest

from regstat.llm import repeats
from regstat.llm.common import table
from regstat.llm.suffix_array import suffix_array

from . import odd


def test_suffix_array_matches_sorting():
    rng = random.Random(2)
    for _ in range(1500):
        t = [rng.randint(0, rng.choice([0, 1, 2, 7])) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.3:
            t = (t[:5] or [1]) * rng.randint(1, 9)
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) in their order."""
    seen, out = set(), []
    for doc_id, text in rows:
        b = (text or "").encode()
        mark = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                mark[p] += 1
                mark[p + 100] -= 1
            seen.add(w)
        gone = np.cumsum(mark)[:len(b)] > 0
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def result(df):
    return [tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()]


def test_matches_brute_force_on_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = brute(sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()))
    assert sorted(result(repeats.dedup(docs))) == want


@pytest.mark.parametrize("array, piece, batch", [(1 << 18, 1 << 20, 8 << 20), (600, 150, 2000)])
def test_shared_passages(spark, monkeypatch, array, piece, batch):
    """A hot passage among different neighbours, runs of one letter, periods, copies; also with tiny arrays, pieces and batches."""
    monkeypatch.setattr(repeats, "ARRAY", array)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (12, 22, 25, 60)]
    texts = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        texts.append(f"{parts[0]} {rng.choice(passages)} {parts[1]} {rng.choice(passages)[rng.randint(0, 20):]} {parts[2]}")
    texts += ["a" * 99, "a" * 100, "a" * 101, "ab" * 200, "b" * 350, "abc" * 90, texts[0], texts[1], "", None, "x" * 100, "x" * 100]
    docs = odd.plain(spark, texts)
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "BATCH", batch)
    assert sorted(result(repeats.dedup(docs))) == brute(list(enumerate(texts)))


def test_window_ranges_join():
    got = repeats.merged(np.array([1, 1, 1, 2, 1]), np.array([0, 5, 4, 5, 20]), np.array([4, 1, 10, 2, 1]))
    assert got.tolist() == [(1, 0, 14), (1, 20, 1), (2, 5, 2)]


@pytest.mark.parametrize("some", [None, []])
def test_odd_cases(spark, some):
    """Null ids come first; rows of one id go by their text."""
    docs = odd.docs(spark, some)
    order = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    got = result(repeats.dedup(docs))
    assert sorted(got, key=repr) == sorted(brute(order), key=repr)
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in cut.collect()} <= {g[4] for g in got} or some is None
