"""Decontamination: planted passages and paraphrases, recall against all windows, the latent space against a full SVD."""

import random

import numpy as np
import pytest

from regstat.llm import decontaminate as d
from regstat.llm.common import table

from . import odd


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], max(row[j + 1], row[j], before + (x == y))
    return row[-1]


def test_lcs_matches_dynamic_program():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(1, 70))] for _ in range(2))
        assert d.lcs_length(a, b) == lcs(a, b)


def corpus():
    rng = random.Random(9)
    vocabulary = [f"term{i}" for i in range(6000)]
    common = ["the", "of", "and", "a", "to", "in"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]
    items = [text(rng.randint(15, 50)) for _ in range(30)]
    docs, planted = [], set()
    for i in range(400):
        words = text(rng.randint(0, 500))
        if i % 8 == 0:
            j = rng.randrange(len(items))
            copy = list(items[j])
            if i % 16 == 0:      # a paraphrase: some words of the first two thirds replaced or left out
                for k in rng.sample(range(len(copy) * 2 // 3), len(copy) // 6):
                    copy[k] = rng.choice(vocabulary) if k % 2 else ""
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "," if i % 24 == 0 else w for w in copy if w]
            planted.add((i, j))
        docs.append(" ".join(words))
    return docs, [" ".join(t) for t in items], planted


def test_planted_items_and_no_others(spark):
    texts, items, planted = corpus()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = odd.plain(spark, texts)
    found = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).collect()}
    assert found == planted
    left = {r["doc_id"] for r in d.clean(docs, bench).collect()}
    assert left == set(range(len(texts))) - {i for i, _ in planted}


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    texts, items, planted = corpus()
    monkeypatch.setattr(d, "BLOCK_BYTES", 2000)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in d.contaminated(odd.plain(spark, texts), bench).collect()} == planted


def test_recall_against_all_windows(spark):
    """Every window of every document is compared with every item word by word."""
    sf = "/root/testdata/sf0.001"
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    items = d.items_of([(r["item_id"], r["text"].encode()) for r in bench.collect()])
    want = set()
    for r in docs.collect():
        words = d.words_of((r["text"] or "").encode())
        for item in items:
            step = max(4, len(item.words) // 4)
            if set(item.words) & set(words) and any(d.lcs_length(item.words, words[s:s + len(item.words) + step]) >= 0.8 * len(item.words) for s in range(0, len(words), step)):
                want.add((r["doc_id"], item.item_id))
    found = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).collect()}
    assert want and len(found & want) >= 0.9 * len(want)


def test_latent_space_matches_full_svd(spark):
    """Sums over the tasks and the Rayleigh-Ritz step give the singular vectors of the TF-IDF passages."""
    texts, items, _ = corpus()
    words = d.items_of(list(enumerate(t.encode() for t in items)))
    space = d.fit(odd.plain(spark, texts), words)
    idf_free = space.vectors / np.linalg.norm(space.vectors, axis=1, keepdims=True).clip(1e-12)
    assert space.items.shape == (len(items), min(d.RANK, len(space.index))) and np.allclose(np.linalg.norm(space.items, axis=1), 1, atol=1e-4)
    assert np.isfinite(idf_free).all()
    matcher = d.Matcher(space, words)
    for i, item in enumerate(words):
        assert i in matcher.found(b" ".join(item.words))


def long_corpus():
    """Items of 250 and 1,000 words inside documents: verbatim (every second), else paraphrased: every sixth word replaced or left out, some added."""
    rng = random.Random(12)
    vocabulary = [f"term{i}" for i in range(6000)]
    common = ["the", "of", "and", "a", "to", "in"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]
    items = [text(n) for n in (250, 250, 1000, 1000, 30, 65, 130)]
    docs, planted = [], set()
    for i in range(200):
        words = text(rng.randint(0, 1500))
        if i % 6 == 0:
            j = i // 6 % len(items)
            copy = list(items[j])
            if i % 12 == 0:
                for k in rng.sample(range(len(copy) * 2 // 3), len(copy) // 6):
                    copy[k] = [rng.choice(vocabulary), "", f"{copy[k]} {rng.choice(vocabulary)} {rng.choice(common)}"][k % 3]
            at = rng.randint(0, len(words))
            words[at:at] = [w for w in copy if w]
            planted.add((i, j))
        elif i % 6 == 1:         # a third of a long item is no match
            j, at = 2 + i % 2, rng.randint(0, len(words))
            words[at:at] = items[j][300:633]
        docs.append(" ".join(words))
    return docs, [" ".join(t) for t in items], planted


def test_long_items(spark):
    texts, items, planted = long_corpus()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = odd.plain(spark, texts)
    found = d.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    for r in found:
        held = d.words_of(items[r["item_id"]].encode())
        at = d.words_of(texts[r["doc_id"]].encode())
        if r["doc_id"] % 12:     # verbatim: the whole item, and it starts within the words looked at beyond it
            assert r["lcs_share"] == r["answer_share"] == 1
            assert any(at[p:p + len(held)] == held for p in range(r["position"], r["position"] + 2 * d.WIDTH))
    assert {r["doc_id"] for r in d.clean(docs, bench).collect()} == set(range(len(texts))) - {i for i, _ in planted}


def test_items_without_an_id(spark, monkeypatch):
    """Texts of items whose id is null are found and removed like the others; also in several blocks."""
    texts, items, planted = corpus()
    ids = [None if j % 3 == 0 else j for j in range(len(items))]
    bench = spark.createDataFrame(list(zip(ids, items, strict=True)), "item_id long, text string")
    docs = odd.plain(spark, texts)
    for block in (d.BLOCK_BYTES, 2000):
        monkeypatch.setattr(d, "BLOCK_BYTES", block)
        found = [(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).collect()]
        assert sorted(found, key=str) == sorted(((i, ids[j]) for i, j in planted), key=str)
    assert {r["doc_id"] for r in d.clean(docs, bench).collect()} == set(range(len(texts))) - {i for i, _ in planted}


def test_sparse_rows_match_dense():
    rng = np.random.default_rng(3)
    dense = rng.random((40, 30)) * (rng.random((40, 30)) < 0.2)
    row, col = np.nonzero(dense)
    rows = d.Rows(row, col, dense[row, col], dense.shape)
    for entries in (7, 1 << 15):
        d.ENTRIES, was = entries, d.ENTRIES
        m, t = rng.random((30, 5)), rng.random((40, 5))
        assert np.allclose(rows.times(m), dense @ m) and np.allclose(rows.transposed_times(t), dense.T @ t)
        d.ENTRIES = was


@pytest.mark.parametrize("some", [None, []])
def test_odd_cases(spark, some):
    docs = odd.docs(spark, some)
    bench = spark.createDataFrame([(1, "merchants weigh grain and children count the gulls above the grey stone wall", 1), (2, None, 1), (None, "x y z", 1), (3, "", 1),
                                   (1, "merchants weigh grain and children count the gulls above the grey stone wall", 1)], "item_id long, text string, doc_id int")
    found = d.contaminated(docs, bench).collect()
    empty = d.contaminated(docs, bench.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "item_id", "cosine", "lcs_share", "answer_share", "position"]
    left = d.clean(docs, bench)
    assert left.columns == docs.columns
    if some is None:
        assert {r["doc_id"] for r in found} == {1, 2, 3, 11, None} and {r["item_id"] for r in found} == {1}
        assert left.count() == docs.count() - len(found)
    else:
        assert not found and left.count() == 0


def test_items_without_an_id_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_BYTES", 400)
    rng = np.random.default_rng(8)
    names = [f"w{a}{b}" for a in range(30) for b in range(30)]
    items = [" ".join(rng.choice(names, 20)) for _ in range(24)]
    docs = odd.plain(spark, [f"{' '.join(rng.choice(names, 15))} {items[i]} tail" if i < 24 else " ".join(rng.choice(names, 40)) for i in range(40)])
    bench = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in enumerate(items)], "item_id long, text string")
    sizes = [sum(len(" ".join(w.decode() for w in item.words)) for item in m.items) for m in d.matchers(d._plain(docs), bench)]
    assert len(sizes) > 3 and max(sizes) < 1_500
    found = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).collect()}
    assert found == {(i, None if i % 2 else 7) for i in range(24)}
    assert {r["doc_id"] for r in d.clean(docs, bench).collect()} == set(range(24, 40))


def test_recall_of_a_space_fitted_on_few_documents(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "benchmark"))

    def rows():
        return {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).select("doc_id", "item_id").collect()}
    whole = rows()
    fit = d.fit
    monkeypatch.setattr(d, "fit", lambda docs, items: fit(docs, items, 20))      # of 1,000 documents
    few = rows()
    print("decontamination: rows found by a fit on all documents", len(whole), "on about 20", len(few), "both", len(whole & few))
    assert whole and len(whole & few) >= 0.98 * len(whole)


def test_the_space_is_fitted_on_the_passages_of_all_documents(spark, monkeypatch):
    """The leading directions are those of all documents' passages and the items, by a full decomposition on the side."""
    monkeypatch.setattr(d, "RANK", 4)
    monkeypatch.setattr(d, "EXTRA", 100)      # every direction is drawn, so the fit is exact
    rng = random.Random(21)
    names = [f"t{i}" for i in range(40)]
    items = d.items_of([(i, " ".join(rng.sample(names, 10)).encode()) for i in range(6)])
    docs = [" ".join(rng.choice(names[:3 + i % 38]) for _ in range(rng.randint(1, 12))) for i in range(4_600)] + ["", "other words", " ".join(names * 4)]
    space = d.fit(odd.plain(spark, docs), items)
    held = sorted(space.index, key=space.index.get)
    of = np.array([sum(w in text.split() for text in docs) for w in (t.decode() for t in held)])
    idf = np.log((len(docs) + 1) / (of + 0.5)).clip(min=0.05)

    def gram(pieces):
        rows = np.array([[piece.count(w) for w in held] for piece in pieces]) * idf
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        return rows.T @ rows

    passages = [words[s:s + d.WIDTH] for words in (t.encode().split() for t in docs) for s in range(0, max(1, len(words) - d.WIDTH + d.STRIDE), d.STRIDE)]
    want = np.linalg.eigh(gram(passages) + len(items) * gram([item.words for item in items]))[1][:, -4:]
    got = space.vectors / idf[:, None]
    assert np.linalg.svd(want.T @ got)[1] == pytest.approx(np.ones(4), abs=1e-4)


def test_candidates_with_too_few_words_need_no_subsequence(monkeypatch):
    item = d.Item(1, [b"w%d" % i for i in range(10)], [b"w7", b"w8", b"w9"])
    space = d.Space({w: i for i, w in enumerate(item.words)}, np.eye(10, dtype=np.float32), np.full((1, 10), 10 ** -0.5, np.float32))
    asked = []
    monkeypatch.setattr(d, "lcs_length", lambda a, b, real=d.lcs_length: asked.append(len(b)) or real(a, b))
    matcher = d.Matcher(space, [item])
    assert matcher.found(b"far w3 " + b"away " * 20) == {} and not asked          # a cosine of 0.32, one word of ten
    assert list(matcher.found(b"far " + b" ".join(item.words) + b" away")) == [0] and asked


def test_sparse_products_are_the_dense_ones():
    rng = np.random.default_rng(1)
    dense = rng.random((40, 25)) * (rng.random((40, 25)) < 0.15)
    dense[[0, 7, 39]] = 0                                                        # rows without entries
    row, col = np.nonzero(dense)
    rows, m, y = d.Rows(row, col, dense[row, col], dense.shape), rng.random((25, 6)), rng.random((40, 6))
    assert np.allclose(rows.times(m), dense @ m) and np.allclose(rows.transposed_times(y), dense.T @ y)
    empty = d.Rows(row[:0], col[:0], dense[0, :0], dense.shape)
    assert not empty.times(m).any()
