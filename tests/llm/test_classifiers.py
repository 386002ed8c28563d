"""Quality ranking, toxicity, decision list: held-out accuracy and odd cases."""

import zlib

import numpy as np
import pytest

from regstat.llm import decision_list, quality_ranker, text_stats, toxicity
from regstat.llm.common import table

from . import odd

SF = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"      # more labels


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def split_accuracy(result, labels, column, verdict):
    m = result.merge(labels, on="doc_id")
    m = m[m["doc_id"].map(held)]
    return (m[verdict] == m[column]).mean()


def test_quality_ranker_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = quality_ranker.rank(docs, quality_ranker.train(docs, labels)).toPandas()
    assert len(out) == docs.count()
    assert (out["held_out"] == out["doc_id"].map(held)).all()
    assert out["score"].between(0, 1).all() and ((out["score"] >= 0.3) == (out["predicted"] == 1)).all()
    assert split_accuracy(out, labels.toPandas(), "quality", "predicted") > 0.93


def test_ranker_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    good = (x[:, 0] + 0.2 * rng.normal(size=400) > 0.4).astype(int)
    s = quality_ranker.score(quality_ranker.fit(x, good, 5000), x)
    pairs = [(i, j) for i in np.flatnonzero(good)[:40] for j in np.flatnonzero(1 - good)[:40]]
    assert np.mean([s[i] > s[j] for i, j in pairs]) > 0.9
    assert quality_ranker.fit(x, np.ones(400)) is None


def auc(score, label):
    ranks = np.argsort(np.argsort(score, kind="stable")) + 1
    n = label.sum()
    return (ranks[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_toxicity_held_out(spark):
    docs, labels = table(spark, LARGE, "documents"), table(spark, LARGE, "labels")
    out = toxicity.classify(docs, toxicity.train(docs, labels)).toPandas()
    assert len(out) == docs.count() and ((out["score"] >= 0.5) == (out["predicted"] == 1)).all()
    m = out.merge(labels.toPandas(), on="doc_id")
    m = m[m["held_out"] & m["toxic"].notna()]
    recall, false = (m["predicted"][m["toxic"] == c].mean() for c in (1, 0))
    print("toxicity, held out: recall", recall, "false positives", false, "AUC", auc(m["score"].to_numpy(), m["toxic"].to_numpy()))
    assert recall > 0.5 and false < 0.03 and auc(m["score"].to_numpy(), m["toxic"].to_numpy()) > 0.85


def brute_grams(text):
    chars = text.lower()
    return {chars[i:i + n] for n in toxicity.ORDERS for i in range(len(chars) - n + 1)}


def test_toxicity_matches_brute_force(spark, monkeypatch):
    """Counts, ratios, gradient steps and scores of a plain version on n-grams as strings (no hash values meet here)."""
    monkeypatch.setattr(toxicity, "STEPS", 12)
    words = ["Gulls", "grain", "ÉTÉ", "stone", "Rüpel", "日本語の本", "wall"]
    texts = [" ".join(words[(i * k) % 7] for k in range(1, 2 + i % 5)) for i in range(40)] + ["", "ab"]
    marks = [(i, 1, int("Rüpel" in t)) for i, t in enumerate(texts)]
    model = toxicity.train(odd.plain(spark, texts), odd.labels(spark, marks))
    grams = [brute_grams(t) for i, t in enumerate(texts) if not held(i)]
    y = np.array([c for i, _, c in marks if not held(i)], float)
    names = sorted(set().union(*grams))
    assert len({int(h) for g in names for h in toxicity.features(g.encode())}) == len(names)
    x = np.array([[g in own for g in names] for own in grams], float)
    width = 1 << toxicity.BITS
    n1, n0 = x[y == 1].sum(0) + 1, x[y == 0].sum(0) + 1
    r = np.log(n1 / (n1.sum() + width - len(names))) - np.log(n0 / (n0.sum() + width - len(names)))
    z, c = x * r, np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    step = 4 / ((z**2).sum(1).max() + 1 + 4 * toxicity.RIDGE)
    w = a = np.zeros(len(names))
    b = ab = 0.0
    for t in range(12):
        g = c * (1 / (1 + np.exp(-(z @ a + ab))) - y)
        nw, nb = a - step * (g @ z + toxicity.RIDGE * a), ab - step * g.sum()
        a, ab, w, b = nw + t / (t + 3) * (nw - w), nb + t / (t + 3) * (nb - b), nw, nb
    w = r * (0.75 * w + 0.25 * np.abs(w).mean())
    of = dict(zip(names, w, strict=True))
    want = [1 / (1 + np.exp(-sum(of.get(g, 0) for g in brute_grams(t)) - b)) for t in texts]
    assert toxicity.scores(model, [t.encode() for t in texts]) == pytest.approx(want, abs=1e-5)


def test_quality_ranker_matches_brute_force():
    """The fit is the minimum of the plain pairwise logistic loss, and scores follow it."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3))
    label = (x @ [1.0, -0.5, 0.2] + 0.5 * rng.normal(size=60) > 0).astype(int)
    model = quality_ranker.fit(x, label, 3000)
    draw, z = np.random.default_rng(1), (x - x.mean(0)) / x.std(0)
    good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    pairs = list(zip(draw.choice(good, 3000), draw.choice(poor, 3000), strict=True))

    def loss(w):
        return np.mean([np.log1p(np.exp(-(w @ (z[i] - z[j])))) for i, j in pairs]) + quality_ranker.RIDGE / 2 * w @ w
    least = loss(model.weights)
    for k in range(3):
        for d in (-1e-3, 1e-3):
            assert loss(model.weights + d * np.eye(3)[k]) > least
    s = z @ model.weights
    levels = np.unique(np.quantile(s, np.linspace(0, 1, 1001)))
    right = [((s[good] >= t).mean() + (s[poor] < t).mean()) / 2 for t in levels]
    assert ((s[good] >= model.threshold).mean() + (s[poor] < model.threshold).mean()) / 2 == pytest.approx(max(right))
    assert ((quality_ranker.score(model, x) >= quality_ranker.CUT) == (s >= model.threshold)).all()


def test_repeated_ids_send_one_row(spark):
    docs = spark.createDataFrame([(i % 6, f"{'bad ' * (i % 2)}text {i % 6}") for i in range(3_000)], "doc_id long, text string")
    labels = odd.labels(spark, [(i, i % 2, i % 2) for i in range(6)])
    assert len(quality_ranker.text_stats_with_labels(docs, labels, "quality", 100)) == sum(not held(i) for i in range(6))
    sample = toxicity._sample(docs, labels, 100).collect()
    assert sorted(r["doc_id"] for r in sample) == [i for i in range(6) if not held(i)]


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_BYTES", 1_000)
    docs = odd.plain(spark, ["x" * 90 for _ in range(40)])
    sample = toxicity._sample(docs, odd.labels(spark, [(i, 1, i % 2) for i in range(40)]), 100).collect()
    assert len(sample) == 11


def test_toxicity_learns_words(spark):
    clean = ["the river carries small boats", "merchants weigh grain here", "children count the gulls", "a lazy dog sleeps"]
    texts = [f"{clean[i % 4]} {i}" + (" you blighter" if i % 3 == 0 else "") for i in range(300)]
    docs = odd.plain(spark, texts)
    model = toxicity.train(docs, odd.labels(spark, [(i, 1, int(i % 3 == 0)) for i in range(300)]))
    s = toxicity.scores(model, [b"the dog, you blighter", b"the dog counts boats", b""])
    assert s[0] > 0.5 > s[1] and 0 <= s[2] <= 1


def test_ngrams_of_pieces(monkeypatch):
    texts = ["abcde", "fgh", "", "x", "The quick brown FOX " * 40, "Größe ÄRGER " * 30, "日本語テキスト"]
    whole = [set(toxicity.features(t.encode()).tolist()) for t in texts]
    assert [len(w) for w in whole] == [len(brute_grams(t)) for t in texts]
    assert whole[5] == set(toxicity.features(texts[5].lower().encode()).tolist())
    for t in texts:
        assert len(toxicity.features(t.encode())) == len(set(toxicity.features(t.encode()).tolist()))
    monkeypatch.setattr(toxicity, "PIECE", 64)
    assert [set(toxicity.features(t.encode()).tolist()) for t in texts] == whole
    assert len(toxicity.features(b"ab\xff\xfecd")) > 0


def brute_counts(text):
    words = text.encode().split()
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in lines
            lines.add(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@pytest.mark.parametrize("text", ["", "a", "a b c d e f g h " * 3, "x\ny\nx\n \n \nx", "é ü #5 <b> " * 9, "\x0ba\x0c b c d e", odd.PROSE * 2, "w " * 30])
def test_counts_match_brute_force(text):
    assert text_stats.counts_of(text.encode())[:5] == brute_counts(text)


def test_decision_list(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rules = decision_list.train(docs, labels)
    assert rules and all(rule for rule in rules)
    out = decision_list.judge(docs, rules).toPandas()
    texts = docs.toPandas().set_index("doc_id")["text"]
    for r in out.itertuples():
        n, _, _, _, repeat = want = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n)
        assert not (r.kept and r.base_failed)
    # the expression says what the rules say, row by row
    x = decision_list.statistics(np.array([text_stats.counts_of(texts[i].encode()) for i in out["doc_id"]]))
    covered = np.zeros(len(out), bool)
    for rule in rules:
        covered |= np.logical_and.reduce([t.holds(x) for t in rule])
    assert (out["kept"] == ~(covered | out["base_failed"])).all()
    out["verdict"] = out["kept"].astype(int)
    passed = out[~out["base_failed"]]
    assert split_accuracy(passed, labels.toPandas(), "quality", "verdict") > 0.93


def test_learn_finds_a_conjunction():
    rng = np.random.default_rng(3)
    x = {"a": rng.random(900), "b": rng.random(900)}
    bad = (x["a"] > 0.6) & (x["b"] <= 0.5)
    rules = decision_list.learn(x, bad)
    hit = np.logical_or.reduce([np.logical_and.reduce([t.holds(x) for t in r]) for r in rules])
    assert (hit == bad).mean() > 0.95
    assert decision_list.learn(x, np.zeros(900, bool)) == [] and decision_list.learn(x, np.ones(900, bool)) == []


@pytest.mark.parametrize("some", [None, []])
def test_odd_cases(spark, some):
    docs = odd.docs(spark, some)
    n = docs.count()
    for labels in (odd.labels(spark), odd.labels(spark, [(1, 1, 0), (8, 0, 1), (9, 0, 1), (3, 1, 0), (None, 1, 1), (2, None, None), (11, 0, 1), (12, 0, 0)])):
        a = quality_ranker.rank(docs, quality_ranker.train(docs, labels)).collect()
        b = toxicity.classify(docs, toxicity.train(docs, labels)).collect()
        rules = decision_list.train(docs, labels)
        c = decision_list.judge(docs, rules).collect()
        kept = decision_list.accepted(docs, rules)
        assert len(a) == len(b) == len(c) == n
        assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in c)
        assert all(0 <= r["score"] <= 1 for r in a + b)
        assert all(not r["held_out"] for r in a if r["doc_id"] is None)
