import math
import random
import re
import zlib

import numpy as np

from cartcast.llm import toxicity
from cartcast.llm.common import documents, lowest_per_class, table


def test_isotonic_is_the_least_squares_monotone_fit():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=200), 1)
    y = (rng.random(200) < 1 / (1 + np.exp(-3 * x))).astype(float)
    knots, p = toxicity.isotonic(x, y)
    assert (np.diff(knots) > 0).all() and (np.diff(p) >= 0).all()
    fit = np.interp(x, knots, p)
    for v in np.unique(p):  # each level is the mean of its block
        block = np.isclose(fit, v)
        assert abs(y[block].mean() - v) < 0.03


def test_trees_learn_a_threshold_and_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.3)).astype(float)
    trees = toxicity.BoostedTrees().fit(x, y)
    assert ((trees.margin(x) > 0) == y).mean() > 0.97


def test_features_of_odd_texts():
    lexicon = toxicity.Lexicon({"idiot": 5.0}, {"idio": 4.0})
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon) == [0.0] * len(toxicity.FEATURES)
    f = dict(zip(toxicity.FEATURES, toxicity.features("YOU idiot!! st*pid s t o p it, idioten", lexicon)))
    assert f["word_hits"] == 1 and f["prefix_hits"] == 2 and f["near_you"] == 0.5
    assert f["capitals"] > 0 and f["exclaim"] > 0 and f["mixed"] > 0 and f["spelled"] == 1
    assert len(toxicity.features("x " * 300_000, lexicon)) == len(toxicity.FEATURES)


def planted(make, llm, n=900):
    rng = random.Random(3)
    words = [a + b for a in ("an", "er", "th", "on", "st") for b in ("ing", "ed", "ly", "tion", "es", "or")]
    bad = ["scumlord", "idiot", "trashy", "vermin"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = rng.choices(words, k=80)
        for _ in range(rng.randint(3, 6) if toxic else 0):
            text[rng.randrange(80)] = rng.choice(bad)
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return make(docs), llm.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_planted_toxic_documents(make, llm):
    docs, labels = planted(make, llm)
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == 900
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in range(900) if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([(r["doc_id"] % 5 == 0) == r["predicted"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)


def test_query_on_the_given_tables(llm):
    docs, labels = documents(llm, "/root/testdata/sf0.01"), table(llm, "/root/testdata/sf0.01", "labels")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    out = [r for r in toxicity.toxicity(docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    clean = [r["predicted"] for r in out if truth[r["doc_id"]] == 0]
    assert np.mean(clean) < 0.03
    assert np.mean([r["predicted"] for r in out if truth[r["doc_id"]] == 1]) > 0.6


def test_one_labelled_id_with_a_third_of_all_rows(make, llm, monkeypatch):
    docs, labels = planted(make, llm, 300)
    hot = docs.union(make([(0, f"an ing st {i}") for i in range(150)]))
    seen = []
    lexicon = toxicity.learn_lexicon

    def counted(sample):
        seen.append((sample.count(), sample.select("doc_id").distinct().count()))
        return lexicon(sample)
    monkeypatch.setattr(toxicity, "learn_lexicon", counted)
    model = toxicity.fit_toxicity(hot, labels, per_class=100)
    assert seen[0][0] == seen[0][1] <= 200
    assert model.trees is not None


def test_lowest_of_each_class_equals_ranking(llm):
    rows = [(i % 3, (i * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63), i) for i in range(900)]
    rows += [(3, 5, i) for i in range(900, 1000)]  # one range holds a whole class of ties
    df = llm.createDataFrame(rows, "kind int, turn long, id long")
    got = {(r["kind"], r["id"]) for r in lowest_per_class(df, "kind", "turn", "id", 70).collect()}
    want = set()
    for k in range(4):
        want |= {(k, i) for _, i in sorted((t, i) for x, t, i in rows if x == k)[:70]}
    assert got == want


def test_edge_cases(make, llm):
    docs, labels = planted(make, llm, 300)
    odd = docs.union(make([(None, None), (5, ""), (5, "an ing")]))
    more = labels.union(llm.createDataFrame([(None, 1, 1), (5, None, None), (7, 1, 0)], labels.schema))
    assert toxicity.toxicity(odd, more).count() == 303
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r["score"] for r in toxicity.toxicity(docs, labels.filter("toxic = 1")).collect()} == {1.0}


def brute_score(model, text):
    """Features, trees and calibration in plain loops."""
    text = text or ""
    words = [m.group() for m in toxicity.TOKEN.finditer(text.lower())]
    n = len(words)
    x = [0.0] * len(toxicity.FEATURES)
    if n:
        known, begun_by = model.lexicon.words, model.lexicon.prefixes
        hits = [i for i in range(n) if words[i] in known]
        begun = [max([begun_by.get(w[:k], 0.0) for k in toxicity.PREFIXES if len(w) > k] + [0.0]) for w in words]
        begun = [b for b in begun if b > 0]
        you = [i for i in range(n) if words[i] in toxicity.SECOND_PERSON]
        spelled = len(toxicity.SPELLED.findall(text)) if n > 4 else 0
        x = [len(hits), len(hits) / n, len({words[i] for i in hits}), max([known[words[i]] for i in hits] + [0.0]),
             len(begun), len(begun) / n, max(begun + [0.0]), math.fsum(known[words[i]] for i in hits),
             max([1 / (1 + abs(i - j)) for i in hits for j in you] + [0.0]), len(you) / n,
             sum(1 for w in text.split() if w.isupper()) / n, sum(text.count(c) for c in "!?") / n,
             len(re.findall("[!?][!?]+", text)) / n, len(toxicity.MIXED.findall(text)) / n, spelled, math.log1p(n)]
    margin = model.trees.base
    for tree in model.trees.trees:
        while tree[0] is not None:
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        margin += tree[2]
    at, p = (k.tolist() for k in model.knots)
    if margin <= at[0]:
        return p[0]
    for i in range(1, len(at)):
        if margin <= at[i]:
            return p[i - 1] + (p[i] - p[i - 1]) * (margin - at[i - 1]) / (at[i] - at[i - 1])
    return p[-1]


def test_whole_rows_equal_a_brute_force_scorer(make, llm):
    docs, labels = planted(make, llm)
    odd = ["YOU scumlord!! st*pid s t o p it, vermins", "", None, "du IDIOT ??", "a.b c'd 1!2 " * 50, "vermin you " * 9000]
    docs = docs.union(make([(2000 + i, t) for i, t in enumerate(odd)]))
    model = toxicity.fit_toxicity(docs, toxicity.learning_rows(labels))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(texts)
    for r in out:
        score = brute_score(model, texts[r["doc_id"]][:400] if r["doc_id"] == 2005 else texts[r["doc_id"]])
        if r["doc_id"] != 2005:  # its nearness takes all pairs of positions
            assert abs(r["score"] - score) < 1e-9
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= toxicity.THRESHOLD)
