import numpy as np
import zlib

from cartcast.llm import langid
from cartcast.llm.common import documents


def test_pair_tables_equal_the_plain_convolution():
    net = langid.ByteConvNet(["a", "b", "c"])
    x = np.random.default_rng(1).integers(0, 256, (40, langid.WINDOW)).astype(np.uint8)
    hidden = np.concatenate([np.maximum(c.max(1) + b, 0) for c, b in zip(net._convolve(x), net.bias)], 1)
    assert np.allclose(net.window_probabilities(x), net._softmax(hidden), atol=1e-5)


def test_gradients_equal_differences():
    net = langid.ByteConvNet(["a", "b"])
    x = np.random.default_rng(2).integers(97, 100, (6, langid.WINDOW)).astype(np.uint8)
    y = np.array([0, 1, 1, 0, 1, 0])

    def loss():
        return -np.log(net.window_probabilities(x)[np.arange(6), y].astype(float)).mean()
    for p, g in zip(net.parameters(), net._gradients(x, y)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        values = []
        for step in (1e-2, -1e-2):
            p[at] = old + step
            net._pairs = None
            values.append(loss())
        p[at] = old
        net._pairs = None
        assert abs((values[0] - values[1]) / 2e-2 - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_held_out_accuracy(llm):
    docs = documents(llm, "/root/testdata/sf0.01")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    out = langid.language_id(docs).collect()
    assert len(out) == len(truth)
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_edge_cases(make):
    words = {"en": "the of and ing tion ", "de": "der und ung schaft ", None: "zzz "}
    rows = [(i, words[lang] * 20, lang) for i, lang in enumerate(["en", "de", None] * 12)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 !!", "de"), (103, "the of and " * 40_000, "en"), (None, "und der", None)]
    out = langid.language_id(make(rows)).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) and {r["lang_pred"] for r in out} == {"en", "de", "und"}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (100, 101, 102))
    assert by[103]["lang_pred"] == "en"
    assert langid.language_id(make(rows).limit(0)).count() == 0
    unlabelled = langid.language_id(make([(1, "text", None)])).first()
    assert (unlabelled["lang_pred"], unlabelled["score"]) == ("und", 0.0)


def brute_label(net, text):
    """Label and score by the definition, in plain loops."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    data = text.encode()
    data += bytes(-len(data) % langid.WINDOW)
    total = [0.0] * len(net.labels)
    windows = [data[i:i + langid.WINDOW] for i in range(0, len(data), langid.WINDOW)]
    for window in windows:
        hidden = []
        for filters, bias, width in zip(net.filters, net.bias, langid.WIDTHS):
            for f in range(langid.FILTERS):
                top = max(sum(float(filters[k][window[i + k]][f]) for k in range(width))
                          for i in range(langid.WINDOW - width + 1))
                hidden.append(max(0.0, top + float(bias[f])))
        z = [sum(h * float(net.out[i][j]) for i, h in enumerate(hidden)) + float(net.out_bias[j]) for j in range(len(total))]
        e = [np.exp(v - max(z)) for v in z]
        total = [t + v / sum(e) for t, v in zip(total, e)]
    share = [t / len(windows) for t in total]
    return net.labels[share.index(max(share))], max(share)


def test_whole_rows_equal_a_brute_force_scorer(make):
    rng = np.random.default_rng(9)
    net = langid.ByteConvNet(["a", "b", "c"])
    net.bias[:] = rng.normal(0, 0.5, net.bias.shape)
    net.out[:] = rng.normal(0, 0.4, net.out.shape)
    texts = [None, "", "12 !", "x", "é" * 70, "plain words of a text " * 9,
             *["".join(map(chr, rng.integers(32, 600, n))) for n in (5, 64, 127, 128, 129, 400)]]
    rows = [(i if i else None, t) for i, t in enumerate(texts)]
    docs = make(rows).selectExpr("doc_id", "text", "doc_id % 2 = 0 held_out")
    got = {r["doc_id"]: tuple(r)[1:] for r in langid.identify(docs, net).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        label, score = brute_label(net, text)
        held, lang, value = got[i]
        assert lang == label and abs(value - score) < 1e-4 and held == (None if i is None else i % 2 == 0)


def test_sample_takes_the_first_hashes_of_each_language(make, monkeypatch):
    seen = []

    def fit(net, x, y):
        seen.append((net.labels, len(x), np.bincount(y).tolist()))
        return net
    monkeypatch.setattr(langid.ByteConvNet, "fit", fit)
    rows = [(i, f"text {i}", ("en", "de")[i % 9 == 0]) for i in range(400)] + [(1, "text 1", "en")] * 300
    langid.fit_language_model(make(rows), 50)
    assert seen == [(["de", "en"], 95, [45, 50])]
