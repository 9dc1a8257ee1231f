"""Language identification by a byte convolutional network.

Windows of ``WINDOW`` bytes pass through filters of several widths, a ReLU, a
max over the window and a softmax. Byte embedding and filter are one table per
filter offset (``256 x FILTERS``), so a convolution is a sum of table rows.
The network is trained in numpy with Adam on a bounded, hash-ordered sample of
labelled rows (``DOCS_PER_LANG`` documents per language, ``WINDOWS_PER_DOC``
windows each); every byte of every text is then scored, the window
probabilities averaged per document.

Defined edge cases: a null text, or one without a letter, gives ``und`` and
score 0; with no labelled row every text gives ``und`` and score 0; a null
``doc_id`` is hashed as the empty string; repeated rows are each labelled, and
learnt from once; equal probabilities give the language that sorts first; every
window of a very long text counts, ``CHUNK`` at a time; further columns are not
read; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, crc_of_id, documents, lowest_per_class, prepare

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
DOCS_PER_LANG = 300
WINDOWS_PER_DOC = 8
CHUNK = 1024  # windows scored at once


def windows_of(data: bytes) -> np.ndarray:
    """All of ``data`` as rows of WINDOW bytes, zero-padded at the end."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


class ByteConvNet:
    """Multi-width byte filters, max pooling, softmax."""

    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.filters = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)
        self._pairs = None

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.out, self.out_bias]

    def _convolve(self, x: np.ndarray) -> list[np.ndarray]:
        out = []
        for table, w in zip(self.filters, WIDTHS):
            n = x.shape[1] - w + 1
            acc = table[0][x[:, :n]]
            for k in range(1, w):
                acc = acc + table[k][x[:, k:k + n]]
            out.append(acc)
        return out

    def _softmax(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 128,
            rate: float = 0.01, seed: int = 7) -> "ByteConvNet":
        rng = np.random.default_rng(seed)
        params = self.parameters()
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                step += 1
                grads = self._gradients(x[rows], y[rows])
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        self._pairs = None
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        convs = self._convolve(x)
        tops = [c.argmax(1) for c in convs]
        peak = [np.take_along_axis(c, t[:, None, :], 1)[:, 0] + b
                for c, t, b in zip(convs, tops, self.bias)]
        hidden = np.concatenate([np.maximum(p, 0) for p in peak], 1)
        delta = self._softmax(hidden)
        delta[np.arange(len(y)), y] -= 1
        delta /= len(y)
        back = (delta @ self.out.T) * (hidden > 0)
        grads, rows, cols = [], np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        bias = np.zeros_like(self.bias)
        for i, (w, top) in enumerate(zip(WIDTHS, tops)):
            part = back[:, i * FILTERS:(i + 1) * FILTERS]
            g = np.zeros_like(self.filters[i])
            for k in range(w):
                np.add.at(g[k], (x[rows, top + k], np.broadcast_to(cols, top.shape)), part)
            grads.append(g)
            bias[i] = part.sum(0)
        return [*grads, bias, hidden.T @ delta, delta.sum(0)]

    def _pair_tables(self) -> list[list[np.ndarray]]:
        """Filters folded into tables over byte pairs (half the look-ups)."""
        if self._pairs is None:
            self._pairs = []
            for table, w in zip(self.filters, WIDTHS):
                parts = [(table[k][:, None, :] + table[k + 1][None, :, :]).reshape(65536, FILTERS)
                         for k in range(0, w - 1, 2)]
                self._pairs.append(parts + ([table[w - 1]] if w % 2 else []))
        return self._pairs

    def window_probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(x), CHUNK):
            part = x[at:at + CHUNK]
            pair = part[:, :-1].astype(np.uint16) * 256 + part[:, 1:]
            hidden = []
            for tables, w, bias in zip(self._pair_tables(), WIDTHS, self.bias):
                n = WINDOW - w + 1
                acc = tables[0][pair[:, :n]]
                for j, t in enumerate(tables[1:], 1):
                    acc += t[pair[:, 2 * j:2 * j + n]] if len(t) > 256 else t[part[:, w - 1:w - 1 + n]]
                hidden.append(np.maximum(acc.max(1) + bias, 0))
            out.append(self._softmax(np.concatenate(hidden, 1)))
        return np.concatenate(out)

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """Label and mean probability of each text, over all its windows."""
        blocks = [windows_of(t) for t in texts]
        ends = np.cumsum([len(b) for b in blocks])
        probs = self.window_probabilities(np.concatenate(blocks))
        means = np.add.reduceat(probs, np.concatenate([[0], ends[:-1]]), 0) / \
            np.array([len(b) for b in blocks])[:, None]
        best = means.argmax(1)
        return ([self.labels[i] for i in best],
                np.clip(means[np.arange(len(best)), best], 0, 1).astype(float).tolist())


def sample_windows(text: str) -> bytes:
    """Up to WINDOWS_PER_DOC evenly spaced windows of a text, end to end."""
    w = windows_of(text.encode("utf-8", "surrogatepass"))
    return w[np.unique(np.linspace(0, len(w) - 1, WINDOWS_PER_DOC).astype(int))].tobytes()


def training_windows(rows: list[tuple[str, bytes]], labels: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and label numbers of the sampled documents' windows."""
    x = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    return x, np.repeat([labels.index(lang) for lang, _ in rows], [len(w) // WINDOW for _, w in rows])


def fit_language_model(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> ByteConvNet | None:
    """Train on a bounded sample of ``(doc_id, text, lang)``.

    The sample is the ``docs_per_lang`` distinct documents per language that
    come first in hash order. Hashes are counted by ranges first and only a
    language's boundary range is ranked, so no task holds a language; texts are
    then read for the chosen hashes, each once.
    """
    known = (labelled.filter("text is not null and lang is not null and lang != ''")
             .select("lang", "text", F.xxhash64("doc_id", "text").alias("key")))
    chosen = lowest_per_class(known.select("lang", "key").distinct(), "lang", "key", "key", docs_per_lang)
    # at most docs_per_lang rows a language
    texts = known.join(F.broadcast(chosen), ["lang", "key"]).groupBy("lang", "key").agg(F.first("text").alias("text"))

    def windows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sample_windows(t) for t in b.column(1).to_pylist()], pa.binary())],
                names=["lang", "windows"])
    sample = texts.select("lang", "text").mapInArrow(windows, "lang string, windows binary")
    rows = sorted((r["lang"], bytes(r["windows"])) for r in sample.collect())  # a kilobyte each
    if not rows:
        return None
    labels = sorted({lang for lang, _ in rows})
    x, y = training_windows(rows, labels)
    return ByteConvNet(labels).fit(x, y)


RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()),
                    ("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of ``(doc_id, held_out, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(net)  # a few tables of fixed size

    def run(batches):
        for b in batches:
            ids, held, texts = (b.column(i).to_pylist() for i in range(3))
            usable = [t is not None and any(map(str.isalpha, t)) for t in texts]
            if sent.value is None:
                usable = [False] * len(texts)
            got = iter(())
            if any(usable):
                got = iter(zip(*sent.value.predict(
                    [t.encode("utf-8", "surrogatepass") for t, u in zip(texts, usable) if u])))
            yield arrow_rows(RESULT, [(i, h, *(next(got) if u else ("und", 0.0)))
                                      for i, h, u in zip(ids, held, usable)])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out",
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


def language_id(docs: DataFrame) -> DataFrame:
    """Train on rows whose ``crc32(doc_id) % 4 != 2``; label every text."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", crc_of_id() % 4 == 2)
    net = fit_language_model(rows.filter(~F.col("held_out")))
    return identify(rows, net)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id(documents(spark, sf_dir))
