"""Toxicity scores from gradient-boosted trees over dense features.

1. A bounded, hash-ordered sample of labelled rows (``SAMPLE_PER_CLASS`` per
   label) is split by hash into three parts.
2. The first part gives the lexicon: words, and word beginnings, whose
   document frequency among toxic rows is significantly above that among
   clean rows (z of the smoothed log odds).
3. Every text becomes ``FEATURES`` dense numbers: lexicon densities, nearness
   of lexicon words to the second person, capitals, punctuation, obfuscation.
4. Boosted trees (logistic loss, histogram splits) are fitted in numpy on the
   second part, and an isotonic calibration on the third.

Only the labels of the sample are learnt from; ``doc_id``, ``lang``, ``source``
never enter a feature. Trees and lexicon are of bounded size, so they are
broadcast; scoring reads each text once.

Defined edge cases: null and empty texts have all-zero features and are scored
like any other; null labels are not learnt from; with no labelled row, or one
class only, every score is that class's share (0 with none); repeated rows are
each scored; a null ``doc_id`` is kept, and hashed as the empty string; of a
labelled id with several texts one is learnt from (the least by hash); ties in
hash go by id; an empty table gives no rows; a very long text is scored whole, in
one pass over its tokens; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, crc_of_id, documents, give_back, keyed_text, lowest_per_class, prepare, table

SAMPLE_PER_CLASS = 6000
PREFIXES = (4, 5)
LEAST_DOCS = 3
LEAST_Z = 3.0
THRESHOLD = 0.7
TOKEN = re.compile(r"[^\W_]+(?:['*@$!0-9][^\W_]+)*")
MIXED = re.compile(r"[^\W\d_]+[*@$!0-9]+[^\W\d_]+")
SPELLED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_]){3,}[^\W\d_](?!\w)")
PUNCTUATION = re.compile(r"[!?]")
# Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
FEATURES = ("word_hits", "word_density", "word_distinct", "word_best", "prefix_hits",
            "prefix_density", "prefix_best", "weight_sum", "near_you", "you_density",
            "capitals", "exclaim", "punctuation_runs", "mixed", "spelled", "log_words")


class Lexicon:
    """Words and word beginnings with their log odds of toxicity."""

    def __init__(self, words: dict[str, float], prefixes: dict[str, float]):
        self.words = words
        self.prefixes = prefixes

    def prefix_weight(self, word: str) -> float:
        return max((self.prefixes.get(word[:n], 0.0) for n in PREFIXES if len(word) > n), default=0.0)


def terms(text: str) -> tuple[set[str], set[str]]:
    words = set(TOKEN.findall(text.lower()))
    return words, {w[:n] for w in words for n in PREFIXES if len(w) > n}


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text."""
    text = text or ""
    words = TOKEN.findall(text.lower())
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)
    known = lexicon.words
    hits = [i for i, w in enumerate(words) if w in known]
    begun = [x for x in map(lexicon.prefix_weight, words) if x > 0] if lexicon.prefixes else []
    weights = [known[words[i]] for i in hits]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0.0
    if hits and you:
        at = np.asarray(you)
        pos = np.searchsorted(at, hits)
        left = np.abs(np.asarray(hits) - at[np.maximum(pos - 1, 0)])
        right = np.abs(at[np.minimum(pos, len(at) - 1)] - np.asarray(hits))
        near = float((1 / (1 + np.minimum(left, right))).max())
    marks = len(PUNCTUATION.findall(text))
    return [
        float(len(hits)), len(hits) / n, float(len({words[i] for i in hits})), max(weights, default=0.0),
        float(len(begun)), len(begun) / n, max(begun, default=0.0), math.fsum(weights),
        near, len(you) / n,
        sum(map(str.isupper, text.split())) / n,
        marks / n, len(re.findall(r"[!?]{2,}", text)) / n,
        len(MIXED.findall(text)) / n, float(len(SPELLED.findall(text))) if n > 4 else 0.0, math.log1p(n),
    ]


def log_odds(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Terms significantly more frequent in toxic documents."""
    out = {}
    for term, a in toxic.items():
        if a < LEAST_DOCS:
            continue
        c = clean.get(term, 0)
        odds = math.log((a + 0.5) / (n_toxic - a + 0.5)) - math.log((c + 0.5) / (n_clean - c + 0.5))
        if odds > 1.5 and odds / math.sqrt(1 / (a + 0.5) + 1 / (c + 0.5)) > LEAST_Z:
            out[term] = odds
    return out


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """From ``(toxic, text)``: document frequencies per class, summed by Spark
    from per-batch counts. The sample is bounded, hence the terms are."""
    schema = pa.schema([("term", pa.string()), ("prefix", pa.bool_()), ("toxic", pa.int32()), ("n", pa.int64())])

    def run(batches):
        give_back()
        for b in batches:
            count = Counter()
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words, begun = terms(text or "")
                count.update((w, False, toxic) for w in words)
                count.update((w, True, toxic) for w in begun)
            yield arrow_rows(schema, [(*k, n) for k, n in count.items()])
    counts = (sample.select("toxic", "text")
              .mapInArrow(run, "term string, prefix boolean, toxic int, n long")
              .groupBy("term", "prefix").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
                                             F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
              .filter(F.col("a") >= LEAST_DOCS))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows = counts.collect()
    found = [log_odds(Counter({r["term"]: r["a"] for r in rows if r["prefix"] == kind}),
                      Counter({r["term"]: r["c"] for r in rows if r["prefix"] == kind}),
                      sizes.get(1, 0), sizes.get(0, 0)) for kind in (False, True)]
    return Lexicon(*found)


class BoostedTrees:
    """Logistic gradient boosting with histogram splits of shallow trees."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32,
                 ridge: float = 1.0, least_weight: float = 1.0):
        self.n_trees, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.ridge, self.least_weight = ridge, least_weight
        self.base, self.trees, self.cuts = 0.0, [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = math.log(share / (1 - share))
        self.cuts = [np.unique(np.quantile(np.unique(c), np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(cut, c, side="left") for cut, c in zip(self.cuts, x.T)], 1)
        margin = np.full(len(y), self.base)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            margin += self._apply(tree, x)
        return self

    def _leaf(self, g: float, h: float) -> tuple:
        return (None, None, self.rate * g / (h + self.ridge))

    def _grow(self, binned, grad, hess, rows, depth) -> tuple:
        g, h = grad[rows].sum(), hess[rows].sum()
        if depth == 0 or h < 2 * self.least_weight:
            return self._leaf(g, h)
        best, choice = 1e-6, None
        for j, cut in enumerate(self.cuts):
            if not len(cut):
                continue
            bins = binned[rows, j]
            gl = np.cumsum(np.bincount(bins, grad[rows], len(cut) + 1))[:-1]
            hl = np.cumsum(np.bincount(bins, hess[rows], len(cut) + 1))[:-1]
            ok = (hl >= self.least_weight) & (h - hl >= self.least_weight)
            gain = np.where(ok, gl ** 2 / (hl + self.ridge) + (g - gl) ** 2 / (h - hl + self.ridge)
                            - g ** 2 / (h + self.ridge), -1.0)
            k = int(gain.argmax())
            if gain[k] > best:
                best, choice = gain[k], (j, k)
        if choice is None:
            return self._leaf(g, h)
        j, k = choice
        left = binned[rows, j] <= k
        return (j, float(self.cuts[j][k]), self._grow(binned, grad, hess, rows[left], depth - 1),
                self._grow(binned, grad, hess, rows[~left], depth - 1))

    def _apply(self, tree: tuple, x: np.ndarray) -> np.ndarray:
        if tree[0] is None:
            return np.full(len(x), tree[2])
        left = x[:, tree[0]] <= tree[1]
        out = np.empty(len(x))
        out[left] = self._apply(tree[2], x[left])
        out[~left] = self._apply(tree[3], x[~left])
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += self._apply(tree, x)
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots (margin, probability), non-decreasing."""
    blocks = []  # [sum y, weight, first x, last x]
    for value, group in sorted({v: y[x == v] for v in np.unique(x)}.items()):
        blocks.append([group.sum(), len(group), value, value])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, _, hi = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][3] = hi
    knots = [(at, (s + 0.01) / (w + 0.02)) for s, w, lo, hi in blocks for at in sorted({lo, hi})]
    return np.array([k for k, _ in knots]), np.maximum.accumulate(np.array([p for _, p in knots]))


class ToxicityModel:
    """Features, trees and calibration of one fit."""

    def __init__(self, lexicon: Lexicon, trees: BoostedTrees | None, knots, constant: float = 0.0):
        self.lexicon, self.trees, self.knots, self.constant = lexicon, trees, knots, constant

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.constant)
        x = np.array([features(t, self.lexicon) for t in texts], float).reshape(-1, len(FEATURES))
        return np.clip(np.interp(self.trees.margin(x), *self.knots), 0.0, 1.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled ids of each class, one text each
    (ids repeated with other texts give their least text by hash)."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("toxic in (0, 1) and doc_id is not null")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = known.withColumn("turn", F.xxhash64("doc_id", F.lit(10)))
    chosen = lowest_per_class(known, "toxic", "turn", "doc_id", per_class).drop("turn")
    # at most 2 * per_class rows of two numbers
    found = keyed_text(docs).join(F.broadcast(chosen), "doc_id")
    # one text an id, the least by hash: rows that share a labelled id are one row before they travel
    sample = (found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
              .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(8))))
    lexicon = learn_lexicon(sample.filter("part < 4"))

    def run(batches):
        give_back()
        for b in batches:
            part, toxic, texts = (b.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(toxic, pa.int32()),
                 pa.array([features(t, lexicon) for t in texts], pa.list_(pa.float64()))],
                names=["part", "toxic", "x"])
    rows = (sample.filter("part >= 4").select("part", "toxic", "text")
            .mapInArrow(run, "part long, toxic int, x array<double>").collect())
    rows.sort(key=lambda r: (r["part"], r["toxic"], r["x"]))
    y = np.array([r["toxic"] for r in rows], float)
    if len(set(y)) < 2:
        return ToxicityModel(lexicon, None, None, float(y.mean()) if len(y) else 0.0)
    x = np.array([r["x"] for r in rows], float)
    tune = np.array([r["part"] == 7 for r in rows])
    if len(set(y[tune])) < 2 or len(set(y[~tune])) < 2:
        tune = np.zeros(len(y), bool)
    trees = BoostedTrees().fit(x[~tune], y[~tune])
    hold = tune if tune.any() else ~tune
    return ToxicityModel(lexicon, trees, isotonic(trees.margin(x[hold]), y[hold]))


RESULT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, score)`` of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        give_back()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sent.value.score(b.column(1).to_pylist()))], schema=RESULT)
    return keyed_text(docs).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not predicted toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        give_back()
        for b in batches:
            yield b.filter(pa.array(sent.value.score(b.column(at).to_pylist()) < THRESHOLD, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def learning_rows(labels: DataFrame) -> DataFrame:
    """Labels of rows whose ``crc32(doc_id) % 3 != 1``."""
    return labels.filter(crc_of_id() % 3 != 1)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the learning rows; ``doc_id, held_out, score, predicted``."""
    model = fit_toxicity(docs, learning_rows(labels))
    return (score_toxicity(docs, model)
            .select("doc_id", (crc_of_id() % 3 == 1).alias("held_out"), "score",
                    F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
