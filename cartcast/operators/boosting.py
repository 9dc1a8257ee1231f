"""Softmax gradient boosting with histograms (M1).

One tree per round serves all classes: a leaf holds one weight per class, and
a split is scored by the sum of the classes' gains. Per level of a tree, tasks
add the gradient and hessian vectors of their rows by (node, feature, bin), one
small shuffle sums them, splits are searched in the tasks that hold a (node,
feature) histogram, and the driver receives one row per node. Rows never move:
they are stored once as one byte per feature, and a task finds a row's margins
and node by applying the trees so far. What travels is bounded by the model
(nodes x features x bins x classes), not by the rows.

Objective and parameters are those of multi-class softmax boosting: gradient
``p - 1[y]``, hessian ``2 p (1 - p)``, leaf weight ``-eta G / (H + lambda)``, gain
``(GL^2/(HL+lambda) + GR^2/(HR+lambda) - G^2/(H+lambda)) / 2 - gamma`` summed over
classes, a child's weight being its summed hessian over the classes. A value
equal to ``missing`` has a bin of its own that goes to the side of larger gain.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved_table

_PARTIAL = pa.schema([("node", pa.int32()), ("feature", pa.int32()), ("sums", pa.list_(pa.float64()))])
_SPLIT_DDL = ("node int, feature int, gain double, threshold int, missing_left boolean, "
              "left_g array<double>, left_h array<double>, g array<double>, h array<double>")


@dataclass
class Tree:
    """Nodes by index: an inner node has a feature, a threshold (bins up to it
    go left) and the side of missing values; a leaf has weights."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    weight: list[np.ndarray | None] = field(default_factory=lambda: [None])

    def split(self, node: int, feature: int, threshold: int, missing_left: bool) -> int:
        """Give ``node`` two children; the left one's index (right is next)."""
        child = len(self.feature)
        self.feature[node], self.threshold[node], self.missing_left[node] = feature, threshold, missing_left
        self.left[node], self.weight[node] = child, None
        for _ in range(2):
            self.feature.append(-1)
            self.threshold.append(0)
            self.missing_left.append(False)
            self.left.append(0)
            self.weight.append(None)
        return child

    def route(self, bins: np.ndarray) -> np.ndarray:
        """Node of every row (rows x features of bins)."""
        node = np.zeros(len(bins), np.int64)
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        missing_left, left = np.array(self.missing_left), np.array(self.left)
        rows = np.arange(len(bins))
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            b = bins[rows, np.maximum(f, 0)]
            goes_left = np.where(b == 0, missing_left[node], b <= threshold[node])
            node = np.where(inner, left[node] + ~goes_left, node)

    def margins(self, bins: np.ndarray, classes: int) -> np.ndarray:
        table = np.array([np.zeros(classes) if w is None else w for w in self.weight])
        return table[self.route(bins)]


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def best_split(hist: np.ndarray, lam: float, gamma: float, least: float):
    """Best threshold of one feature: ``hist`` is (bins + 1) x 2 x classes,
    bin 0 the missing values. Returns (gain, threshold, missing_left, GL, HL);
    of equal gains the smallest threshold, missing to the right."""
    g, h = hist[:, 0], hist[:, 1]
    total_g, total_h = g.sum(axis=0), h.sum(axis=0)
    below_g, below_h = np.cumsum(g[1:], axis=0)[:-1], np.cumsum(h[1:], axis=0)[:-1]

    def score(a, b):
        return (a * a / (b + lam)).sum(axis=-1)
    found = (-np.inf, 0, False, None, None)
    for missing_left in (False, True):
        lg, lh = (below_g + g[0], below_h + h[0]) if missing_left else (below_g, below_h)
        rg, rh = total_g - lg, total_h - lh
        gain = (score(lg, lh) + score(rg, rh) - score(total_g, total_h)) / 2 - gamma
        gain[(lh.sum(axis=1) < least) | (rh.sum(axis=1) < least)] = -np.inf
        if len(gain):
            i = int(np.argmax(np.round(gain, 9)))
            if gain[i] > found[0] + 1e-9:
                found = (float(gain[i]), i + 1, missing_left, lg[i], lh[i])
    return found


class SoftmaxBoosting:
    """Estimator over (label, features): labels are 0 .. ``classes`` - 1."""

    def __init__(self, classes: int = 32, rounds: int = 7, depth: int = 7, eta: float = 0.1, reg_lambda: float = 2.0,
                 gamma: float = 0.1, min_child_weight: float = 5.0, colsample: float = 0.8, bins: int = 32,
                 missing: float = 0.0, seed: int = 7):
        if not 2 <= bins <= 254:
            raise ValueError("bins must lie in 2 .. 254")
        self.classes, self.rounds, self.depth, self.eta = classes, rounds, depth, eta
        self.reg_lambda, self.gamma, self.min_child_weight = reg_lambda, gamma, min_child_weight
        self.colsample, self.bins, self.missing, self.seed = colsample, bins, missing, seed

    # -- rows --------------------------------------------------------------
    def _ranges(self, df: DataFrame):
        if df.isEmpty():
            raise ValueError("no training rows")
        r = df.select(Summarizer.metrics("min", "max").summary(F.col("features")).alias("s")).first()["s"]
        return np.array(r["min"].toArray()), np.array(r["max"].toArray())

    def _binned(self, df: DataFrame, binner: "Binner") -> DataFrame:
        """(label int, bins binary), stored: later passes read only this."""
        def run(batches):
            for b in batches:
                x = binner.of(b.column(1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], ["label", "bins"])
        rows = df.select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x"))
        return saved_table(rows.mapInArrow(run, "label int, bins binary"), "boosting-bins")

    def _features(self, n: int, round_no: int) -> list[int]:
        """The features of a round's tree: a repeatable share."""
        order = sorted(range(n), key=lambda f: hashlib.md5(f"{self.seed}:{round_no}:{f}".encode()).digest())
        return sorted(order[:max(1, round(self.colsample * n))])

    # -- one level ---------------------------------------------------------
    def _level(self, binned: DataFrame, trees: list[Tree], tree: Tree, nodes: list[int], features: list[int]) -> DataFrame:
        """Best split of every (node, feature)."""
        k, width = self.classes, self.bins + 1
        lam, gamma, least = self.reg_lambda, self.gamma, self.min_child_weight

        def partial(batches):
            place = np.full(len(tree.feature), -1)
            place[nodes] = np.arange(len(nodes))
            sums = np.zeros((len(features), len(nodes) * width, 2 * k))
            seen = False
            for b in batches:
                if not b.num_rows:
                    continue
                label = b.column(0).to_numpy(zero_copy_only=False)
                bins = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                at = place[tree.route(bins)]
                keep = np.flatnonzero(at >= 0)
                if not len(keep):
                    continue
                seen = True
                bins, label, at = bins[keep], label[keep], at[keep]
                p = softmax(sum((t.margins(bins, k) for t in trees), np.zeros((len(bins), k))))
                both = np.concatenate([p, np.maximum(2 * p * (1 - p), 1e-16)], axis=1)
                both[np.arange(len(label)), label] -= 1
                for i, f in enumerate(features):
                    key = at * width + bins[:, f]
                    order = np.argsort(key, kind="stable")
                    first = np.flatnonzero(np.diff(key[order], prepend=-1))
                    sums[i, key[order][first]] += np.add.reduceat(both[order], first, axis=0)
            if seen:
                rows = [(nodes[n], f, sums[i, n * width:(n + 1) * width].ravel())
                        for i, f in enumerate(features) for n in range(len(nodes))]
                for s in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t.type) for c, t in zip(zip(*rows[s:s + 64]), _PARTIAL)], schema=_PARTIAL)

        def search(batches):
            for b in batches:
                out = []
                for node, feature, sums in zip(*[c.to_pylist() for c in b.columns]):
                    hist = np.array(sums).reshape(width, 2, k)
                    gain, threshold, missing_left, lg, lh = best_split(hist, lam, gamma, least)
                    none = np.zeros(k)
                    out.append((node, feature, gain, threshold, missing_left, none if lg is None else lg,
                                none if lh is None else lh, hist[:, 0].sum(axis=0), hist[:, 1].sum(axis=0)))
                if out:
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=[
                        "node", "feature", "gain", "threshold", "missing_left", "left_g", "left_h", "g", "h"]).astype(
                            {"node": "int32", "feature": "int32", "threshold": "int32"}), preserve_index=False)
        parts = binned.mapInArrow(partial, "node int, feature int, sums array<double>")
        whole = parts.groupBy("node", "feature").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
        return whole.select("node", "feature", vector_to_array("sums").alias("sums")).mapInArrow(search, _SPLIT_DDL)

    def root_splits(self, df: DataFrame) -> DataFrame:
        """``feature, gain, threshold, missing_left`` of the first tree's root,
        before any column sampling: gains are over uniform class probabilities."""
        lo, hi = self._ranges(df)
        binned = self._binned(df, Binner(lo, hi, self.bins, self.missing))
        return self._level(binned, [], Tree(), [0], list(range(len(lo)))).select(
            "feature", "gain", "threshold", "missing_left")

    def fit(self, df: DataFrame) -> "SoftmaxModel":
        lo, hi = self._ranges(df)
        binner = Binner(lo, hi, self.bins, self.missing)
        binned = self._binned(df, binner)
        trees: list[Tree] = []
        for r in range(self.rounds):
            tree, nodes = Tree(), [0]
            features = self._features(len(lo), r)
            for _ in range(self.depth):
                splits = self._level(binned, trees, tree, nodes, features)
                best = splits.groupBy("node").agg(F.max_by(
                    F.struct(*splits.columns), F.struct(F.round("gain", 9), -F.col("feature"))).alias("s"))
                rows = [x["s"] for x in best.collect()]  # one row per open node
                nodes = self._grow(tree, rows)
                if not nodes:
                    break
            trees.append(tree)
        return SoftmaxModel(binner, trees, self.classes)

    def _grow(self, tree: Tree, rows) -> list[int]:
        """Split the nodes that gain; children are leaves until they split.
        Returns the nodes of the next level."""
        nodes = []
        for r in sorted(rows, key=lambda r: r["node"]):
            g, h = np.array(r["g"]), np.array(r["h"])
            tree.weight[r["node"]] = self._leaf(g, h)
            if r["gain"] > 0 and np.isfinite(r["gain"]):
                lg, lh = np.array(r["left_g"]), np.array(r["left_h"])
                child = tree.split(r["node"], r["feature"], r["threshold"], r["missing_left"])
                tree.weight[child], tree.weight[child + 1] = self._leaf(lg, lh), self._leaf(g - lg, h - lh)
                nodes += [child, child + 1]
        return nodes

    def _leaf(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return -self.eta * g / (h + self.reg_lambda)


@dataclass
class Binner:
    """Equal-width bins per feature, 1 .. bins; 0 for the missing value.
    Values outside the fitted range fall into the outer bins."""

    lo: np.ndarray
    hi: np.ndarray
    bins: int
    missing: float

    def of(self, column: pa.Array) -> np.ndarray:
        return self.matrix(np.array(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1))

    def matrix(self, x: np.ndarray) -> np.ndarray:
        span = np.where(self.hi > self.lo, self.hi - self.lo, 1.0)
        at = np.floor((x - self.lo) / span * self.bins + 1e-9)
        at = np.clip(np.where(np.isnan(at), 0, at), 0, self.bins - 1) + 1
        return np.where((x == self.missing) | np.isnan(x), 0, at).astype(np.uint8)


class SoftmaxModel:
    """Fitted trees; ``transform`` adds ``probabilities`` (one per class) and
    ``prediction`` (the likeliest class, the smallest of equals)."""

    def __init__(self, binner: Binner, trees: list[Tree], classes: int):
        self.binner, self.trees, self.classes = binner, trees, classes

    def first_rounds(self, n: int) -> "SoftmaxModel":
        return SoftmaxModel(self.binner, self.trees[:n], self.classes)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        bins = self.binner.matrix(x)
        return softmax(sum((t.margins(bins, self.classes) for t in self.trees), np.zeros((len(x), self.classes))))

    def transform(self, df: DataFrame) -> DataFrame:
        model = self

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(model.probabilities(np.stack(x.to_numpy()))))
        return (df.withColumn("probabilities", score(vector_to_array("features")))
                .withColumn("prediction", (F.array_position("probabilities", F.array_max("probabilities")) - 1)
                            .cast("double")))
