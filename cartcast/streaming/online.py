"""Online (per micro-batch) models and tests.

State is tiny (k centres, weights, or per-group count/sum/sum-of-squares). It
is updated in ``foreachBatch`` from distributed aggregates of the batch and
stored per batch id next to the query's checkpoint. A batch starts from the
newest state of an earlier batch, so a replayed batch gives the same state
again, and a query restarted from its checkpoint goes on where it stopped.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ModelStore:
    """Small model states in a shared folder, one file per batch id."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _fs(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        return hadoop, root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        hadoop, root, fs = self._fs()
        if not fs.exists(root):
            return []
        found = [s.getPath() for s in fs.listStatus(root)]
        return sorted(int(p.getName().split("=")[1]) for p in found
                      if p.getName().startswith("state=") and fs.exists(hadoop.Path(p, "_SUCCESS")))

    def save(self, batch_id: int, state: dict) -> None:
        row = self.spark.createDataFrame([(json.dumps(state),)], "state string")
        row.coalesce(1).write.mode("overwrite").text(f"{self.path}/state={batch_id}")

    def load(self, before: int | None = None) -> dict | None:
        """Newest state, or the newest of batches before a given one."""
        ids = [b for b in self.batches() if before is None or b < before]
        if not ids:
            return None
        return json.loads(self.spark.read.text(f"{self.path}/state={ids[-1]}").first()[0])


def student_t_two_sided_p(t: float, df: float) -> float:
    """Two-sided p-value of Student's t.

    With ``t = sqrt(df) * tan(a)`` the density becomes ``cos(a) ** (df - 1)``
    up to its constant, so the central probability is an integral of a smooth
    function over ``[0, atan(|t| / sqrt(df))]``. It is summed by Simpson's rule
    in the substituted angle, over the tail where that is shorter, with the
    step a small part of the function's width ``1 / sqrt(df)``.
    """
    if t == 0:
        return 1.0
    edge = math.atan2(abs(t), math.sqrt(df))
    log_scale = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(math.pi)
    width = 1 / math.sqrt(max(df, 1.0))

    def area(lo: float, hi: float) -> float:
        n = 2 * max(200, min(200_000, math.ceil((hi - lo) / width * 100)))
        h = (hi - lo) / n
        total = 0.0
        for i in range(n + 1):
            c = math.cos(lo + i * h)
            f = math.exp(log_scale + (df - 1) * math.log(c)) if c > 0 else (math.exp(log_scale) if df == 1 else 0.0)
            total += f * (1 if i in (0, n) else 4 if i % 2 else 2)
        return total * h / 3
    if edge < 3 * width and edge < math.pi / 4:
        p = 1 - 2 * area(0.0, edge)
    else:  # the tail, as far as the function differs from zero
        p = 2 * area(edge, min(math.pi / 2, edge + 40 * width))
    return min(1.0, max(0.0, p))


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """count, sum, sum of squares per group: mergeable across batches."""
    x = F.col(value).cast("double")
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("ss"))


def welch_from_moments(rows) -> tuple[float, float, float]:
    """(t, df, p) for two groups given [(n, s, ss), (n, s, ss)]."""
    (n1, s1, q1), (n2, s2, q2) = rows
    m1, m2 = s1 / n1, s2 / n2
    v1 = (q1 - n1 * m1 * m1) / (n1 - 1)
    v2 = (q2 - n2 * m2 * m2) / (n2 - 1)
    se2 = v1 / n1 + v2 / n2
    t = (m1 - m2) / math.sqrt(se2)
    df = se2 * se2 / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1))
    return t, df, student_t_two_sided_p(t, df)


def welch_columns(moments: DataFrame, group: str, a, b) -> DataFrame:
    """Welch t statistic and degrees of freedom as Columns over a two-row
    moments frame (pivoted to one row)."""
    one = moments.groupBy().agg(
        *[F.max(F.when(F.col(group) == F.lit(g), F.col(c))).alias(f"{c}{i}")
          for i, g in ((1, a), (2, b)) for c in ("n", "s", "ss")])
    m1, m2 = F.col("s1") / F.col("n1"), F.col("s2") / F.col("n2")
    v1 = (F.col("ss1") - F.col("n1") * m1 * m1) / (F.col("n1") - 1)
    v2 = (F.col("ss2") - F.col("n2") * m2 * m2) / (F.col("n2") - 1)
    se2 = v1 / F.col("n1") + v2 / F.col("n2")
    return one.select(((m1 - m2) / F.sqrt(se2)).alias("t"),
                      (se2 * se2 / (F.pow(v1 / F.col("n1"), 2) / (F.col("n1") - 1)
                                    + F.pow(v2 / F.col("n2"), 2) / (F.col("n2") - 1))).alias("df"))


class StreamingKMeans:
    """Mini-batch k-means with a decay factor (T21). Each batch costs one
    aggregate; centres and weights (k x d, bounded) are stored per batch."""

    def __init__(self, centers: Sequence[Sequence[float]], decay: float = 1.0, store: ModelStore | None = None):
        self.centers = [list(map(float, c)) for c in centers]
        self.weights = [0.0] * len(self.centers)
        self.decay = decay
        self.store = store
        self.first = {"centers": self.centers, "weights": self.weights}
        self._restore(store.load() if store else None)

    def _restore(self, state: dict | None) -> None:
        state = state or self.first
        self.centers = [list(c) for c in state["centers"]]
        self.weights = list(state["weights"])

    def assign(self, df: DataFrame, col: str = "x") -> DataFrame:
        """Nearest centre of every row (batch or streaming)."""
        carr = F.array(*[F.array(*[F.lit(v) for v in c]) for c in self.centers])
        dist = F.transform(carr, lambda c: F.aggregate(F.zip_with(c, F.col(col), lambda a, b: (a - b) * (a - b)),
                                                       F.lit(0.0), lambda s, v: s + v))
        return df.withColumn("cluster", F.array_position(dist, F.array_min(dist)).cast("int") - 1)

    def update(self, batch: DataFrame, batch_id: int, col: str = "x") -> None:
        if self.store:
            self._restore(self.store.load(before=batch_id))
        dim = len(self.centers[0])
        a = self.assign(batch, col)
        sums = a.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.col(col)[i]).alias(f"s{i}") for i in range(dim)]).collect()  # <= k rows
        for r in sums:
            k, n = r["cluster"], r["n"]
            w_old = self.weights[k] * self.decay
            new_w = w_old + n
            self.centers[k] = [(self.centers[k][i] * w_old + r[f"s{i}"]) / new_w for i in range(dim)]
            self.weights[k] = new_w
        if self.store:
            self.store.save(batch_id, {"centers": self.centers, "weights": self.weights})


class StreamingSGD:
    """Online linear or logistic regression (T22, T23): ``iterations``
    gradient steps per micro-batch, the i-th of size ``step / sqrt(i)``.

    Least squares needs the batch's second moments only, one aggregate for any
    number of steps; the logistic gradient is an aggregate per step over the
    batch. Weights (d + 1 numbers) are stored per batch.
    """

    def __init__(self, dim: int, step: float = 0.1, logistic: bool = False, iterations: int = 50,
                 store: ModelStore | None = None):
        self.w = [0.0] * (dim + 1)  # the last one belongs to the constant 1
        self.step = step
        self.logistic = logistic
        self.iterations = iterations
        self.store = store
        self._restore(store.load() if store else None)

    def _restore(self, state: dict | None) -> None:
        self.w = list(state["w"]) if state else [0.0] * len(self.w)

    def _columns(self, col: str) -> list:
        return [F.col(col)[i] for i in range(len(self.w) - 1)] + [F.lit(1.0)]

    def predict_col(self, col: str = "x"):
        m = F.lit(0.0)
        for wi, x in zip(self.w, self._columns(col)):
            m = m + F.lit(wi) * x
        return 1 / (1 + F.exp(-m)) if self.logistic else m

    def update(self, batch: DataFrame, batch_id: int, col: str = "x", label: str = "y") -> None:
        if self.store:
            self._restore(self.store.load(before=batch_id))
        if self.logistic:
            self._logistic_steps(batch, col, label)
        else:
            self._linear_steps(batch, col, label)
        if self.store:
            self.store.save(batch_id, {"w": self.w})

    def _apply(self, i: int, gradient: list[float], n: int) -> None:
        size = self.step / math.sqrt(i)
        self.w = [w - size * g / n for w, g in zip(self.w, gradient)]

    def _linear_steps(self, batch: DataFrame, col: str, label: str) -> None:
        x, d = self._columns(col), len(self.w)
        m = batch.agg(F.count(F.lit(1)).alias("n"),
                      *[F.sum(x[i] * x[j]).alias(f"x{i}_{j}") for i in range(d) for j in range(i, d)],
                      *[F.sum(x[i] * F.col(label)).alias(f"y{i}") for i in range(d)]).first()
        if not m["n"]:
            return
        xx = [[m[f"x{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)]
        for step in range(1, self.iterations + 1):
            self._apply(step, [math.fsum([xx[i][j] * self.w[j] for j in range(d)] + [-m[f"y{i}"]])
                               for i in range(d)], m["n"])

    def _logistic_steps(self, batch: DataFrame, col: str, label: str) -> None:
        batch = batch.persist()
        try:
            for step in range(1, self.iterations + 1):
                err = self.predict_col(col) - F.col(label)
                g = batch.agg(F.count(F.lit(1)).alias("n"),
                              *[F.sum(err * x).alias(f"g{i}") for i, x in enumerate(self._columns(col))]).first()
                if not g["n"]:
                    return
                self._apply(step, [g[f"g{i}"] for i in range(len(self.w))], g["n"])
        finally:
            batch.unpersist()


class StreamingWelch:
    """Two-sample Welch test over a stream (T24): per batch, one grouped
    aggregate of (n, sum, sum of squares) is merged into running moments. Once
    p < ``alpha``, or after ``max_batches``, ``done()`` is true and the caller
    stops the query (``runner.drain``); no batch is taken and ignored."""

    def __init__(self, group: str, value: str, a, b, alpha: float = 0.05, max_batches: int = 10,
                 store: ModelStore | None = None):
        self.group, self.value, self.a, self.b = group, value, a, b
        self.alpha, self.max_batches = alpha, max_batches
        self.store = store
        self._restore(store.load() if store else None)

    def _restore(self, state: dict | None) -> None:
        self.m = [list(x) for x in state["m"]] if state else [[0, 0.0, 0.0], [0, 0.0, 0.0]]
        self.history = [tuple(h) for h in state["history"]] if state else []
        self.batches = state["batches"] if state else 0

    def done(self) -> bool:
        return self.batches >= self.max_batches or bool(self.history and self.history[-1][3] < self.alpha)

    def update(self, batch: DataFrame, batch_id: int) -> None:
        if self.store:
            self._restore(self.store.load(before=batch_id))
        for r in group_moments(batch.filter(F.col(self.group).isin(self.a, self.b)),
                               self.group, self.value).collect():  # <= 2 rows
            acc = self.m[0 if r[self.group] == self.a else 1]
            acc[0] += r["n"]
            acc[1] += r["s"]
            acc[2] += r["ss"]
        self.batches += 1
        if all(x[0] > 1 for x in self.m):
            self.history.append((batch_id, *welch_from_moments(self.m)))
        if self.store:
            self.store.save(batch_id, {"m": self.m, "history": self.history, "batches": self.batches})
