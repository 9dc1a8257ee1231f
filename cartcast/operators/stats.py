"""Statistics and linear algebra on DataFrames."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import global_running_sum, hash_unit


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of several column pairs in one pass."""
    return df.agg(*[F.corr(a, b).alias(f"corr_{a}_{b}") for a, b in pairs])


def chi_square_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson chi-square statistic and degrees of freedom for a contingency
    table (V11). Uses sum(O^2/E) - N, so only observed cells are visited."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    ra = cells.groupBy(a).agg(F.sum("o").alias("ra"))
    cb = cells.groupBy(b).agg(F.sum("o").alias("cb"))
    tot = cells.agg(F.sum("o").alias("n"), F.count_distinct(a).alias("r"),
                    F.count_distinct(b).alias("c")).first()
    j = cells.join(ra, a).join(cb, b)
    e = F.col("ra") * F.col("cb") / F.lit(tot["n"])
    return j.agg((F.sum(F.col("o") * F.col("o") / e) - F.lit(tot["n"])).alias("statistic")) \
            .withColumn("dof", F.lit((tot["r"] - 1) * (tot["c"] - 1)))


def chi_square_uniform(df: DataFrame, col: str) -> DataFrame:
    """Goodness of fit of observed category counts against equal frequencies."""
    cells = df.groupBy(col).agg(F.count(F.lit(1)).alias("o"))
    tot = cells.agg(F.sum("o").alias("n"), F.count(F.lit(1)).alias("k")).first()
    e = tot["n"] / tot["k"]
    return cells.agg(F.sum(F.pow(F.col("o") - F.lit(e), 2) / F.lit(e)).alias("statistic")) \
                .withColumn("dof", F.lit(tot["k"] - 1))


def ks_statistic(df: DataFrame, col: str, cdf: Callable[[Column], Column]) -> DataFrame:
    """One-sample Kolmogorov–Smirnov distance to a CDF given as a Column
    function (V12). Rows are first grouped by distinct value; the empirical
    CDF comes from ``global_running_sum``, so no task sorts everything."""
    g = df.groupBy(F.col(col).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("c"))
    n = g.agg(F.sum("c")).first()[0]
    cum = global_running_sum(g, "x", "c", "cum")
    fx = cdf(F.col("x"))
    hi = F.col("cum") / F.lit(n) - fx
    lo = fx - (F.col("cum") - F.col("c")) / F.lit(n)
    return cum.agg(F.max(F.greatest(hi, lo)).alias("d")).withColumn("n", F.lit(n))


def erf_nodes(n: int = 48) -> tuple[list[float], list[float]]:
    """Gauss–Legendre nodes and weights on [0, 1]."""
    x, w = np.polynomial.legendre.leggauss(n)
    return ((x + 1) / 2).tolist(), (w / 2).tolist()


def normal_cdf(mean: float, std: float) -> Callable[[Column], Column]:
    """Normal CDF as a Column function in built-in functions:
    ``erf(z) = 2z / sqrt(pi) * integral of exp(-z²u²) over [0, 1]`` by
    quadrature (to about 1e-14; beyond six it is one)."""
    nodes, weights = erf_nodes()

    def cdf(x: Column) -> Column:
        z = F.greatest(F.lit(-6.0), F.least(F.lit(6.0), (x - F.lit(mean)) / F.lit(std * math.sqrt(2))))
        total = F.lit(0.0)
        for u, w in zip(nodes, weights):
            total = total + F.lit(w) * F.exp(-z * z * F.lit(u * u))
        return (1 + z * total * F.lit(2 / math.sqrt(math.pi))) / 2
    return cdf


def kernel_density(df: DataFrame, col: str, points: Sequence[float], bandwidth: float) -> DataFrame:
    """Gaussian kernel density at given points (V13): one aggregate column
    per point, no join; result is long form (point, density)."""
    x = F.col(col).cast("double")
    norm = 1.0 / (bandwidth * math.sqrt(2 * math.pi))
    aggs = [(F.avg(F.exp(-F.pow((F.lit(float(p)) - x) / bandwidth, 2) / 2)) * norm).alias(f"d{i}")
            for i, p in enumerate(points)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"{float(p)}D, d{i}" for i, p in enumerate(points))
    return wide.selectExpr(f"stack({len(points)}, {pairs}) AS (point, density)")


def gram_upper(df: DataFrame, vec_col: str, dim: int) -> np.ndarray:
    """Gram matrix AᵀA of a tall matrix whose rows are array columns.

    Each Arrow batch contributes one partial ``XᵀX`` (numpy, inside the
    task); the partials are added by ``Summarizer.sum`` with partial
    aggregation. Output is dim x dim, bounded by the column count.
    """
    def partial(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf[vec_col].to_numpy()).astype(np.float64)
            yield pd.DataFrame({"g": [(x.T @ x).ravel().tolist()]})

    parts = df.select(vec_col).mapInPandas(partial, "g array<double>")
    total = (parts.select(Summarizer.sum(array_to_vector("g")).alias("s"))
                  .first()["s"].toArray())
    return total.reshape(dim, dim)


def column_cosines(df: DataFrame, vec_col: str, dim: int) -> DataFrame:
    """Cosine similarity of every column pair i < j (V14), exact, from the
    Gram matrix. Output has dim*(dim-1)/2 rows."""
    g = gram_upper(df, vec_col, dim)
    norms = np.sqrt(np.diag(g))
    rows = [(i, j, float(g[i, j] / (norms[i] * norms[j])) if norms[i] * norms[j] > 0 else 0.0)
            for i in range(dim) for j in range(i + 1, dim)]
    return df.sparkSession.createDataFrame(rows, "i int, j int, cosine double")


def column_cosines_sampled(df: DataFrame, vec_col: str, dim: int, threshold: float, key: str,
                           salt: int = 0) -> DataFrame:
    """Estimated cosine of column pairs (V14): each entry of a row is kept with
    a probability that falls with its column's norm, by a hash of (row,
    column), and weighted back, so pairs at or above ``threshold`` come out
    close and the work per row is bounded by the kept entries. Entries above
    the kept share are few for long columns; rows stay in SQL throughout."""
    x = df.select(F.col(key).cast("string").alias("k"), F.posexplode(F.col(vec_col)).alias("c", "v"))
    x = x.select("k", "c", F.col("v").cast("double").alias("v"))
    n = df.count()
    norms = {r["c"]: math.sqrt(r["s"]) for r in x.groupBy("c").agg(F.sum(F.col("v") * F.col("v")).alias("s")).collect()}
    gamma = math.sqrt(10 * math.log(max(dim, 2)) / threshold)
    rate = {c: min(1.0, gamma / s) if s else 0.0 for c, s in norms.items()}  # one number per column
    norm = F.create_map(*[F.lit(v) for c, s in norms.items() for v in (c, min(gamma, s))])
    keep = F.create_map(*[F.lit(v) for c, r in rate.items() for v in (c, r)])
    kept = x.filter(hash_unit(F.concat_ws("-", "k", "c"), salt) < keep[F.col("c")])
    kept = kept.select("k", "c", (F.col("v") / norm[F.col("c")]).alias("v"))
    pairs = kept.join(kept.select("k", F.col("c").alias("j"), F.col("v").alias("w")), "k").filter("c < j")
    return pairs.groupBy(F.col("c").alias("i"), "j").agg(F.sum(F.col("v") * F.col("w")).alias("cosine"))


def svd(df: DataFrame, vec_col: str, dim: int, k: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``A = U diag(s) V'`` of a tall matrix (V15): s and V from the small Gram
    matrix, U as a column ``u`` of the rows (``A V / s``, array expressions)."""
    values, vectors = np.linalg.eigh(gram_upper(df, vec_col, dim))
    order = np.argsort(values)[::-1][:k]
    s = np.sqrt(np.clip(values[order], 0, None))
    v = vectors[:, order]
    dot = [F.aggregate(F.zip_with(F.transform(vec_col, lambda x: x.cast("double")),
                                  F.array(*[F.lit(float(z)) for z in v[:, c]]), lambda a, b: a * b),
                       F.lit(0.0), lambda a, b: a + b) / F.lit(float(s[c]) or 1.0) for c in range(k)]
    return df.withColumn("u", F.array(*dot)), s, v


def singular_values(df: DataFrame, vec_col: str, dim: int) -> np.ndarray:
    """Singular values of the tall matrix (V15) from the eigenvalues of the
    small Gram matrix (dim x dim solve on the driver)."""
    eig = np.linalg.eigvalsh(gram_upper(df, vec_col, dim))
    return np.sqrt(np.clip(eig[::-1], 0, None))


def vector_summary(df: DataFrame, vec_col: str) -> DataFrame:
    """Per-dimension mean, variance, non-zeros, min, max (A21) via Summarizer,
    exploded to long form (dim, metric values)."""
    s = df.select(Summarizer.metrics("mean", "variance", "numNonZeros", "max", "min")
                  .summary(F.col(vec_col)).alias("s"))
    z = s.select(F.posexplode(F.arrays_zip(vector_to_array("s.mean").alias("mean"),
                                           vector_to_array("s.variance").alias("variance"),
                                           vector_to_array("s.numNonZeros").alias("nnz"),
                                           vector_to_array("s.max").alias("max"),
                                           vector_to_array("s.min").alias("min"))).alias("dim", "m"))
    return z.select("dim", "m.mean", "m.variance", "m.nnz", "m.max", "m.min")
