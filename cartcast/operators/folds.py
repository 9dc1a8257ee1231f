"""Cross-validation of linear models from fold statistics.

One aggregate gives, per fold, the sums of all products of (1, features, label).
A grid point is then solved from the totals minus its fold and judged on the
fold's own sums, so the rows are read once for any number of grid points.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import hash_unit


def fold_moments(df: DataFrame, features: Sequence[str], label: str, key: str, folds: int,
                 salt: int = 0) -> dict[int, np.ndarray]:
    """Per fold the matrix of sums of products of ``[1, *features, label]``
    (one row per fold reaches the driver). A row's fold follows from a hash of
    its key."""
    fold = F.least(F.floor(hash_unit(key, salt) * folds), F.lit(folds - 1)).cast("int")
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in (*features, label)]]
    n = len(cols)
    sums = [F.sum(cols[i] * cols[j]).alias(f"s{i}_{j}") for i in range(n) for j in range(i, n)]
    out = {}
    for r in df.groupBy(fold.alias("fold")).agg(*sums).collect():
        m = np.zeros((n, n))
        for i in range(n):
            for j in range(i, n):
                m[i, j] = m[j, i] = r[f"s{i}_{j}"] or 0.0
        out[r["fold"]] = m
    return out


def ridge_grid(moments: dict[int, np.ndarray], penalties: Sequence[float], fit_intercept: bool = True) -> list[tuple]:
    """(fold, penalty, mean squared error on the fold, coefficients) for the
    ridge fit on the other folds: ``sum of squares / (2 n) + penalty / 2 |w|^2``, the
    intercept free."""
    total = sum(moments.values())
    rows = []
    for fold in sorted(moments):
        own = moments[fold]
        rest = total - own
        n = rest[0, 0]
        for penalty in penalties:
            if fit_intercept:
                mean = rest[0, 1:] / n
                c = rest[1:, 1:] - n * np.outer(mean, mean)
                w = np.linalg.solve(c[:-1, :-1] + penalty * n * np.eye(len(c) - 1), c[:-1, -1])
                full = np.concatenate([[mean[-1] - w @ mean[:-1]], w])
            else:
                a = rest[1:, 1:]
                w = np.linalg.solve(a[:-1, :-1] + penalty * n * np.eye(len(a) - 1), a[:-1, -1])
                full = np.concatenate([[0.0], w])
            x, xy, yy = own[:-1, :-1], own[:-1, -1], own[-1, -1]
            mse = (yy - 2 * full @ xy + full @ x @ full) / own[0, 0]
            rows.append((fold, penalty, float(mse), full))
    return rows


def best_penalty(rows: list[tuple]) -> float:
    """The penalty of least mean error over the folds (the smaller of equals)."""
    by: dict[float, list[float]] = {}
    for _, penalty, mse, _ in rows:
        by.setdefault(penalty, []).append(mse)
    return min(by, key=lambda p: (np.mean(by[p]), p))
