import math
import random

import numpy as np
import pytest

from cartcast.operators import folds as FO
from cartcast.operators.quantiles import exact_quantiles, quantile_splits
from cartcast.operators.recommend import top_products
from cartcast.operators.relational import hash_unit


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def plain(values, p):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    return v[min(max(math.ceil(p * len(v) - 1e-9), 1), len(v)) - 1]


@pytest.mark.parametrize("ranges", [2, 16, 1024])
def test_quantiles_are_exact(spark, ranges):
    rng = random.Random(ranges)
    for values in ([rng.gauss(0, 1) for _ in range(500)], [1.0] * 50 + [2.0] * 3, [rng.choice([0.0, 1e-300, 1e300, -1e300]) for _ in range(60)],
                   [10.0 ** rng.randrange(-200, 200) for _ in range(40)], [5.0]):
        p = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
        assert exact_quantiles(column(spark, [*values, None, float("nan")]), "v", p, ranges) == [plain(values, q) for q in p]


def test_quantiles_of_nothing_and_splits(spark):
    assert exact_quantiles(column(spark, [1.0]).limit(0), "v", [0.5]) == [None]
    assert quantile_splits(column(spark, [1.0] * 9 + [2.0]), "v", 4) == [float("-inf"), 1.0, float("inf")]


def test_fold_statistics_equal_refits(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "k long, a double, b double, c double, y double")
    fold = np.array([min(int(r[0] * 4), 3) for r in df.select(hash_unit("k", 2)).collect()])
    moments = FO.fold_moments(df, ["a", "b", "c"], "y", "k", 4, 2)
    for intercept in (True, False):
        rows = FO.ridge_grid(moments, [0.0, 0.1, 10.0], intercept)
        assert len(rows) == 12
        for f, penalty, mse, w in rows:
            train, test = fold != f, fold == f
            a, t = x[train], y[train]
            mx, my = (a.mean(0), t.mean()) if intercept else (np.zeros(3), 0.0)
            want = np.linalg.solve((a - mx).T @ (a - mx) + penalty * len(a) * np.eye(3), (a - mx).T @ (t - my))
            error = y[test] - x[test] @ want - (my - mx @ want)
            assert np.allclose(w[1:], want) and abs(mse - (error ** 2).mean()) < 1e-8
    assert FO.best_penalty(FO.ridge_grid(moments, [0.0, 0.1, 10.0])) in (0.0, 0.1)


@pytest.mark.parametrize("block", [1, 7, 64, 4096])
def test_top_products_equal_brute_force(spark, block):
    rng = np.random.default_rng(block)
    users, items = rng.normal(size=(40, 4)), rng.normal(size=(60, 4)) * rng.random((60, 1)) * 3
    items[10] = items[3]
    users[5] = 0

    def rows(m, shift):
        return spark.createDataFrame([(i + shift, r.tolist()) for i, r in enumerate(m)], "id int, features array<float>")
    users, items = users.astype("float32").astype(float), items.astype("float32").astype(float)
    got = {r["user"]: (r["items"], r["scores"]) for r in top_products(rows(users, 0), rows(items, 100), 3, block).collect()}
    for u, x in enumerate(users):
        score = items @ x
        best = sorted((-s, i + 100) for i, s in enumerate(score))[:3]
        assert np.allclose(got[u][1], [-s for s, _ in best], atol=1e-12)
        assert u == 5 or set(got[u][0]) <= {i + 100 for i, s in enumerate(score) if s >= -best[-1][0] - 1e-12}
    assert len(got) == 40


def test_top_products_of_few_items_and_no_users(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "id int, features array<double>")
    assert [r["items"] for r in top_products(df.where("id = 1"), df, 5).collect()] == [[2, 1]]
    assert top_products(df.limit(0), df, 2).count() == 0
    with pytest.raises(ValueError):
        top_products(df, df, 0)
