import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cartcast.operators.boosting import Binner, SoftmaxBoosting, best_split, softmax


def frame(spark, rows):
    return spark.createDataFrame(rows, "label double, x array<double>").select(
        "label", array_to_vector("x").alias("features"))


@pytest.fixture(scope="module")
def planted(spark):
    """Three classes decided by two features, a third is noise, a fourth is
    missing (zero) exactly in class 2."""
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(600):
        x = rng.random(4) * 0.9 + 0.1
        y = 2.0 if rng.random() < 0.2 else float(x[0] > 0.5) if x[1] > 0.3 else 0.0
        if y == 2.0:
            x[3] = 0.0
        rows.append((y, x.tolist()))
    return rows


def plain_round(rows, model):
    """One boosting round by plain loops over rows, from uniform classes."""
    k, lam, gamma = model.classes, model.reg_lambda, model.gamma
    x = np.array([r[1] for r in rows])
    y = np.array([int(r[0]) for r in rows])
    bins = Binner(x.min(0), x.max(0), model.bins, model.missing).matrix(x)
    p = np.full((len(rows), k), 1 / k)
    g, h = p - np.eye(k)[y], 2 * p * (1 - p)

    def grow(at, depth):
        total_g, total_h = g[at].sum(0), h[at].sum(0)
        best = (0.0, None)
        if depth < model.depth:
            for f in model._features(x.shape[1], 0):
                for t in range(1, model.bins):
                    for missing_left in (False, True):
                        left = at[np.where(bins[at, f] == 0, missing_left, bins[at, f] <= t)]
                        right = np.setdiff1d(at, left)
                        if h[left].sum() < model.min_child_weight or h[right].sum() < model.min_child_weight:
                            continue
                        gain = sum((g[s].sum(0) ** 2 / (h[s].sum(0) + lam)).sum() for s in (left, right))
                        gain = (gain - (total_g ** 2 / (total_h + lam)).sum()) / 2 - gamma
                        if gain > best[0] + 1e-7:
                            best = (gain, (left, right))
        if best[1] is None:
            out[at] = -model.eta * total_g / (total_h + lam)
        else:
            for s in best[1]:
                grow(s, depth + 1)
    out = np.zeros((len(rows), k))
    grow(np.arange(len(rows)), 0)
    return softmax(out)


def test_a_round_equals_plain_loops(spark, planted):
    est = SoftmaxBoosting(classes=3, rounds=1, depth=3, bins=8, colsample=0.75)
    model = est.fit(frame(spark, planted))
    got = model.probabilities(np.array([r[1] for r in planted]))
    assert np.allclose(got, plain_round(planted, est), atol=1e-9)


def test_partitioning_does_not_matter(spark, planted):
    df = frame(spark, planted)
    est = SoftmaxBoosting(classes=3, rounds=2, depth=3)
    x = np.array([r[1] for r in planted])
    one, many = (est.fit(d).probabilities(x) for d in (df.coalesce(1), df.repartition(7)))
    assert np.allclose(one, many, atol=1e-9)


def test_learns_and_beats_class_shares(spark, planted):
    df = frame(spark, planted)
    model = SoftmaxBoosting(classes=3, rounds=30, depth=4, eta=0.3).fit(df)
    out = model.transform(df.withColumn("extra", F.lit("kept")))
    r = out.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("hit"),
                F.avg(-F.log(F.expr("probabilities[cast(label as int)]"))).alias("loss"),
                F.max(F.abs(F.expr("aggregate(probabilities, 0D, (a, v) -> a + v)") - 1)).alias("off")).first()
    shares = np.bincount([int(r[0]) for r in planted]) / len(planted)
    assert "extra" in out.columns and r["hit"] > 0.97 and r["off"] < 1e-9
    assert r["loss"] < 0.2 * -(shares * np.log(shares)).sum()


def test_missing_values_take_the_better_side():
    # bin 0 is missing and belongs to class 1, as do large values
    hist = np.zeros((4, 2, 2))
    for b, n0, n1 in ((0, 0, 40), (1, 40, 0), (2, 20, 0), (3, 0, 30)):
        hist[b, 0] = [0.5 * (n0 + n1) - n0, 0.5 * (n0 + n1) - n1]
        hist[b, 1] = 0.5 * (n0 + n1)
    gain, threshold, missing_left, lg, _ = best_split(hist, 1.0, 0.0, 1.0)
    assert (threshold, missing_left) == (2, False) and gain > 0 and lg[0] == -30


def test_one_class_constant_features_and_odd_values(spark):
    df = frame(spark, [(1.0, [0.0, 2.0])] * 20)
    model = SoftmaxBoosting(classes=4, rounds=2, depth=3).fit(df)
    assert model.probabilities(np.array([[0.0, 2.0], [9.0, np.nan]])).argmax(axis=1).tolist() == [1, 1]
    assert model.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        SoftmaxBoosting().fit(df.limit(0))
    with pytest.raises(ValueError):
        SoftmaxBoosting(bins=300)


def test_root_splits_do_not_sample_columns(spark, planted):
    rows = SoftmaxBoosting(classes=3, bins=8).root_splits(frame(spark, planted)).collect()
    assert sorted(r["feature"] for r in rows) == [0, 1, 2, 3]
    best = max(rows, key=lambda r: r["gain"])
    assert best["feature"] == 3  # missing exactly in one class
