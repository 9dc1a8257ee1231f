"""Metric operators against Spark ML evaluators and hand computations."""

import pytest
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MultilabelClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.sql import functions as F

from cartcast.operators import metrics as M
from cartcast.operators import stats as S


def test_binary_curve_ties_and_auc(spark):
    rows = [(0.9, 1.0), (0.8, 1.0), (0.8, 0.0), (0.4, 0.0), (0.4, 1.0), (0.1, 0.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    c = {r.threshold: r for r in M.binary_curve(df, "score", "label").collect()}
    assert (c[0.8].tp, c[0.8].fp) == (2, 1)        # tied scores counted together
    a = M.auc(M.binary_curve(df, "score", "label")).first()
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert a.auc_roc == pytest.approx(ev.evaluate(df), abs=1e-9)


def test_auc_of_many_rows(spark):
    """The product of the class totals is beyond 32 bits."""
    df = spark.range(200_000).select((F.col("id") % 4).cast("double").alias("score"),
                                     (F.col("id") % 2).cast("double").alias("label"))
    a = M.auc(M.binary_curve(df, "score", "label")).first()
    assert a.auc_roc == pytest.approx(0.75) and a.auc_pr == pytest.approx(19 / 24)


def test_regression_metrics_match_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (3.0, 3.5), (4.0, 4.0)], "label double, prediction double")
    m = M.regression_metrics(df, "label", "prediction").first()
    for name in ("mse", "rmse", "mae", "r2", "var"):
        ref = RegressionEvaluator(metricName=name).evaluate(df)
        assert getattr(m, name) == pytest.approx(ref, abs=1e-9), name


def test_multilabel_matches_evaluator(spark):
    rows = [([0.0, 1.0], [0.0, 2.0]), ([0.0, 2.0], [0.0, 1.0]), ([], [0.0]), ([2.0], [2.0]),
            ([2.0, 0.0], [2.0, 0.0]), ([0.0, 1.0, 2.0], [0.0, 1.0]), ([1.0], [1.0, 2.0])]
    df = spark.createDataFrame(rows, "prediction array<double>, label array<double>")
    m = M.multilabel_metrics(df, "label", "prediction").first()
    for ours, theirs in (("subset_accuracy", "subsetAccuracy"), ("accuracy", "accuracy"),
                         ("hamming_loss", "hammingLoss"), ("precision", "precision"),
                         ("recall", "recall"), ("f1", "f1Measure"), ("micro_precision", "microPrecision"),
                         ("micro_recall", "microRecall"), ("micro_f1", "microF1Measure")):
        ref = MultilabelClassificationEvaluator(metricName=theirs).evaluate(df)
        assert getattr(m, ours) == pytest.approx(ref, abs=1e-9), ours


def test_ranking_metrics_hand(spark):
    pred = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 20, 1)], "user int, item int, rank int")
    rel = spark.createDataFrame([(1, 11), (1, 13), (2, 99)], "user int, item int")
    m = M.ranking_metrics(pred, rel, 2).first()
    assert m.precision_at_k == pytest.approx((1 / 2 + 0) / 2)
    assert m.map == pytest.approx(((1 / 2) / 2 + 0) / 2)


def test_chi_square_matches_spark(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import ChiSquareTest
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (1.0, 0.0), (2.0, 1.0), (2.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    ours = S.chi_square_independence(df, "a", "b").first()
    v = df.select(F.col("b").alias("label"), F.array("a").alias("f"))
    from pyspark.ml.functions import array_to_vector
    v = v.select("label", array_to_vector("f").alias("features"))
    ref = ChiSquareTest.test(v, "features", "label").first()
    assert ours.statistic == pytest.approx(float(ref.statistics[0]), abs=1e-9)
    assert ours.dof == ref.degreesOfFreedom[0]
    _ = Vectors


def test_ks_statistic_matches_spark_normal(spark):
    from pyspark.ml.stat import KolmogorovSmirnovTest
    rows = [(float(x),) for x in [0.1, -0.4, 1.3, 0.7, -1.1, 0.0, 2.2, -0.3, 0.5, 0.9, 0.9, -2.0]]
    df = spark.createDataFrame(rows, "v double")
    ours = S.ks_statistic(df, "v", S.normal_cdf(0.0, 1.0)).first().d
    ref = KolmogorovSmirnovTest.test(df, "v", "norm", 0.0, 1.0).first().statistic
    assert ours == pytest.approx(ref, abs=1e-9)
